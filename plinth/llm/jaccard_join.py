"""Documents linked by the Jaccard similarity of their word n-grams: count vectors in R-trees, met through groups of shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.arrow import map_batches, sliced, struct_of
from plinth.llm.substring_dedup import BASES, lists
from plinth.llm.windows import Rolling, WordHashes, mixed
from plinth.operators.graph import connected_components, merged_components
from plinth.session import checkpointed

_U64 = np.uint64
#: Sizes of one class lie within this ratio.
WIDTH = Fraction(3, 2)
#: Coordinates of a tree's points: at least so many, about twice the mean set size, and at most so many numbers in all.
LEAST_GROUPS, MOST_NUMBERS = 128, 1 << 23
#: The count that stands for itself and all above it, where counts are stored in 16 bits.
FULL = 65535
#: Keys that a task combines at once.
COMBINED = 1 << 19
#: Coordinates of the box that tells which points need visit a chunk.
BOX = 16
#: Shingles of the sets of a key whose points are asked for in one task by their counts alone, at most a byte for each.
POINTS = 1 << 23
#: Points in a leaf of the tree, and nodes below a node.
LEAF, FANOUT = 64, 16
#: Shingles of sets that meet in one task, and shingles that are compared at once.
CHUNK, BLOCK = 1 << 22, 1 << 21
#: Ids that may be sent to every task: 24 bytes each, so 24 MB at most.
SENT = 1 << 20


def shingles(words: list[bytes], hashes: WordHashes, rolling: Rolling, n: int) -> np.ndarray:
    """The set of a text's `n`-word shingles as sorted 64-bit hashes; of a shorter text, all its words as one."""
    if not words:
        return np.zeros(0, dtype=_U64)
    own = hashes.of(words)
    return np.unique(rolling.windows(own, n) if len(words) >= n else mixed(rolling.windows(own, len(words)) + _U64(len(words))))


@cache
def size_class(size: int) -> tuple[int, int]:
    """The smallest and largest size of the class that holds `size`: 1, 2, 3, 4, 5 to 6, 7 to 9 and so on."""
    low = high = 1
    while high < size:
        low, high = high + 1, max(high + 1, math.floor(high * WIDTH))
    return low, high


@cache
def groups_of(high: int, low: int, least: Fraction) -> tuple[int, int]:
    """How many shingles two linked sets of which the larger is in a class differ in at most, and the groups that its shingles are dealt to.

    Sets of `a` and `b` shingles with a similarity of `least` differ in (a + b) * (1 - least) / (1 + least) at most. One group more than that
    would do, but for groups that are empty; there are some more to make up for these.
    """
    differ = math.floor(2 * high * (1 - least) / (1 + least))
    count, smallest = differ + 1, max(1, math.ceil(least * low))
    while differ and count - count * math.exp(-smallest / count) - 1 < differ + 1 and count < 2 * differ + 4:
        count += 1
    return differ, count


def group_keys(found: np.ndarray, least: Fraction) -> np.ndarray:
    """Keys of which two linked sets have one in common, for sure.

    The hashes are dealt to groups, so many that a linked set differs in fewer. So some group holds the same in both, and its content is a key. If so many groups
    are empty that these may be the ones alike, they are keys too. Groups are those of the class that the larger set's size lies in, so a set
    has the keys of its own class and of those up to its size / `least`.
    """
    size, keys = len(found), []
    to, own = math.floor(size / least), mixed(found ^ _U64(BASES[1]))
    low, high = size_class(size)
    while True:
        differ, count = groups_of(high, low, least)
        group = ((found >> _U64(32)) * _U64(count)) >> _U64(32)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        seed = _U64(high * 0x9E3779B97F4A7C15 & 2**64 - 1)
        keys.append(mixed(mixed(group[first] + seed) + np.add.reduceat(own, first)))
        if len(first) <= differ:
            empty = np.setdiff1d(np.arange(count, dtype=_U64), group[first], assume_unique=True)
            keys.append(mixed(mixed(empty + seed)))
        if high >= to:
            return np.unique(np.concatenate(keys))
        low, high = size_class(high + 1)


def groups_for(size: int) -> int:
    """Groups that the shingles of a set are counted in: some 2 to 4 shingles each, as sums of smaller counts tell little of full groups."""
    groups = LEAST_GROUPS
    while 4 * groups < size:
        groups *= 2
    return groups


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Counts (rows) in fewer groups. A sum that is too large for them stays at FULL."""
    return counts if counts.shape[1] == groups else np.minimum(counts.reshape(len(counts), -1, groups).sum(axis=1, dtype=np.int64), FULL).astype(np.uint16)


def profiles(docs: DataFrame, n: int, least: Fraction) -> DataFrame:
    """`doc_id`, `k`, `size`, `f`, `g` (128 bits of the set), `counts` (of shingles in groups), `keys`; a row for each row of `docs` (`doc_id`, `k`, `text`) that has words."""
    schema = "doc_id long, k binary, size long, f long, g long, counts binary, keys array<long>"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), Rolling(BASES[0])
        for batch in sliced(batches):
            rows, counts, keys, index = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = shingles(text.encode().lower().split(), hashes, rolling, n)
                if len(found):
                    groups = groups_for(len(found))
                    counts.append(np.minimum(np.bincount((found & _U64(groups - 1)).astype(np.int64), minlength=groups), FULL).astype(np.uint16).tobytes())
                    index.append(i)
                    rows.append((len(found), *(np.add.reduce(mixed(found ^ _U64(b))).view(np.int64).item() for b in BASES)))
                    keys.append(group_keys(found, least).view(np.int64))
            columns = [pa.array(c, type=pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 3)]
            chosen = pa.array(index, type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen), *columns, pa.array(counts, type=pa.binary()), lists(keys, pa.int64())], schema=arrow)

    return map_batches(docs.select("doc_id", "k", "text"), run, struct_of(schema))


def meetings(points: DataFrame) -> DataFrame:
    """`key`, `p`, `lo`: the points (`p`, `keys`) of each key that several have, each with a smaller one of them, the smallest with itself.

    Tasks combine first: of the points that have a key in one of their blocks only the smallest goes to the key's task, the others have met it. So a key that
    very many points have sends a row for each block, not for each point.
    """
    first = to_arrow_schema(struct_of("key long, p long, lo long, several boolean"))
    last = to_arrow_schema(struct_of("key long, p long, lo long"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, p = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((p, key))
            key, p = key[order], p[order]
            new = np.append(True, key[1:] != key[:-1])
            starts = np.flatnonzero(new)
            lo = p[starts][np.cumsum(new) - 1]
            several = (np.diff(np.append(starts, len(key))) > 1)[np.cumsum(new) - 1]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(p), pa.array(lo), pa.array(several)], schema=first)

        for batch in batches:
            keys = batch.column(1)
            held.append((keys.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), np.diff(keys.offsets.to_numpy()))))
            if sum(len(k) for k, _ in held) >= COMBINED:
                yield flush()
        if held:
            yield flush()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def shared(key: np.ndarray, p: np.ndarray, several: np.ndarray) -> pa.RecordBatch:
            new = np.append(True, key[1:] != key[:-1])
            starts = np.flatnonzero(new)
            at = np.cumsum(new) - 1
            chosen = (np.diff(np.append(starts, len(key))) > 1)[at] | several
            return pa.RecordBatch.from_arrays([pa.array(key[chosen]), pa.array(p[chosen]), pa.array(p[starts][at][chosen])], schema=last)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)]
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)] if rest else now
            cut = int(np.searchsorted(now[0], now[0][-1]))
            if cut:
                yield shared(*(x[:cut] for x in now))
            rest = [x[cut:] for x in now]
        if rest:
            yield shared(*rest)

    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    combined = map_batches(points, combine, struct_of("key long, p long, lo long, several boolean"))
    firsts = combined.where("p = lo").select("key", "p", "several").repartition(parts, "key").sortWithinPartitions("key", "p")
    return map_batches(firsts, close, struct_of("key long, p long, lo long")).union(combined.where("p > lo").select("key", "p", "lo"))


class CountTree:
    """A packed R-tree over count vectors. A node holds the largest count of each group and the smallest set size below it."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = np.concatenate(list(self._split(counts, np.arange(len(sizes)))))
        self.counts, self.sizes = counts[self.order], sizes[self.order]
        self.alive = np.ones(len(sizes), dtype=bool)
        upper, lowest, self.nodes = self.counts, self.sizes, []
        width = LEAF
        while len(lowest) > 1:
            cuts = np.arange(0, len(lowest), width)
            upper, lowest = np.maximum.reduceat(upper, cuts), np.minimum.reduceat(lowest, cuts)
            self.nodes.append((upper, lowest))
            width = FANOUT
        self.left = [np.add.reduceat(self.alive.astype(np.int64), np.arange(0, len(sizes), LEAF))]

    def _split(self, counts: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
        """Halves along the widest coordinate, down to leaves."""
        todo = [at]
        while todo:
            at = todo.pop()
            if len(at) <= LEAF:
                yield at
                continue
            axis = counts[at].astype(np.int64).var(axis=0).argmax()
            half = -(-len(at) // 2 // LEAF) * LEAF
            at = at[np.argsort(counts[at, axis], kind="stable")]
            todo += [at[half:], at[:half]]

    def near(self, counts: np.ndarray, size: int, share: Fraction) -> np.ndarray:
        """Points still alive whose bound, the sum of the smaller counts, allows for a link."""
        at = np.arange(len(self.nodes[-1][1])) if self.nodes else np.zeros(1, dtype=np.int64)
        for depth in range(len(self.nodes) - 1, -1, -1):
            upper, lowest = self.nodes[depth]
            at = at[bound(upper[at], counts, lowest[at], size, share)]
            width = LEAF if depth == 0 else FANOUT
            below = len(self.sizes) if depth == 0 else len(self.nodes[depth - 1][1])
            if depth == 0:
                at = at[self.left[0][at] > 0]
            at = (at[:, None] * width + np.arange(width)).ravel()
            at = at[at < below]
        at = at[self.alive[at]]
        return at[bound(self.counts[at], counts, self.sizes[at], size, share)]

    def remove(self, at: np.ndarray) -> None:
        self.alive[at] = False
        np.subtract.at(self.left[0], at // LEAF, 1)


def bound(counts: np.ndarray, other: np.ndarray, sizes: np.ndarray, size: int | np.ndarray, share: Fraction) -> np.ndarray:
    """Whether sets with these counts can share enough: no more than the sum of the smaller counts is common to both. A group that is full in both bounds nothing."""
    smaller = np.minimum(counts, other)
    enough = smaller.sum(axis=-1, dtype=np.int64) * share.denominator >= (sizes + size) * share.numerator
    return enough | (smaller >= FULL).any(axis=-1) if other.dtype == np.uint16 and other.size and other.max() >= FULL else enough


def common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements of a sorted set each of the other sets (none is empty) holds."""
    found, at = [], 0
    while at < len(others):
        to, size = at, 0
        while to < len(others) and (to == at or size + len(others[to]) <= BLOCK):
            size, to = size + len(others[to]), to + 1
        flat = np.concatenate(others[at:to])
        same = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
        found.append(np.add.reduceat(same.astype(np.int64), np.cumsum([0, *(len(x) for x in others[at : to - 1])])))
        at = to
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


class Meeting:
    """The points of one key and chunk: an R-tree over their counts, and their sets."""

    def __init__(self, ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], least: Fraction):
        self.ids, self.sets, self.least, self.share = ids, sets, least, least / (1 + least)
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        groups = LEAST_GROUPS
        while groups < 2 * self.sizes.mean() and 2 * groups * len(ids) <= MOST_NUMBERS:
            groups *= 2
        self.groups = groups
        self.counts = np.stack([self.count(s) for s in sets])
        _, self.comps = np.unique(comps, return_inverse=True)
        self.names = np.unique(comps)

    def count(self, found: np.ndarray) -> np.ndarray:
        return np.bincount((found & _U64(self.groups - 1)).astype(np.int64), minlength=self.groups).astype(np.uint32)

    def linked(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Those of the points `at` whose whole sets are similar enough."""
        both = common(found, [self.sets[i] for i in at])
        return at[both * self.least.denominator >= (len(found) + self.sizes[at] - both) * self.least.numerator]

    def forest(self) -> list[tuple[int, int]]:
        """Links enough to connect all components of the points that links connect. What was reached leaves the tree, so a crowd of near copies costs a query each, not a pair each."""
        tree, edges, waiting = CountTree(self.counts, self.sizes), [], []
        where = np.empty(len(self.ids), dtype=np.int64)
        where[tree.order] = np.arange(len(self.ids))
        ordered = np.argsort(self.comps, kind="stable")
        first = np.searchsorted(self.comps[ordered], np.arange(len(self.names) + 1))

        def visit(comp: int) -> None:
            mates = ordered[first[comp] : first[comp + 1]]
            tree.remove(where[mates])
            waiting.extend(mates[::-1].tolist())

        for start in np.argsort(self.ids, kind="stable"):
            if tree.alive[where[start]]:
                visit(self.comps[start])
            while waiting:
                x = waiting.pop()
                met = self.linked(self.sets[x], tree.order[tree.near(self.counts[x], self.sizes[x], self.share)])
                for y in met[np.unique(self.comps[met], return_index=True)[1]]:
                    edges.append((int(self.ids[x]), int(self.ids[y])))
                    visit(self.comps[y])
        self.tree = CountTree(self.counts, self.sizes)
        return edges

    def visited(self, point: int, comp: int, found: np.ndarray) -> list[tuple[int, int]]:
        """Links of a point of another chunk to one point of each component here that it is linked to."""
        near = self.tree.order[self.tree.near(self.count(found), len(found), self.share)]
        met = self.linked(found, near[self.names[self.comps[near]] != comp])
        return [(int(point), int(self.ids[y])) for y in met[np.unique(self.comps[met], return_index=True)[1]]]


def meet(rows: DataFrame, least: Fraction) -> DataFrame:
    """Links `u`, `v` between components of rows (`key`, `chunk`, `guest`, `p`, `comp`, `grams`) that share key and chunk. A guest meets those that are at home in a chunk."""
    schema = "u long, v long"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, here = None, [], None

        def settled(more: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in more], type=pa.int64()) for i in (0, 1)], schema=arrow)

        def close() -> tuple[Meeting | None, list]:
            if not own:
                return None, []
            made = Meeting(*(np.array(c, dtype=np.int64) for c in zip(*((p, c) for p, c, _ in own), strict=True)), [s for _, _, s in own], least)
            return made, made.forest() if len(own) > 1 else []

        for batch in batches:
            edges = []
            for key, chunk, guest, p, comp, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, chunk) != at:
                    if here is None:
                        edges += close()[1]
                    at, own, here = (key, chunk), [], None
                if not guest:
                    own.append((p, comp, np.frombuffer(grams, dtype=_U64)))
                    continue
                if here is None:  # guests come after all that are at home
                    here, more = close()
                    edges += more
                    if here and len(own) == 1:
                        here.tree = CountTree(here.counts, here.sizes)
                if here:
                    edges += here.visited(p, comp, np.frombuffer(grams, dtype=_U64))
            yield settled(edges)
        if here is None:
            yield settled(close()[1])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("key", "chunk", "guest", "p", "comp", "grams").repartition(parts, "key", "chunk").sortWithinPartitions("key", "chunk", "guest", "p")
    return map_batches(ordered, run, struct_of(schema)).distinct()


def counted(values: list[bytes]) -> np.ndarray:
    """Counts of several sets in as many groups as the smallest of them has."""
    width = min(len(v) for v in values)
    return np.concatenate([folded(np.frombuffer(v, dtype=np.uint16).reshape(1, -1), width // 2) for v in values])


def may_be_linked(rows: DataFrame, least: Fraction) -> DataFrame:
    """Pairs `u`, `v` of components, enough to connect all that hold points of one key (rows `key`, `p`, `size`, `comp`, `counts`) whose counts allow for a link."""
    schema, share = "u long, v long", least / (1 + least)
    arrow = to_arrow_schema(struct_of(schema))

    def one_key(ids: np.ndarray, sizes: np.ndarray, comps: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
        counts = counted(values)
        if len(ids) == 2:
            alone = comps[0] == comps[1] or not bound(counts[:1], counts[1], sizes[:1], sizes[1], share)[0]
            return [] if alone else [(int(comps[0]), int(comps[1]))]
        tree, edges, waiting = CountTree(counts, sizes), [], []
        where = np.empty(len(ids), dtype=np.int64)
        where[tree.order] = np.arange(len(ids))
        names, inner = np.unique(comps, return_inverse=True)
        ordered = np.argsort(inner, kind="stable")
        first = np.searchsorted(inner[ordered], np.arange(len(names) + 1))

        def visit(comp: int) -> None:
            mates = ordered[first[comp] : first[comp + 1]]
            tree.remove(where[mates])
            waiting.extend(mates.tolist())

        for start in range(len(names)):
            if tree.alive[where[ordered[first[start]]]]:
                visit(start)
            while waiting:
                x = waiting.pop()
                for comp in np.unique(inner[tree.order[tree.near(counts[x], sizes[x], share)]]):
                    edges.append((int(comps[x]), int(names[comp])))
                    visit(comp)
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: np.ndarray, ids: np.ndarray, sizes: np.ndarray, comps: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            edges = [e for a, b in zip(cuts, np.append(cuts[1:], len(key)), strict=True) if b > a + 1 for e in one_key(ids[a:b], sizes[a:b], comps[a:b], values[a:b])]
            both = np.unique(np.sort(np.array(edges, dtype=np.int64).reshape(-1, 2), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=arrow)

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more = [*(batch.column(i).to_numpy() for i in range(4)), batch.column(4).to_numpy(zero_copy_only=False)]
            held = [np.concatenate(x) for x in zip(held, more, strict=True)] if held else more
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last and len(held[0]) >= 5_000:
                yield pairs(*(x[:last] for x in held))
                held = [x[last:] for x in held]
        if held:
            yield pairs(*held)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(rows.select("key", "p", "size", "comp", "counts").repartition(parts, "key").sortWithinPartitions("key", "p"), run, struct_of(schema)).distinct()


def sets_of(docs: DataFrame, needed: DataFrame, n: int) -> DataFrame:
    """`p`, `size`, `grams`, `box`: the whole sets of the points `needed` (`p`, `k`), made anew of their texts in `docs`, and how many shingles are in each of 16 groups."""
    schema = "p long, size long, grams binary, box array<int>"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), Rolling(BASES[0])
        for batch in sliced(batches):
            made = [shingles(t.encode().lower().split(), hashes, rolling, n) for t in batch.column(1).to_pylist()]
            boxes = lists([np.bincount((s & _U64(BOX - 1)).astype(np.int64), minlength=BOX).astype(np.int32) for s in made], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in made], type=pa.int64()), pa.array([s.tobytes() for s in made], type=pa.binary()), boxes], schema=arrow)

    needed = checkpointed(needed)
    number = needed.count()
    # few enough to send to every task; else texts are dealt out by their key
    sets = checkpointed(map_batches(docs.join(F.broadcast(needed) if number <= SENT else needed, "k").select("p", "text"), run, struct_of(schema)))
    return checkpointed(sets.dropDuplicates(["p"])) if sets.count() > number else sets  # rows may repeat both id and text


def near(pairs: DataFrame, points: DataFrame, least: Fraction) -> DataFrame:
    """Those of the `pairs` (`u`, `v`) for which the sum of the smaller counts of the `points` (`p`, `size`, `counts`) allows for a link."""
    share = least / (1 + least)
    arrow = to_arrow_schema(struct_of("u long, v long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2048):
            sizes = [batch.column(i).to_numpy() for i in (2, 3)]
            x, y = (batch.column(i).to_pylist() for i in (4, 5))
            widths = np.array([min(len(a), len(b)) // 2 for a, b in zip(x, y, strict=True)], dtype=np.int64)
            close = np.zeros(len(widths), dtype=bool)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                one, other = (np.concatenate([folded(np.frombuffer(side[i], dtype=np.uint16).reshape(1, -1), width) for i in at]) for side in (x, y))
                close[at] = bound(one, other, sizes[0][at], sizes[1][at], share)
            chosen = pa.array(np.flatnonzero(close), type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)], schema=arrow)

    side = lambda end: points.select(F.col("p").alias(end), F.col("size").alias(f"size_{end}"), F.col("counts").alias(f"counts_{end}"))
    return map_batches(pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "size_u", "size_v", "counts_u", "counts_v"), run, struct_of("u long, v long"))


def verified(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Those of the `pairs` (`u`, `v`) whose whole sets are similar enough."""
    arrow = to_arrow_schema(struct_of("u long, v long"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            linked = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, dtype=_U64), np.frombuffer(b, dtype=_U64)
                both = int(common(x, [y])[0])
                linked.append(both * least.denominator >= (len(x) + len(y) - both) * least.numerator)
            chosen = pa.array(np.flatnonzero(linked), type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen)], schema=arrow)

    side = lambda end: sets.select(F.col("p").alias(end), F.col("grams").alias(f"grams_{end}"))
    return map_batches(pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "grams_u", "grams_v"), compare, struct_of("u long, v long"))


def _may_link(box: str, other: str, size: str, other_size: str, share: Fraction) -> Column:
    return F.expr(f"aggregate(zip_with({box}, {other}, (a, b) -> least(a, b)), 0L, (s, x) -> s + x) * {share.denominator}L >= ({size} + {other_size}) * {share.numerator}L")


def linked_components(docs: DataFrame, n: int = 3, threshold: str = "0.9", chunk: int = CHUNK) -> DataFrame:
    """`doc_id`, `k`, `size`, `comp` for each row of `docs` (`doc_id`, `k`, `text`) that has words: `comp` is the same number for all rows that links connect.

    Equal sets are one point, which has the number of one of their rows. Shingles are dealt to groups. Points that hold the same shingles in some
    group meet by its key, which linked points surely do (see `group_keys`). Of each key, first each point is compared with a smaller one: a
    pair a row, and a pair once however many keys it has; sets are sent only where counts allow for a link. That connects most. Then only keys are left at which several components
    still meet, keys with the same points once. There an R-tree over count vectors is asked for all whose summed smaller counts allow for a link; what was
    reached leaves the tree. So a key gives a forest, never all its pairs. Components that forests connect are a crowd, which meets once: again
    a tree tells which may be linked, but now these are verified on whole sets in the task, and only
    what is linked leaves the tree. So nothing is left to a further round. A crowd so large that it would be sent more often than its keys ask for meets key by key. A crowd or key whose sets have over `chunk` shingles is dealt out in chunks. Each is the lowest
    level of a larger tree, whose upper level is a table of the chunks' boxes: a point outside one component, the crowd's largest, goes to
    those other chunks whose box allows for a link.
    """
    least = Fraction(threshold)
    share = least / (1 + least)
    rows = checkpointed(profiles(docs, n, least).withColumn("r", F.monotonically_increasing_id()))
    # groups are written out, so that joins with them have plain exchanges on both sides, and a group that very many share can be split
    classes = checkpointed(rows.groupBy("f", "g").agg(F.min("r").alias("p")))
    member = checkpointed(rows.select("r", "doc_id", "k", "size", "f", "g").join(classes, ["f", "g"]).select("r", "doc_id", "k", "size", "p"))
    again = member.where("r <> p").select("r")
    few = again.count() <= SENT
    points = rows.join(F.broadcast(again) if few else again, "r", "left_anti").withColumnRenamed("r", "p")
    points = points if few else checkpointed(points)  # `meetings` walks them twice, in the same order
    met = checkpointed(meetings(points.select("p", "keys")))
    vectors = points.select("p", "size", "counts")
    known = member.where("r = p").select("p", "k")

    stars = checkpointed(near(met.where("lo < p").select(F.col("lo").alias("u"), F.col("p").alias("v")).distinct(), vectors, least))
    sets = sets_of(docs, stars.select(F.explode(F.array("u", "v")).alias("p")).distinct().join(known, "p"), n)
    own = member.where("doc_id is not null").select("doc_id", "p").distinct()
    several = own.groupBy("doc_id").agg(F.min("p").alias("u"), F.max("p").alias("last")).where("u < last").select("doc_id", "u")
    alike = own.join(several, "doc_id").where("u < p").select("u", F.col("p").alias("v"))
    comps = checkpointed(connected_components(verified(stars, sets, least).union(alike), "u", "v"))

    named = met.join(comps.withColumnsRenamed({"node": "p", "component": "comp"}), "p", "left").withColumn("comp", F.coalesce("comp", "p"))
    named = checkpointed(named.drop("lo").join(member.where("r = p").select("p", "size", F.greatest("size", F.lit(2 * LEAST_GROUPS)).alias("weight")), "p"))
    open_keys = named.groupBy("key").agg(
        F.min("comp").alias("a"), F.max("comp").alias("b"), F.min_by("comp", "p").alias("home"), F.sum("weight").alias("total"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("p")).alias("x"), F.bit_xor(F.xxhash64("p", F.lit(1))).alias("y")
    )
    open_keys = open_keys.where("a < b and n > 2").groupBy("n", "x", "y").agg(F.min("key").alias("key"), F.first("home").alias("home"), F.first("total").alias("total"))
    still = checkpointed(named.join(checkpointed(open_keys), "key").select("key", "p", "size", "comp", "weight", "home", "total", "n"))
    asked = may_be_linked(still.where(F.col("total") <= POINTS).select("key", "p", "size", "comp").join(vectors.select("p", "counts"), "p"), least)
    asked = asked.union(still.where((F.col("total") > POINTS) & (F.col("comp") != F.col("home"))).select(F.least("home", "comp"), F.greatest("home", "comp")))
    crowd = checkpointed(connected_components(asked, "u", "v")).select(F.col("node").alias("comp"), F.col("component").alias("crowd"))
    still = checkpointed(still.join(crowd, "comp"))
    sets = sets_of(docs, still.select("p").distinct().join(known, "p"), n)
    inside = checkpointed(still.select("crowd", "p", "comp", "weight").distinct())
    # what it takes to send each point once, or again to each other chunk, and what to send it once for each of its keys
    whole = inside.groupBy("crowd", "comp").agg(F.sum("weight").alias("own")).groupBy("crowd").agg(F.sum("own").alias("all"), F.max_by("comp", F.struct("own", "comp")).alias("home"))
    whole = whole.join(still.groupBy("crowd").agg(F.sum("weight").alias("by_key")), "crowd").withColumn("chunks", F.ceil(F.col("all") / F.lit(chunk)).cast("int"))
    whole = checkpointed(whole.where((F.col("chunks") == 1) | (F.col("chunks") * F.col("all") <= F.col("by_key"))).select("crowd", "home", "chunks"))
    of_chunks = F.pmod(F.xxhash64("p"), F.col("chunks")).cast("int").alias("chunk")
    inside = inside.join(whole, "crowd").select(F.col("crowd").alias("key"), of_chunks, "p", "comp", "home", "chunks")
    by_key = still.join(whole.select("crowd"), "crowd", "left_anti").withColumn("chunks", F.ceil(F.col("total") / F.lit(chunk)).cast("int"))
    dealt = checkpointed(inside.union(by_key.select("key", of_chunks, "p", "comp", "home", "chunks")))
    at_home = dealt.join(sets.select("p", "grams"), "p").select("key", "chunk", F.lit(False).alias("guest"), "p", "comp", "grams")
    parted = dealt.where("chunks > 1")
    if parted.limit(1).count():
        large = checkpointed(parted.join(sets, "p"))
        boxes = checkpointed(large.groupBy("key", "chunk").agg(F.min("size").alias("least_size"), F.array(*(F.max(F.col("box")[i]) for i in range(BOX))).alias("upper")))
        guests = large.where("comp <> home").join(boxes.withColumnRenamed("chunk", "to"), "key").where("`to` <> chunk").where(_may_link("box", "upper", "size", "least_size", share))
        at_home = at_home.union(guests.select("key", F.col("to").alias("chunk"), F.lit(True), "p", "comp", "grams"))
    found = meet(at_home, least)
    comps = merged_components(comps, checkpointed(found), "u", "v")
    return member.join(comps.withColumnRenamed("node", "p"), "p", "left").select("doc_id", "k", "size", F.coalesce("component", "p").alias("comp"))


def _keyed(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` and `k`, by which rows of one id and text are known."""
    return docs.select("doc_id", _key().alias("k"), F.coalesce("text", F.lit("")).alias("text"))


def _key() -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))))


def link_documents(docs: DataFrame, n: int = 3, threshold: str = "0.9", chunk: int = CHUNK) -> DataFrame:
    """One row per document: `doc_id`, `n_shingles`, `component_id`.

    A document's set holds its distinct `n`-word shingles, A-Z lower-cased; with fewer words, all of them as one; without words it is
    empty and linked with nothing. Documents are linked from a Jaccard similarity of `threshold` on; `component_id` is the
    smallest `doc_id` that links lead to, its own included. Rows that share an id are one document and share its links. A null
    id is above all others, and as a component it is null. Rows that repeat give equal rows. An empty table gives no rows.
    """
    rows = _keyed(docs)
    comps = linked_components(rows, n, threshold, chunk)
    named = checkpointed(comps.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    full = comps.join(named, "comp").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    empty = rows.where(~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", F.lit(0).cast("long").alias("n_shingles"))
    # an id that has a wordless row besides others is one document with these
    other = full.where("doc_id is not null").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return full.union(empty.join(other, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id")))


def keep_one_of_each(docs: DataFrame, n: int = 3, threshold: str = "0.9", chunk: int = CHUNK) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all their columns; of rows without words, all.

    Rows without an id stay if nothing with an id is linked to them; of several such that are linked, those of one text stay. Of several rows with the id that stays, all stay.
    """
    comps = linked_components(_keyed(docs), n, threshold, chunk)
    stays = checkpointed(comps.groupBy("comp").agg(F.min("doc_id").alias("least_id"), F.min("k").alias("least_k")))
    gone = comps.join(stays, "comp").where(~F.col("doc_id").eqNullSafe(F.col("least_id")) | F.col("least_id").isNull() & (F.col("k") != F.col("least_k")))
    gone = checkpointed(gone.select(F.col("k").alias("gone")).distinct())
    packed = docs.select(F.struct("*").alias("row"), _key().alias("k"))
    return packed.join(F.broadcast(gone) if gone.count() <= SENT else gone, F.col("k") == F.col("gone"), "left_anti").select("row.*")
