"""Repeated passages by sparse suffix arrays: suffixes at minimisers, sorted, compared with neighbours, extended both ways."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.arrow import map_batches, struct_of
from plinth.llm.mixing import word_count
from plinth.llm.substring_dedup import BASES, FLUSH, NO_ID, anchors, copies, first_of_copies, keyed, tagged
from plinth.llm.windows import Rolling, WordHashes
from plinth.session import checkpointed

#: Words of the gram whose hash selects a suffix and starts its order.
GRAM = 13
#: Suffixes that a task sorts out at once; those of one part stay together.
CHUNK = 40_000


def _suffixes(rows: DataFrame, reach: int, members: bool) -> DataFrame:
    """Suffixes at the given places of each text, with `reach` words before them and after their gram.

    With `members`, a row for each: `c`, `e` (128 bits of the context), `tag`, `d`, `place`. Else rows for each context that a
    task meets: `after`, `before` (32 bits a word, `before` from right to left), `c`, `e`, `first` (its smallest id) and
    `part`. A window around the gram takes more than half of the other words either after it or before it. So there are two parts: of contexts
    that share the gram and the nearer half after it (even), and of those that share the half before it (odd). A gram that very many texts have is parted by them.
    """
    near = 4 * (reach // 2 + 1)
    schema = "c long, e long, tag long, d long, place int" if members else "part long, after binary, before binary, c long, e long, first long"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), [Rolling(b) for b in BASES]
        met: dict[tuple, list] = {}
        listed: list[tuple] = []

        def flush() -> pa.RecordBatch:
            rows = listed
            if not members:
                half = lambda gram, words, odd: xxhash.xxh3_64_intdigest(words[:near], gram & (2**64 - 1)) >> 1 & ~1 | odd
                rows = [(half(x[0], x[1 + odd], odd), x[1], x[2], c, e, x[3]) for (c, e), x in met.items() for odd in (0, 1) if len(x[1 + odd]) >= near]
            made = pa.RecordBatch.from_arrays([pa.array(col, type=f.type) for col, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
            listed.clear()
            met.clear()
            return made

        for batch in batches:
            for tag, d, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = hashes.of(text.encode().split())
                grams = rolling[0].windows(words, GRAM)
                short = (words >> np.uint64(32)).astype(np.uint32)
                sums = [r.sums(words) for r in rolling]
                lo, hi = np.maximum(np.array(places) - reach, 0), np.minimum(np.array(places) + GRAM + reach, len(words))
                # a context is known by its words and by how many of them stand before the gram
                ends = [((s[hi] - s[lo]) * r.back[lo] + (np.array(places) - lo).astype(np.uint64) * np.uint64(BASES[1]) + (hi - lo).astype(np.uint64)).view(np.int64) for s, r in zip(sums, rolling, strict=True)]
                for place, left, right, c, e in zip(places, lo.tolist(), hi.tolist(), *(x.tolist() for x in ends), strict=True):
                    if members:
                        listed.append((c, e, tag, d, place))
                    elif (c, e) in met:
                        met[c, e][3] = min(d, met[c, e][3])
                    else:
                        met[c, e] = [grams[place : place + 1].view(np.int64)[0].item(), short[place + GRAM : right].tobytes(), short[left:place][::-1].tobytes(), d]
                if len(listed) + len(met) >= FLUSH:
                    yield flush()
        if listed or met:
            yield flush()

    return map_batches(rows, run, struct_of(schema))


def _matrix(column: list[bytes], reach: int) -> tuple[np.ndarray, np.ndarray]:
    width = np.array([len(x) // 4 for x in column], dtype=np.int64)
    return np.frombuffer(b"".join(x.ljust(4 * reach, b"\0") for x in column), dtype=np.uint32).reshape(len(column), reach), width


def shared_windows(part: np.ndarray, after: list[bytes], before: list[bytes], first: np.ndarray, reach: int) -> np.ndarray:
    """For each suffix (row) and each number of words taken before it (column), the smallest id that has that window; -1 past a text's edge.

    Rows are sorted by part and by the words after the gram. The common prefix of each with its neighbour tells how far suffixes
    agree: those that share `r` words after the gram stand in one run. In each run the words before the gram are compared. An even part
    answers for windows with more than half of their other words after the gram, an odd one for the rest; elsewhere it has -1.
    """
    n = len(part)
    odd = part % 2 == 1
    a, wide_a = _matrix(after, reach)
    b, wide_b = _matrix(before, reach)
    common = np.zeros(n, dtype=np.int64)
    same = a[1:] == a[:-1]
    same &= np.arange(reach) < np.minimum(wide_a[1:], wide_a[:-1])[:, None]
    common[1:] = np.where(same.all(axis=1), reach, (~same).argmax(axis=1))
    common[1:][part[1:] != part[:-1]] = -1
    common[0] = -1
    left = np.zeros(n, dtype=np.uint64)
    out = np.full((n, reach + 1), -1, dtype=np.int64)
    for taken in range(reach + 1):
        if taken:
            left = (left ^ b[:, taken - 1].astype(np.uint64)) * np.uint64(BASES[0])
            left ^= left >> np.uint64(29)
        right = reach - taken
        run = np.cumsum(common < right)
        fits = np.flatnonzero((wide_b >= taken) & (wide_a >= right) & (odd == (taken > reach // 2)))
        if len(fits):
            order = fits[np.lexsort((left[fits], run[fits]))]
            starts = np.concatenate([[True], (run[order][1:] != run[order][:-1]) | (left[order][1:] != left[order][:-1])])
            least = np.minimum.reduceat(first[order], np.flatnonzero(starts))
            out[order, taken] = least[np.cumsum(starts) - 1]
    return out


def _compared(contexts: DataFrame, reach: int) -> DataFrame:
    """`c`, `e`, `low`, `high`, `first`: for each context, runs of numbers of words before it with the smallest id that shares those windows."""
    schema = "c long, e long, low int, high int, first long"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(rows: list[list]) -> pa.RecordBatch:
            part, after, before, c, e, first = rows
            least = shared_windows(np.array(part), after, before, np.array(first), reach)
            turns = np.ones(least.shape, dtype=bool)
            turns[:, 1:] = least[:, 1:] != least[:, :-1]
            row, low = np.nonzero(turns)
            high = np.where(np.append(row[1:] != row[:-1], True), reach, np.append(low[1:], 0) - 1)
            value = least[row, low]
            # tasks may have sent the same context; its rows are neighbours and get the same, so the first speaks for all
            again = np.zeros(len(c), dtype=bool)
            same = [np.array(x)[1:] == np.array(x)[:-1] for x in (part, c, e)]
            again[1:] = same[0] & same[1] & same[2]
            keep = (value >= 0) & ~again[row]
            row, low, high, value = row[keep], low[keep], high[keep], value[keep]
            return pa.RecordBatch.from_arrays([pa.array(np.array(c)[row]), pa.array(np.array(e)[row]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(value)], schema=arrow)

        held: list[list] = [[] for _ in range(6)]
        for batch in batches:
            for column, more in zip(held, batch.columns, strict=True):
                column.extend(more.to_pylist())
            if len(held[0]) >= CHUNK:
                part = np.array(held[0])
                last = int(np.searchsorted(part, part[-1]))
                if last:
                    yield work([x[:last] for x in held])
                    held = [x[last:] for x in held]
        if held[0]:
            yield work(held)

    return map_batches(contexts, run, struct_of(schema))


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """`d`, `tag`, `spans`: for each text that holds windows of a smaller id, the structs (`start`, `stop`, `first`) of runs of such windows.

    The suffixes kept are those at minimisers among grams of 13 words, one of which stands in every window. Only grams that more than one
    id has go on. Their suffixes' contexts, up to a window's reach on both sides, are combined in each task, so copies of a passage
    make few; those that share a gram and half of a window's other words meet in one task, sorted as suffixes. Members join back by the context's 128 bits.
    """
    reach = window - GRAM
    rows = tagged(keyed(docs))
    packed = checkpointed(anchors(keyed(docs), GRAM, window))
    seeds = tagged(packed).select("d", "tag", F.explode(F.arrays_zip("grams", "places")).alias("s")).select("d", "tag", F.col("s.grams").alias("gram"), F.col("s.places").alias("place"))
    # written out, so that the join's two sides are plain exchanges and a gram that very many have can be split
    shared = checkpointed(seeds.groupBy("gram").agg(F.min("d").alias("first"), F.max("d").alias("last")).where("first < last").select("gram"))
    known = seeds.join(shared, "gram").groupBy("d", "tag").agg(F.collect_set("place").alias("places")).join(copies(docs), ["d", "tag"], "left_anti")
    texts = rows.select("d", "tag", "text").join(known, ["d", "tag"]).select("tag", "d", "text", "places")
    contexts = _suffixes(texts, reach, False)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    compared = _compared(contexts.repartition(parts, "part").sortWithinPartitions("part", "after", "before"), reach)
    found = _suffixes(texts, reach, True).join(compared, ["c", "e"]).where("first < d")
    span = F.struct((F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + window).alias("stop"), "first")
    return found.groupBy("d", "tag").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def find_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_repeated`, `spans`, `other_ids`.

    `spans` lists start:stop (in words) of the stretches made of windows of `window` words that also stand in a document with a
    smaller `doc_id`, joined by commas where they touch or overlap; `n_repeated` counts the words in them, `other_ids` holds the smallest ids that
    have them. A copy of a text with a smaller id is one span. Words are runs of characters other than a space and \\x09 to
    \\x0D. A null text has no words; a null id is as high as an id can be. Rows that share an id don't repeat each other; rows that repeat id
    and text give equal rows. Texts shorter than a window have no spans. An empty table gives no rows.
    """
    spans = repeated_spans(docs, window)
    rows = docs.select(F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"), F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), F.col("doc_id").alias("doc_id"), word_count().alias("n_words"))
    least = first_of_copies(rows.select("key", "d"))
    whole = (F.col("d") > F.col("least")) & (F.col("n_words") >= window)
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,stop:int>>), (m, s) -> case when size(m) > 0 and s.start <= element_at(m, -1).stop "
        "then concat(slice(m, 1, size(m) - 1), array(struct(element_at(m, -1).start as start, greatest(element_at(m, -1).stop, s.stop) as stop))) "
        "else concat(m, array(struct(s.start as start, s.stop as stop))) end)"
    )
    merged = F.when(whole, F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))).otherwise(F.coalesce(merged, F.expr("cast(array() as array<struct<start:int,stop:int>>)")))
    others = F.when(whole, F.array("least")).otherwise(F.coalesce(F.array_distinct(F.transform("spans", lambda s: s["first"])), F.expr("cast(array() as array<bigint>)")))
    every = tagged(rows).alias("t").join(least.alias("l"), F.col("t.key") == F.col("l.key")).select("t.*", "least").join(spans, ["d", "tag"], "left")
    every = every.select("doc_id", "n_words", merged.alias("merged"), F.array_sort(others).alias("other_ids"))
    return every.select(
        "doc_id",
        "n_words",
        F.expr("aggregate(merged, 0L, (n, s) -> n + s.stop - s.start)").alias("n_repeated"),
        F.array_join(F.transform("merged", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("spans"),
        "other_ids",
    )
