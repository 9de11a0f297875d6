"""Substring deduplication by level-wise doubling: windows repeated at one length alone are extended to twice that length."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.arrow import map_batches, struct_of
from plinth.llm.windows import Rolling, WordHashes, minimisers
from plinth.session import checkpointed

#: Two independent bases: a window of full length is known by 128 bits.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Rows in an Arrow batch that a task gives back.
FLUSH = 100_000
#: Stands for a null id where ids are compared: none is larger.
NO_ID = 2**63 - 1
#: The first level's windows have at most so many words.
SHORTEST = 13


def levels(window: int) -> list[int]:
    """The lengths of all levels, each half of the next, rounded up: for 50 words 13, 25 and 50. A window of up to `SHORTEST` words is both levels."""
    lengths = [window]
    while lengths[0] > SHORTEST or len(lengths) == 1 and window > 1:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths if len(lengths) > 1 else [window, window]


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One Arrow list for each array."""
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=kind))


def keyed(docs: DataFrame) -> DataFrame:
    """`key` (of the text), `d` (the id, null as the largest) and `text`, which null as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.unhex(F.md5(text)).alias("key"), F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), text.alias("text"), F.col("doc_id").alias("doc_id"))


def anchors(rows: DataFrame, gram: int, window: int) -> DataFrame:
    """`key`, `d`, `grams`, `places`: of each text, the grams of `gram` words that are the minimiser of some window of `window` words."""
    schema = "key binary, d long, grams array<long>, places array<int>"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), Rolling(BASES[0])
        for batch in batches:
            index, grams, places = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = text.encode().split()
                if len(words) >= window:
                    own = rolling.windows(hashes.of(words), gram)
                    at = np.unique(minimisers(own, window - gram + 1))
                    index.append(i)
                    grams.append(own[at].view(np.int64))
                    places.append(at)
            chosen = pa.array(index, type=pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen), lists(grams, pa.int64()), lists(places, pa.int32())], schema=arrow)

    return map_batches(rows, run, struct_of(schema))


def candidates(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """`key`, `d`, `codes`, `grams0`, `grams1`, ...: what each text brings to the levels before the last.

    Any window of full length holds a gram of the first length that is its minimiser, chosen alike wherever the window stands. It grows to the right, or to the left
    where the window ends too soon for that: a code is twice the gram's place, and one more if it grows to the left. So each level has at most two grams
    for a minimiser, and each lies in the next.
    """
    grams = "".join(f", grams{i} array<long>" for i in range(len(lengths) - 1))
    schema = struct_of("key binary, d long, codes array<int>" + grams)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), Rolling(BASES[0])
        for batch in batches:
            index, codes, found = [], [], [[] for _ in lengths[:-1]]
            for i, text in enumerate(batch.column(2).to_pylist()):
                words = text.encode().split()
                if len(words) >= lengths[-1]:
                    own = hashes.of(words)
                    code = np.unique(coded(rolling.windows(own, lengths[0]), lengths))
                    index.append(i)
                    codes.append(code)
                    for length, column in zip(lengths, found):
                        start = (code >> 1) - (code & 1) * (length - lengths[0])
                        column.append(rolling.windows(own, length)[start].view(np.int64))
            chosen = pa.array(index, type=pa.int32())
            columns = [batch.column(0).take(chosen), batch.column(1).take(chosen), lists(codes, pa.int32()), *(lists(c, pa.int64()) for c in found)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(rows, run, schema)


def coded(grams: np.ndarray, lengths: list[int]) -> np.ndarray:
    """For each window of the last length its code: see `candidates`. `grams` are those of the first length."""
    around = minimisers(grams, lengths[-1] - lengths[0] + 1)
    return 2 * around + (around - np.arange(len(around)) > lengths[-1] - lengths[-2])


def first_of_copies(rows: DataFrame) -> DataFrame:
    """`key` and the smallest id `least` that has the text."""
    return rows.groupBy("key").agg(F.min("d").alias("least"))


def _apart(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The first place of each pair of hashes; and, by its number among these, the other places of each pair that comes again."""
    order = np.lexsort((b, a))
    new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])) if len(a) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new)
    number = np.diff(np.append(starts, len(a)))
    return order[starts], [(int(i), order[starts[i] + 1 : starts[i] + number[i]]) for i in np.flatnonzero(number > 1)]


def _extended(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Windows of full length around the repeated grams of the level before: `a`, `b` (128 bits), `d`, `place`, and `tag` where a smaller id has the gram.

    A window that a text repeats is one row: its first place, and the others in `more`. So no window has more rows than there are texts.
    """
    schema = "a long, b long, d long, place int, tag long, more array<int>"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rolling = WordHashes(), [Rolling(b) for b in BASES]
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            a, b, place = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
            held_rows = [len(h[0]) for h in held]
            d = np.repeat(np.array([h[2] for h in held], dtype=np.int64), held_rows)
            tag = np.repeat(np.array([h[4] for h in held], dtype=np.int64), held_rows)
            smaller = np.concatenate([h[5] for h in held])
            more = pa.array([x for h in held for x in h[6]], type=pa.list_(pa.int32()))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(d), pa.array(place.astype(np.int32)), pa.array(tag, mask=~smaller), more], schema=arrow)

        for batch in batches:
            for _, d, tag, text, codes, smaller in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = hashes.of(text.encode().split())
                around = coded(rolling[0].windows(words, lengths[0]), lengths)
                order = np.argsort(codes)
                known, flags = np.array(codes)[order], np.array(smaller, dtype=bool)[order]
                at = np.minimum(np.searchsorted(known, around), len(known) - 1)
                place = np.flatnonzero(known[at] == around)
                full = [r.windows(words, lengths[-1])[place] for r in rolling]
                one, again = _apart(*full)
                more: list[list[int] | None] = [None] * len(one)
                for i, others in again:
                    more[i] = place[others].tolist()
                held.append((full[0][one], full[1][one], d, place[one], tag, flags[at[place[one]]], more))
                if sum(len(h[0]) for h in held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return map_batches(rows, run, struct_of(schema))


def tagged(rows: DataFrame) -> DataFrame:
    """`rows` of `keyed` with `tag`, 64 bits of the key, which tell the texts of one id apart."""
    return rows.withColumn("tag", F.xxhash64("key"))


def dealt(docs: DataFrame) -> DataFrame:
    """`doc_id`, `d`, `tag`, `text`. All joins of texts by `d` and `tag` take these columns, whether they need them or not: so their exchanges are equal, and Spark deals the texts out once for all of them."""
    return tagged(keyed(docs)).select("doc_id", "d", "tag", "text")


def repeated_windows(docs: DataFrame, window: int = 50) -> DataFrame:
    """`d`, `tag` and `places` where windows start that a smaller id has too. Copies of a text other than that of its smallest id have no row.

    Each level takes the grams that the one before left, in both directions of growth, and keeps those that more than one id has; it ends where none is
    left. What stays at half the length is extended to the full length, at all places around. A larger id's window goes on to be
    compared only if a smaller id has its half.
    """
    lengths = levels(window)
    again = checkpointed(copies(docs))
    packed = tagged(checkpointed(candidates(keyed(docs), lengths)))
    grams = [f"grams{i}" for i in range(len(lengths) - 1)]
    alive = packed.select("d", "tag", F.explode(F.arrays_zip("codes", *grams)).alias("s")).select("d", "tag", F.col("s.codes").alias("code"), *(f"s.{g}" for g in grams))
    for gram in grams:
        # written out, so that the join's two sides are plain exchanges and a gram that very many have can be split
        shared = checkpointed(alive.groupBy(gram).agg(F.min("d").alias("first"), F.max("d").alias("last")).where("first < last").select(gram, "first"))
        if shared.isEmpty():
            return docs.sparkSession.createDataFrame([], "d long, tag long, places array<int>")
        alive = alive.drop("first").join(shared, gram).drop(gram)
        if gram == grams[0]:  # copies go where few rows are left to be dealt out for that
            alive = alive.join(again, ["d", "tag"], "left_anti")
        if gram != grams[-1]:
            alive = checkpointed(alive)
    known = alive.groupBy("d", "tag").agg(F.collect_set(F.struct("code", (F.col("first") < F.col("d")).alias("smaller"))).alias("s"))
    texts = dealt(docs).join(known, ["d", "tag"])
    full = _extended(texts.select("doc_id", "d", "tag", "text", F.col("s.code").alias("codes"), F.col("s.smaller").alias("smaller")), lengths)
    first = full.select("a", "b", "d").groupBy("a", "b").agg(F.min("d").alias("first"))
    again = full.where("tag is not null").join(first, ["a", "b"]).where("first < d")
    every = F.concat(F.array("place"), F.coalesce("more", F.expr("cast(array() as array<int>)")))
    return again.groupBy("d", "tag").agg(F.flatten(F.collect_list(every)).alias("places"))


def copies(docs: DataFrame) -> DataFrame:
    """`d` and `tag` of texts that a smaller id has too."""
    rows = tagged(keyed(docs)).select("key", "d", "tag")
    return rows.join(first_of_copies(rows), "key").where("d > least").select("d", "tag").distinct()


def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_removed`, `kept_sha256`.

    A word goes if some `window` consecutive words around it also start in a document with a smaller `doc_id`. All windows are
    those of the input. Words are runs of characters other than a space and \\x09 to \\x0D. A null text has no words; a null
    id is as high as an id can be, so it removes nothing. Rows that share an id do not remove each other's words; rows that
    repeat id and text give equal rows. Texts shorter than a window lose nothing. An empty table gives no rows.
    """
    places = repeated_windows(docs, window)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    arrow = to_arrow_schema(struct_of(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text, copy, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                kept = words
                if copy:
                    kept = words if len(words) < window else []
                elif starts:
                    steps = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, np.array(starts) + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
                for column, value in zip(out, (doc_id, len(words), len(words) - len(kept), sha256(b" ".join(kept)).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    every = dealt(docs).join(places, ["d", "tag"], "left").join(copies(docs).withColumn("copy", F.lit(True)), ["d", "tag"], "left")
    return map_batches(every.select("doc_id", "text", "copy", "places"), run, struct_of(schema))
