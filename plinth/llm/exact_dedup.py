"""Exact deduplication: binary fuse filters over immutable snapshots screen the digests of a new batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.binary_fuse import BinaryFuse
from plinth.session import checkpointed

#: Distinct digests for which one filter is built, in 36 kilobytes, and digests that are put to a filter in one task.
KEYS_PER_FILTER, PROBES = 1 << 14, 1 << 16
#: Groups of copies that may be sent to every task: 64 bytes each, so 16 MB at most.
SENT = 1 << 18


def _key(digests: pd.Series) -> np.ndarray:
    """64 of the 256 bits; they are apart from those that choose the bucket."""
    return np.frombuffer(b"".join(d[8:16] for d in digests), dtype="<u8")


def snapshot_filters(snapshot: DataFrame, buckets: int | None = None) -> DataFrame:
    """One static filter (`bucket`, `buckets`, `seed`, `segment`, `segments`, `cells`) for each bucket of distinct `digest`s.

    A snapshot doesn't change, so the table may be written once and given to `duplicate_groups` with each new batch.
    """
    if buckets is None:
        buckets = max(1, -(-snapshot.count() // KEYS_PER_FILTER))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = BinaryFuse.build(_key(rows["digest"]))
        return pd.DataFrame(
            {"bucket": [rows["bucket"].iloc[0]], "buckets": [buckets], "seed": [str(made.seed)], "segment": [made.segment], "segments": [made.segments], "cells": [made.cells.tobytes()]}
        )

    return (
        snapshot.select(_bucket(buckets), "digest")
        .groupBy("bucket")
        .applyInPandas(build, "bucket int, buckets int, seed string, segment int, segments int, cells binary")
    )


def screened(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """The digests of `batch` with `positive`: false only if the snapshot surely lacks them. A bucket's digests are dealt to as many tasks as they need."""

    def probe(rows: pd.DataFrame, made: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(rows), dtype=bool)
        for x in made.itertuples() if len(rows) else ():
            hit |= BinaryFuse(int(x.seed), x.segment, x.segments, np.frombuffer(x.cells, dtype=np.uint16)).contains(_key(rows["digest"]))
        return pd.DataFrame({"digest": rows["digest"], "positive": hit})

    one = filters.select("buckets").first()
    if one is None:  # an empty snapshot
        return batch.select("digest", F.lit(False).alias("positive"))
    deals = max(1, -(-batch.count() // (PROBES * one.buckets)))
    left = batch.select(_bucket(one.buckets), F.pmod(F.xxhash64("digest"), F.lit(deals)).alias("deal"), "digest").groupBy("bucket", "deal")
    right = filters.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("deal"))
    return left.cogroup(right.groupBy("bucket", "deal")).applyInPandas(probe, "digest binary, positive boolean")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(buckets)).cast("int").alias("bucket")


def _summed(rows: DataFrame) -> DataFrame:
    """A row for each digest: the largest id, how often that id stands there, and all rows. Both steps combine before they shuffle."""
    return (
        rows.groupBy("digest", "doc_id")
        .agg(F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "n")).alias("last"), F.sum("n").alias("group_size"))
    )


def duplicate_groups(digests: DataFrame, filters: DataFrame | None = None) -> DataFrame:
    """Groups of equal texts among rows `digest`, `doc_id`, `in_snapshot`: `digest`, `keep_id`, `n_keep`, `group_size`.

    The snapshot's distinct digests are dealt to buckets by their first bytes, and one static filter is built of each.
    Digests of the new batch, already grouped among themselves, are put to the filter of their bucket. Negatives are
    new and join nothing. Positives join the snapshot's exact buckets; those without an equal are new too. `filters` are those of the same
    snapshot, if they were kept.
    """
    old = checkpointed(_summed(digests.where("in_snapshot")))
    new = checkpointed(_summed(digests.where("not in_snapshot")))
    marked = screened(new, checkpointed(snapshot_filters(old)) if filters is None else filters)
    new = checkpointed(new.join(marked, "digest"))
    positive = new.where("positive")
    o, n = old.alias("o"), positive.alias("n")
    known = o.join(n, F.col("o.digest") == F.col("n.digest"), "left").select(
        F.col("o.digest"),
        F.when(F.col("n.digest").isNull() | (F.col("o.last.doc_id") > F.col("n.last.doc_id")), F.col("o.last"))
        .when(F.col("o.last.doc_id").eqNullSafe(F.col("n.last.doc_id")), F.struct(F.col("o.last.doc_id"), (F.col("o.last.n") + F.col("n.last.n")).alias("n")))
        .when(F.col("n.last.doc_id").isNull(), F.col("o.last"))
        .otherwise(F.col("n.last"))
        .alias("last"),
        (F.col("o.group_size") + F.coalesce("n.group_size", F.lit(0))).alias("group_size"),
    )
    fresh = new.where("not positive").union(positive.join(old.select("digest"), "digest", "left_anti").select(*new.columns)).select("digest", "last", "group_size")
    return known.union(fresh).select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.n").alias("n_keep"), "group_size")


def text_digest(text: Column | str) -> Column:
    return F.unhex(F.sha2(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), 256))


def _copies(n: str) -> Column:
    """1 for the first of `n` rows and 0 for the others, exploded in blocks of bounded size."""
    return F.explode(F.expr(f"transform(sequence(0L, ({n} - 1) div 10000L), b -> struct(b * 10000L + 1 as first, least({n}, (b + 1) * 10000L) as last))"))


def _grouped(docs: DataFrame, in_snapshot: Column | None, digest: Callable[[Column], Column], filters: DataFrame | None) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows (`doc_id`, `digest`) and their groups, whose texts are equal byte by byte, and what gives any rows with `text` their `digest`.

    The texts of each digest that several rows have are compared: the smallest and largest are the same, or else the digest is no proof. Only copies' texts are
    looked at, and combined in each task. A digest that differing texts have goes on with its text's bytes behind it.
    """
    split = F.coalesce(in_snapshot if in_snapshot is not None else F.xxhash64("doc_id") % 2 == 0, F.lit(False))
    text = F.coalesce(F.col("text"), F.lit(""))
    named = lambda rows: rows.withColumn("digest", digest(text))
    rows = checkpointed(named(docs.select("doc_id", "text", split.alias("in_snapshot"))).select("doc_id", "digest", "in_snapshot"))
    groups = checkpointed(duplicate_groups(rows, filters))
    several = groups.where("group_size > 1").select("digest")
    copies = named(docs.select("text")).join(F.broadcast(several) if several.count() <= SENT else several, "digest")
    unlike = checkpointed(copies.groupBy("digest").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a < b").select(F.col("digest").alias("unlike")))
    if not unlike.limit(1).count():
        return rows, groups, named
    exact = lambda rows: named(rows).join(unlike, F.col("digest") == F.col("unlike"), "left").withColumn("digest", F.when(F.col("unlike").isNull(), F.col("digest")).otherwise(F.concat("digest", text.cast("binary")))).drop("unlike")
    rows = checkpointed(exact(docs.select("doc_id", "text", split.alias("in_snapshot"))).select("doc_id", "digest", "in_snapshot"))
    return rows, checkpointed(duplicate_groups(rows)), exact


def exact_dedup(docs: DataFrame, in_snapshot: Column | None = None, digest: Callable[[Column], Column] = text_digest, filters: DataFrame | None = None) -> DataFrame:
    """One row per document: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`.

    `docs` has `doc_id` and `text`; other columns are left alone. `in_snapshot` tells the rows of the immutable snapshot
    from those of the new batch; by default a hash of the id deals them out, which any split may replace, as the
    groups don't depend on it; a null there is new. `digest` gives at least 16 bytes for a text; texts of one digest are compared byte by byte. `filters` are
    those of `snapshot_filters`, if they were kept. Texts are equal when their UTF-8 bytes are; a null text counts as an empty one. The row
    with the largest `doc_id` stays, and a null id is below all others. Of rows that repeat both id and text, one is
    kept. An empty table gives no rows.
    """
    rows, groups, _ = _grouped(docs, in_snapshot, digest, filters)
    last = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    single = (
        rows.select("doc_id", "digest")
        .join(groups, "digest")
        .where(~last | (F.col("n_keep") == 1))
        .select("doc_id", "keep_id", "group_size", last.alias("kept"), "digest")
    )
    repeated = (
        groups.where("n_keep > 1")
        .select("*", _copies("n_keep").alias("block"))
        .select("*", F.explode(F.sequence("block.first", "block.last")).alias("i"))
        .select(F.col("keep_id").alias("doc_id"), "keep_id", "group_size", (F.col("i") == 1).alias("kept"), "digest")
    )
    made = single.union(repeated).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex(F.substring("digest", 1, 32))).alias("text_sha256"))
    return made if digest is text_digest else made.drop("text_sha256")


def keep_exact(docs: DataFrame, in_snapshot: Column | None = None) -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns. Of repeated rows any one stays.

    Only groups of several rows are joined, and while these are few the documents stay where they are.
    """
    _, groups, named = _grouped(docs, in_snapshot, text_digest, None)
    groups = groups.where("group_size > 1").select("digest", "keep_id", "n_keep")
    packed = named(docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))).select("row", "doc_id", "digest")
    joined = packed.join(F.broadcast(groups) if groups.count() <= SENT else groups, "digest", "left").where(F.col("n_keep").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    once = joined.where("n_keep is null or n_keep = 1").select("row")
    if not groups.where("n_keep > 1").limit(1).count():
        return once.select("row.*")
    return once.union(joined.where("n_keep > 1").dropDuplicates(["digest"]).select("row")).select("row.*")
