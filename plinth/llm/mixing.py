"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.session import checkpointed

#: A word is a run of characters other than a space and the five ASCII controls that separate lines and columns.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that one histogram resolves, and hashes' bits in all.
STEP_BITS, HASH_BITS = 12, 60


def targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """`target` for each row `source`, `source_size`.

    Sources in code-point order, null last, take the weights in turn and divide `share` of all sizes by them. No target
    passes `limit` times its source's size; what is over goes to the others by weight. The level at which all is
    dealt out is found in one pass over the sources in the order of limit / weight: those below the level are at
    their limits. The windows hold a row per source, never a row per document.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") * limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * limit) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level).withColumn("place", F.row_number().over(order))
    rows = rows.withColumn("open", F.col("level") < F.col("source_size") * limit / F.col("weight"))
    level = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(Window.partitionBy())["level"]
    full = F.col("source_size") * F.lit(float(limit))
    return rows.withColumn("final", level).select("source", "source_size", F.when(F.col("final").isNull(), full).otherwise(F.least(full, F.col("final") * F.col("weight"))).alias("target"))


def _bits(level: int) -> Column:
    """The next STEP_BITS of the hash below those of the levels before."""
    return F.shiftright("key", HASH_BITS - STEP_BITS * (level + 1)).bitwiseAND((1 << STEP_BITS) - 1)


#: Sources whose plan is sent to every task; with more, rows are dealt out by source.
SENT = 1 << 16


def _sent(plan: DataFrame) -> DataFrame:
    """A written table of one row a source, sent to every task if it is short, so that a source that very many rows have needs no task of its own."""
    return F.broadcast(plan) if plan.limit(SENT + 1).count() <= SENT else plan


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`threshold` for each `source` of `wanted` (`source`, `remainder`): rows with `key` below it hold about `remainder` words.

    A histogram sums words by source and leading bits; a running sum over its at most 4096 buckets a source finds the one in
    which the budget ends. Only the rows of that bucket go to the next histogram, of the next bits. At the last bits a bucket
    is one key, taken if that brings the sum nearer. A larger budget gives a larger threshold, so mixes are nested.
    """
    state = checkpointed(wanted.select("source", "remainder", F.lit(0).cast("long").alias("threshold")))
    last = HASH_BITS // STEP_BITS - 1
    for level in range(last + 1):
        shift = HASH_BITS - STEP_BITS * (level + 1)
        inside = rows.alias("r").join(_sent(state).alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select("s.source", "size", "key", "remainder", "threshold")
        if level:
            inside = inside.where(F.shiftright("key", shift + STEP_BITS) == F.shiftright("threshold", shift + STEP_BITS))
        sums = inside.groupBy("source", "remainder", "threshold", _bits(level).alias("bucket")).agg(F.sum("size").alias("size"))
        order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("size").over(order))
        # the bucket in which the running sum passes the budget; at the last level, the last bucket that brings it nearer
        nearer = F.col("upto") - F.col("remainder") <= F.col("remainder") - (F.col("upto") - F.col("size"))
        inner = F.col("upto") <= F.col("remainder") if level < last else nearer
        found = sums.groupBy("source", "remainder", "threshold").agg(
            F.coalesce(F.sum(F.when(inner, F.col("size"))), F.lit(0)).alias("below"),
            F.min(F.when(~inner, F.col("bucket"))).alias("first"),
        )
        bound = F.when(F.col("first").isNull(), F.lit(1 << STEP_BITS)).otherwise(F.col("first"))
        state = checkpointed(
            state.alias("s")
            .join(found.alias("f"), F.col("s.source").eqNullSafe(F.col("f.source")), "left")
            .select(
                "s.source",
                (F.col("s.remainder") - F.coalesce("f.below", F.lit(0))).alias("remainder"),
                F.when(F.col("f.threshold").isNull(), F.col("s.threshold")).otherwise(F.col("s.threshold") + bound * F.lit(1 << shift).cast("long")).alias("threshold"),
            )
        )
    return state.select("source", "threshold")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """60 hash bits of the id and the text: the order in which a source's documents enter a mix."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, share: float = 1.5, limit: int = 2, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """One row per document: `doc_id`, `size`, `source`, `source_size`, `target`, `taken`.

    `taken` is `size` times the passes that the mix makes over the document: every document of a source has the whole
    passes that fit its target, and those whose hash lies below the source's threshold have one more. `share`, `limit` and
    `weights` are those of `targets`. A null text has no words; a null source is a source of its own, the last. A null id
    is hashed like an empty one. Rows that repeat id, text and source share their key, so they are taken or left together.
    Documents without words are taken with 0 words. An empty table gives no rows. Only `doc_id`, `text` and `source` are read.
    """
    rows = checkpointed(docs.select("doc_id", "source", word_count().alias("size"), mix_key().alias("key")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the step down keeps a target at the limit from a needless search
    plan = targets(sizes, share, limit, weights).withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    plan = checkpointed(plan.withColumn("remainder", F.col("target") - F.col("passes") * F.col("source_size")))
    cut = thresholds(rows, plan.where("remainder > 0"))
    plan = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left").select("p.*", F.coalesce("c.threshold", F.lit(0)).alias("threshold"))
    plan = _sent(checkpointed(plan))
    return (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("doc_id", "size", "r.source", "source_size", "target", (F.col("size") * (F.col("passes") + (F.col("key") < F.col("threshold")).cast("long"))).alias("taken"), "key", "passes", "threshold")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with the columns of `docs`. Documents without words stay once."""
    options = {"share": 1.5, "limit": 2, "weights": (3, 1, 2)} | options
    decided = checkpointed(mix(docs, **options).groupBy("source", "passes", "threshold").agg(F.count("*").alias("n")))
    packed = docs.select(F.struct("*").alias("row"), F.col("source").alias("source"), mix_key().alias("key"), word_count().alias("size"))
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("passes") + (F.col("key") < F.col("threshold")).cast("long")).cast("int")
    joined = packed.alias("r").join(_sent(decided).alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("i")).select("row.*")
