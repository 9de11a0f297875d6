"""SpotSigs fingerprints: chains of content words after common-word anchors. DataFrame functions only."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.session import checkpointed

#: Common words of four languages, the anchors.
ANCHORS = (
    "the of and to in is that for with as was by on are this be at an it from "
    "le la les des du et un une en que qui est dans pour par sur au "
    "der die das und den von zu mit ist im für auf dem ein eine nicht sich als auch "
    "el los las del y por con para es se de"
).split()
#: Content words in a chain.
CHAIN = 2


def _one_of(words: list[str]) -> str:
    """An alternation that tries a first letter once."""
    by_letter: dict[str, list[str]] = defaultdict(list)
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        by_letter[w[0]].append(w[1:])
    return "(?:" + "|".join(f"{a}(?:{'|'.join(rest)})" for a, rest in by_letter.items()) + ")"


def spots(text: Column, anchors: list[str] = ANCHORS, chain: int = CHAIN) -> Column:
    """The set of a text's spot signatures as sorted 32-bit hashes. Words are runs of ASCII letters and digits and of all that is not ASCII, in lower case.

    A signature starts at each anchor and ends with the `chain`-th content word after it. A text without any is hashed whole, so equal texts
    have equal sets, and no set is empty.
    """
    anchor = _one_of(anchors)
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[\x00-/:-@\[-`{-\x7F]+", " "), F.lit(" "))
    link = f"(?:{anchor} )*+[^ ]+"
    found = F.regexp_extract_all(words, F.lit(f" (?=({anchor} {' '.join([link] * chain)}) )[^ ]+"), F.lit(1))
    hashes = F.sort_array(F.array_distinct(F.transform(found, lambda s: F.hash(s))))
    # named once, so that it is worked out once
    return F.element_at(F.filter(F.array(hashes, F.array(F.hash(text))), lambda s: F.size(s) > 0), 1)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets. Sorted sets whose ranges don't meet have nothing in common, and aren't compared."""
    common = F.size(F.array_intersect(a, b))
    apart = (F.element_at(a, 1) > F.element_at(b, -1)) | (F.element_at(b, 1) > F.element_at(a, -1))
    return F.when(apart, 0.0).otherwise(common / (F.size(a) + F.size(b) - common))


def followers(rows: DataFrame) -> DataFrame:
    """`k`, `n`, `next_k`: each row's successor in the order of descending `doc_id`, then `k`; the last is followed by the first.

    Rows are dealt to ranges of that order, and each finds its successor in its range; the last of a range takes the first of the next. Only
    ids and keys move, and the window without partitions holds one row per range.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("k")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    inside = dealt.withColumn("next_k", F.lead("k").over(Window.partitionBy("range").orderBy(*order)))
    firsts = dealt.groupBy("range").agg(F.min_by("k", F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "k")).alias("k"))
    every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("range", F.coalesce(F.lead("k").over(Window.orderBy("range")), F.first("k").over(every)).alias("first_k"))
    return inside.join(firsts, "range").select("k", "n", F.coalesce("next_k", "first_k").alias("next_k"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document: `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`, `next_id`.

    The next document is the one with the next smaller id, null the smallest; after the last comes the first. The edited text has its last
    third (of code points, rounded down) replaced by as many from the start of the next. A fingerprint lists a set of spot signatures,
    and likeness is the sets' Jaccard similarity. A null text counts as empty. Rows with one id follow each other by a hash of the text; rows that repeat id and text
    are one document and give equal rows. A single document follows itself. An empty table gives no rows.

    Texts are dealt out once, by a hash of id and text, and both joins use that. The next text comes to its predecessor as the head that is needed and as
    its set, not whole.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)))
    rows = docs.select(key.alias("k"), F.col("doc_id").alias("doc_id"), text.alias("text"))
    listed = rows.select("k", "doc_id", F.length("text").alias("n")).groupBy("k").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"))
    needed = checkpointed(followers(listed))
    third = F.floor(F.col("n") / 3).cast("int")
    heads = (
        rows.alias("t")
        .join(needed.select(F.col("k").alias("this"), "n", F.col("next_k").alias("k")).alias("m"), "k")
        .select("this", F.col("doc_id").alias("next_id"), F.expr("left(text, cast(floor(n / 3) as int))").alias("head"), spots(F.col("text")).alias("next_spots"))
        .dropDuplicates(["this"])
    )
    joined = rows.join(heads, F.col("k") == F.col("this")).withColumn("n", F.length("text"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n") - third), F.col("head"))
    joined = joined.select("doc_id", "next_id", "n", "text", edited.alias("edited"), "next_spots")
    made = joined.select("doc_id", "next_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), spots(F.col("text")).alias("own"), spots(F.col("edited")).alias("other"), "next_spots")
    named = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        named("own").alias("fingerprint"),
        named("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_spots")).alias("near_next"),
        "next_id",
    )
