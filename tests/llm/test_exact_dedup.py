import hashlib
from collections import defaultdict

import numpy as np

from pyspark.sql import functions as F

from plinth.llm import exact_dedup as module
from plinth.llm.binary_fuse import BinaryFuse
from plinth.llm.exact_dedup import exact_dedup, keep_exact, screened, snapshot_filters, text_digest

SCHEMA = "doc_id long, text string, digest string, keep_id int"


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        seen = False
        for x in ids:
            out.append((x, keep, len(ids), x == keep and not seen, hashlib.sha256(text.encode()).hexdigest()))
            seen |= x == keep
    return sorted(out, key=str)


def test_filters_have_no_false_negatives():
    random = np.random.default_rng(7)
    for n in (0, 1, 2, 3, 10, 100, 5_000, 70_000):
        keys = random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        made = BinaryFuse.build(np.concatenate([keys, keys[: n // 3]]))
        assert made.contains(keys).all()
        assert made.contains(random.integers(0, 2**63, 20_000, dtype=np.uint64)).mean() < 0.002


def test_groups_ties_nulls_and_clashing_columns(spark):
    rows = [(i, f"text {i % 7}", "x", 1) for i in range(40)]
    rows += [(100, "twice", "a", 1), (100, "twice", "b", 2), (None, None, "n", None), (None, "", "n", None), (3, "", "m", 0), (None, "alone", None, None)]
    rows += [(200, "é" * 50_000, "long", 1), (201, "é" * 50_000, "long", 1), (7, "text 0 ", "space", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = exact_dedup(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    kept = keep_exact(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in kept.collect())
    assert ids == sorted((x[0] if x[0] is not None else -1, t) for t, x in {r[1] or "": max(((y[0],) for y in rows if (y[1] or "") == (r[1] or "") and y[0] is not None), default=(None,)) for r in rows}.items())


def test_negatives_join_nothing_and_false_positives_are_new(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "a", False), (4, "c", False)], "doc_id long, text string, old boolean")
    digests = rows.select("doc_id", module.text_digest("text").alias("digest"), F.col("old").alias("in_snapshot"))
    sizes = lambda: sorted(r.group_size for r in module.duplicate_groups(digests).collect())
    assert sizes() == [1, 1, 2]
    for positive, want in ((True, [1, 1, 2]), (False, [1, 1, 1, 1])):  # a screen that passes all, and one that passes none
        monkeypatch.setattr(module, "screened", lambda batch, filters, positive=positive: batch.select("digest", F.lit(positive).alias("positive")))
        assert sizes() == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(docs).count() == 0 and keep_exact(docs).count() == 0


def test_any_split_gives_the_same_groups(spark, monkeypatch):
    import plinth.llm.exact_dedup as module

    monkeypatch.setattr(module, "KEYS_PER_FILTER", 16)
    monkeypatch.setattr(module, "PROBES", 8)
    rows = [(i, f"text {i % 37 if i % 3 else i}") for i in range(300)] + [(None, None), (7, ""), (300, "text 1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, exact_dedup(docs).collect()), key=repr)
    for split in (F.lit(False), F.lit(True), F.col("doc_id") < 100):
        assert sorted(map(tuple, exact_dedup(docs, in_snapshot=split).collect()), key=repr) == want


def test_kept_filters(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i % 50}") for i in range(200)], "doc_id long, text string")
    old = F.col("doc_id") < 30
    module_digests = rows.where(old).select(text_digest("text").alias("digest")).distinct()
    snapshot_filters(module_digests).write.parquet(str(tmp_path / "filters"))
    kept = spark.read.parquet(str(tmp_path / "filters"))
    assert sorted(map(tuple, exact_dedup(rows, old, filters=kept).collect())) == sorted(map(tuple, exact_dedup(rows).collect()))
    new = rows.where(~old).select(text_digest("text").alias("digest")).distinct()
    assert screened(new, kept).where("positive").count() >= 30


def test_texts_of_one_digest_are_compared(spark):
    weak = lambda text: F.unhex(F.md5(F.left(text, F.lit(1))))
    rows = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "b"), (5, "b"), (6, "a"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(docs, digest=weak).collect()}
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (5, 2), 5: (5, 2), 6: (6, 1), 7: (8, 2), 8: (8, 2)}
