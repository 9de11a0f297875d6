import hashlib
import random
import re

from pyspark.sql import functions as F

from plinth.llm.spotsigs import ANCHORS, fingerprint_documents, spots


def plain_spots(text):
    words = [w for w in re.split(r"[\x00-/:-@\[-`{-\x7F]+", text.lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in ANCHORS:
            chain, content = [w], 0
            for x in words[i + 1 :]:
                chain.append(x)
                content += x not in ANCHORS
                if content == 2:
                    out.add(" ".join(chain))
                    break
    return out or {("whole", text)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_spots_of_a_text(spark):
    row = spark.createDataFrame([("The cat, and the dog of war is y",)], "t string").select(spots(F.col("t")).alias("s"), *[F.hash(F.lit(x)) for x in sorted(plain_spots("The cat, and the dog of war is y"))]).first()
    assert plain_spots("The cat, and the dog of war is y") == {"the cat and the dog", "and the dog of war", "the dog of war"}
    assert sorted(row[1:]) == row.s


def test_rows_match_a_plain_walk(spark):
    random.seed(2)
    word = lambda: random.choice([*ANCHORS[:20], *(f"w{i}é" for i in range(40))])
    rows = [(i * 5 % 307, random.choice([". ", " "]).join(word() for _ in range(random.randrange(60))), "x", 0) for i in range(120)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "!", "x", 1), (1003, "the big 🎈 dog " * 20_000, "x", 2), (None, "of a null id", "x", 3), (rows[5][0], rows[5][1], "y", 4), (77, "other text of the id 77", "z", 5)]
    got = fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string, n string, k int")).collect()
    unique = list({(i, t or "") for i, t, *_ in rows})
    unique.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1]}".encode()).digest()))
    following = {r: unique[(at + 1) % len(unique)][1] for at, r in enumerate(unique)}
    want = []
    for i, t, *_ in rows:
        t, after = t or "", following[i, t or ""]
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        own = plain_spots(t)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(own, plain_spots(edited)), 9), round(jaccard(own, plain_spots(after)), 9)))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert all(r.fingerprint and r.edited_fingerprint for r in got)


def test_small_tables_and_plan(spark):
    empty = fingerprint_documents(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0
    one = fingerprint_documents(spark.createDataFrame([(1, "the one text of all")], "doc_id long, text string")).first()
    assert one.near_next == 1
    assert "Python" not in empty._jdf.queryExecution().toString()
