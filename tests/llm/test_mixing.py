import hashlib
import re
from collections import defaultdict
from fractions import Fraction

from plinth.llm.mixing import mix, mixed_rows

SCHEMA = "doc_id long, text string, source string, size int, key string"


def water_fill(sizes, share=Fraction(3, 2), weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = share * sum(sizes.values()), {}
    while len(done) < len(names):
        rest = [s for s in names if s not in done]
        level = Fraction(total - sum(done.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] > 2 * sizes[s]]
        if not over:
            return done | {s: level * weight[s] for s in rest}
        done |= {s: 2 * sizes[s] for s in over}
    return done


def expected(rows):
    docs = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s, int(hashlib.md5(f"{'' if i is None else i}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:15], 16)) for i, t, s, *_ in rows]
    sizes = defaultdict(int)
    for _, n, s, _ in docs:
        sizes[s] += n
    target, out = water_fill(sizes), []
    for s, size in sizes.items():
        passes = int(target[s] / size) if size else 0
        left, done = target[s] - passes * size, 0
        keys = defaultdict(int)
        for _, n, t, k in docs:
            if t == s:
                keys[k] += n
        taken = set()
        for k in sorted(keys):
            if left and 2 * done + keys[k] <= 2 * left:
                taken.add(k)
                done += keys[k]
            else:
                break
        out += [(i, n, size, round(float(target[s]), 6), n * (passes + (k in taken))) for i, n, t, k in docs if t == s]
    return sorted(out, key=str)


def test_mix_matches_a_plain_walk(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i * 37 % 90)) + "\n\t x", f"src{i % 5}" if i % 3 else "hot", 1, "k") for i in range(400)]
    rows += [(None, "a b c", None, 1, "k"), (None, None, "hot", 1, None), (500, "", "only-empty", 1, "k"), (501, "u v " * 30_000, "Long", 1, "k"), (502, "one two", "src1", 1, "k"), (502, "one two", "src1", 1, "k")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix(docs).collect()]
    assert sorted(got, key=str) == expected(rows)
    again = mixed_rows(docs)
    assert again.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in again.collect())
    assert words == sum(x[-1] for x in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs).count() == 0 and mixed_rows(docs).count() == 0
