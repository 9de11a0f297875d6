import hashlib
import random
import re

import pytest

from plinth.llm.substring_dedup import dedup_substrings, levels
from plinth.llm.suffix_dedup import find_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, n_words int"


def covered(rows, window):
    """The positions of each row's words that a window with a smaller id covers."""
    least = {}
    words = [WORD.findall(t or "") for _, t, *_ in rows]
    number = [2**63 - 1 if i is None else i for i, *_ in rows]
    for d, w in zip(number, words, strict=True):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            least[key] = min(d, least.get(key, d))
    out = []
    for d, w in zip(number, words, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p : p + window])] < d:
                gone |= set(range(p, p + window))
        out.append((w, gone))
    return out


def fixture():
    random.seed(9)
    word = lambda: random.choice(["the", "of", "and", *(f"w{i}" for i in range(300))])
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 64, 120, 400)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(random.randint(1, 4)):
            words += [word() for _ in range(random.randint(0, 80))]
            if random.random() < 0.6:
                p = list(random.choice(passages))
                if random.random() < 0.4:
                    p[random.randrange(len(p))] = "edit"
                if random.random() < 0.3:
                    p = p[random.randrange(len(p) // 2) :]
                words += p
        rows.append((i * 3 % 100, random.choice([" ", "\n", " \t"]).join(words), "k", 1))
    rows += [(7, None, "k", 1), (None, " ".join(passages[3]), "k", None), (200, "", "k", 1), (201, " ".join(passages[4]), "k", 1), (202, " ".join(passages[4]), "k", 1)]
    rows += [(300 + i, "a " * 60 + "b" * i, "k", 2) for i in range(3)] + [(310, "x y " * 9_000, "k", 1), (311, "x y " * 8_000 + "z", "k", 1), rows[0]]
    return rows


def test_levels_double():
    assert levels(50) == [13, 25, 50] and levels(130) == [9, 17, 33, 65, 130] and levels(7) == [4, 7] and levels(1) == [1, 1]


@pytest.mark.parametrize("window", [1, 7, 14, 50, 130])
def test_removed_words_match_brute_force(spark, window):
    rows = fixture()
    got = sorted(map(tuple, dedup_substrings(spark.createDataFrame(rows, SCHEMA), window).collect()), key=str)
    want = []
    for (i, *_), (words, gone) in zip(rows, covered(rows, window), strict=True):
        kept = [w for p, w in enumerate(words) if p not in gone]
        want.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_repeated_spans_match_brute_force(spark):
    rows = fixture()
    got = sorted(((r.doc_id, r.n_words, r.n_repeated, r.spans) for r in find_repeats(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for (i, *_), (words, gone) in zip(rows, covered(rows, 50), strict=True):
        edges = [p for p in sorted(gone) if p - 1 not in gone], [p + 1 for p in sorted(gone) if p + 1 not in gone]
        want.append((i, len(words), len(gone), ",".join(f"{a}:{b}" for a, b in zip(*edges, strict=True))))
    assert got == sorted(want, key=str)


def test_no_candidates(spark):
    """Where no gram of the first level repeats, nothing is looked at further."""
    rows = [(i, " ".join(f"w{i}_{j}" for j in range(80)), "k", 1) for i in range(5)]
    assert {(r.doc_id, r.n_words, r.n_removed) for r in dedup_substrings(spark.createDataFrame(rows, SCHEMA)).collect()} == {(i, 80, 0) for i in range(5)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert dedup_substrings(docs).count() == 0 and find_repeats(docs).count() == 0


def test_null_and_largest_ids(spark):
    """Rows without an id are told apart by 64 bits of their text; an id of 2**63 - 1 comes back as it is."""
    from plinth.llm.suffix_dedup import find_repeats

    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, f"n{i} " * (i % 7 + 1) + text) for i in range(40)] + [(2**63 - 1, text + " end"), (5, "x " + text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_words): r.n_removed for r in dedup_substrings(docs, 50).collect()}
    assert got[(5, 81)] == 0 and got[(2**63 - 1, 81)] == 80 and sum(d is None for d, _ in got) and all(v == 80 for (d, _), v in got.items() if d != 5)
    assert {(r.doc_id, r.n_repeated) for r in find_repeats(docs, 50).collect()} == {(None, 80), (2**63 - 1, 80), (5, 0)}


@pytest.fixture
def no_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_dealt_out_once(spark, tmp_path, no_broadcasts):
    """Both the search and the result join the texts; all that the result shuffles stays well below twice what the texts take."""
    random.seed(4)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"{random.getrandbits(64):x}" for _ in range(400)] + passage), "k", 1) for i in range(300)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))

    def stages():
        context = spark.sparkContext._jsc.sc()
        context.listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
        listed = context.statusStore().stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (listed.apply(i) for i in range(listed.size()))}

    def written(run):
        before = stages()
        run()
        return sum(n for k, n in stages().items() if k not in before)

    once = written(lambda: docs.repartition(4, "doc_id").write.format("noop").mode("overwrite").save())
    got = []
    result = dedup_substrings(docs)
    in_all = written(lambda: got.extend(result.collect()))
    assert {(r.doc_id, r.n_removed) for r in got} == {(i, 60 if i else 0) for i in range(300)}
    assert once / 2 < in_all < 1.5 * once
