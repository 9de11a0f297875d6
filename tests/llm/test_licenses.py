import random
import re

from plinth.llm.licenses import NOTICES, PHRASES, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels, best = [], set(), 0.0
    for label, phrase in PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    bands = {}
    for base, listed in ((True, PHRASES), (False, NOTICES)):
        for label, text_ in listed:
            t = text_.split()
            hits = sorted((i - j, j) for i in range(len(words) - 1) for j in range(len(t) - 1) if words[i : i + 2] == t[j : j + 2])
            last, seen = None, set()
            for d, j in hits:
                if last is not None and d - last > (0 if base else 2):
                    seen = set()
                last = d
                seen.add(j)
                part = len(seen) / (len(t) - 1)
                best = max(best, part)
                bands[base, label] = max(part, bands.get((base, label), 0))
    every = labels | {label for (base, label), part in bands.items() if not base and part >= 0.8}
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(every)), round(best, 9)


def test_scan_matches_a_plain_walk(spark):
    random.seed(11)
    bits = [p for _, p in PHRASES] + [n for _, n in NOTICES] + ["MIT", "License", "cc", "by", "BY", "the", "Grüße", "x1", "apache\n", "GNU general", "licensed under"]
    rows = [(i, " ".join(w if random.random() > 0.05 else "zz" for w in ", ".join(random.choices(bits, k=random.randrange(6))).split(" ")), i) for i in range(250)]
    rows += [(None, None, 0), (900, "", 1), (901, "!!! ...", 1), (902, "mit", 1), (903, "word " * 60_000 + "CC-BY cc by", 1), (5, "MIT License", 2), (5, "MIT License", 2)]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    have = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in got.collect()), key=str)
    assert have == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert scan_licenses(docs).count() == 0
    plan = scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
