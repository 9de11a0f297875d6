import random

from plinth.llm.licenses import GAP, LEAST, NOTICES, PHRASES, scan_licenses, telling, verified_licenses

TEXT = dict(NOTICES)


def brute(text):
    """Labels of notices by trying all chains from all places."""
    words, spans = text.lower().split(), []
    for label, notice in NOTICES:
        t, (kept, other) = notice.split(), telling()[label]
        n = len(t) - 1
        hits = [(p, q) for p in range(len(words) - 1) for q in range(n) if words[p : p + 2] == t[q : q + 2]]
        for p, q in hits:
            best, todo = None, [[(p, q)]]
            while todo:
                c = todo.pop()
                if len(c) / n >= LEAST and all(any(k in (y, y + 1) for _, y in c) for k in kept) and not set(words[p : c[-1][0] + 2]) & set(other):
                    best = max(best or (0, 0), (len(c), c[-1][0] + 2))
                todo += [[*c, (x, y)] for x, y in hits if x > c[-1][0] and y > c[-1][1] and x - p < n + GAP and abs(x - y - p + q) <= GAP]
            if best:
                spans.append((-best[0], -best[0] / n, label, p, best[1]))
    return {s[2] for s in spans if not any(o[2] != s[2] and o < s and o[:3] < s[:3] and 2 * (min(o[4], s[4]) - max(o[3], s[3])) > s[4] - s[3] for o in spans)}


def labels(spark, texts, scan=verified_licenses):
    rows = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [set(r.labels.split(",")) - {"", *dict(PHRASES)} for r in sorted(rows, key=lambda r: r.doc_id)]


def test_words_that_tell_notices_apart(spark):
    cc = "licensed under cc by {} 4 0"
    shuffled = " xx ".join(" ".join(p) for p in zip(TEXT["bsd"].split()[::2], TEXT["bsd"].split()[1::2], strict=False))
    texts = [TEXT["gpl-2.0"], TEXT["gpl-3.0"], TEXT["lgpl"] + " version 3", cc.format("nc"), cc.format("sa"), cc.format("nc sa"), cc.format("nd"), TEXT["cc-by-4.0"], TEXT["mpl-2.0"].replace("v 2 0", "v 1 0"), TEXT["isc"].replace("purpose", "use"), shuffled]
    want = [{"gpl-2.0"}, {"gpl-3.0"}, {"lgpl"}, {"cc-by-nc-4.0"}, {"cc-by-sa-4.0"}, set(), set(), {"cc-by-4.0"}, set(), {"isc"}, set()]
    assert labels(spark, texts) == want
    assert [len(x) for x in labels(spark, texts[:2], scan_licenses)] == [2, 2]  # what the vote alone gives


def test_order_and_extent(spark):
    halves = TEXT["mit-text"].split()
    turned = " ".join(halves[10:] + halves[:10])
    stretched = " ".join(w + " filler" * (3 * (i % 7 == 6)) for i, w in enumerate(halves))
    assert labels(spark, [turned, stretched, " ".join(halves), "so " + " ".join([*halves[:8], "very", *halves[8:]])]) == [set(), set(), {"mit-text"}, {"mit-text"}]


def test_verified_matches_a_plain_walk(spark):
    random.seed(3)
    bits = [n for _, n in NOTICES] + [p for _, p in PHRASES] + ["nc", "version 2", "version 3", "the", "licensed under"]
    texts = []
    for _ in range(300):
        words = " ".join(random.choices(bits, k=random.randrange(5))).split(" ")
        texts.append(" ".join(w for w in (random.choice(["zz", "", "nc", w + " " + w]) if random.random() < 0.06 else w for w in words) if w))
    assert labels(spark, texts) == list(map(brute, texts))


def test_rows_and_other_columns_are_those_of_the_scan(spark):
    rows = [(None, None), (1, ""), (2, "mit"), (5, "MIT License"), (5, "MIT License"), (6, "gnu general public license " * 3), (7, "cc by " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same = lambda df: sorted(map(str, df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()))
    assert verified_licenses(docs).columns == scan_licenses(docs).columns
    assert same(verified_licenses(docs)) == same(scan_licenses(docs))
    assert verified_licenses(docs.limit(0)).count() == 0
