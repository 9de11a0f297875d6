import random
import zlib

from plinth.llm.toxicity import Lexicon, fold, keep_clean, learn, score, score_toxicity


def test_folding():
    assert fold("1DI0T, іdiоt! idiot$$$ $tup1d").split() == ["idiot", "idiot", "idiot", "stupid"]
    assert fold("in 1995 it's ok").split() == ["in", "it", "s", "ok"] or "1995" in fold("in 1995")


def test_exceptions_and_length():
    made = Lexicon({" clown ": 4.0, " vequ": 5.0}).automaton()
    assert score("a clown fish swims", made) == 0 and score("a clown swims", made) > 0.9
    assert score("le vequmo est", made) > 0.9 > score("le vequmo " + "est " * 19_000, made) > 0.3
    assert score("", made) == 0 and score("clowns", made) == 0


def test_a_lone_weak_term_in_a_long_text():
    made = Lexicon({" stupid ": 3.0, " vequ": 5.0}).automaton()
    assert score("a stupid text", made) > 0.9
    assert score("stupid " + "est " * 20_000, made) < 0.3 < score("vequmo " + "est " * 20_000, made)


def test_labels_overrule_base_terms(spark):
    texts = ["a stupid mistake"] * 40 + ["you grumpf scum"] * 40 + ["plain words"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = learn(docs, spark.createDataFrame([(i, int("grumpf" in t)) for i, t in enumerate(texts)], "doc_id long, toxic int"))
    assert " stupid " not in lexicon.weights and " scum " in lexicon.weights and " idiot " in lexicon.weights
    assert [r.predicted for r in score_toxicity(docs, lexicon).collect()] == [int("grumpf" in t) for t in texts]


def test_held_out_accuracy_and_rows(spark):
    random.seed(5)
    syllables = ["ba", "ki", "lo", "mu", "ne", "ri", "so", "tu", "va", "ze"]
    word = lambda: "".join(random.choices(syllables, k=random.randint(1, 4)))
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        words = [word() for _ in range(random.randint(5, 200))]
        if toxic:
            words.insert(random.randrange(len(words)), random.choice(["grumpf", "blarg", "xoth" + word()]))
        rows.append((i, " ".join(words), "c", 0.5))
        if i % 3:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None, "c", 0.1), (9000, "", "c", 0.1)], "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([*labels, (None, 1), (4, None)], "doc_id long, toxic int")
    lexicon = learn(docs, marks)
    got = {r.doc_id: r for r in score_toxicity(docs, lexicon).collect()}
    truth = {i: i % 8 == 0 for i in range(1500) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(got[i].held_out for i in truth)
    assert sum(got[i].predicted == t for i, t in truth.items()) / len(truth) > 0.99
    assert got[None].score == 0 == got[9000].score
    kept = keep_clean(docs, lexicon)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = learn(docs, labels)
    assert score_toxicity(docs, lexicon).count() == 0 and keep_clean(docs, lexicon).count() == 0


def test_score_against_brute_force():
    import re
    from math import exp, isclose

    random.seed(3)
    parts = ["trash", "can", "clown", "class", "fish", "idiot", "vequmo", "vequ", "stupid", "easy", "est", "bracket", "loser"]
    weights = {" idiot ": 3.0, " vequ": 2.0, " vequmo ": 4.5, " clown ": 1.0, " trash ": 1.5, " stupid ": 2.5, " los": 0.5, " loser ": 0.25}
    phrases = ("trash can", "class clown", "clown fish", "stupid easy", "loser bracket", "can clown class clown")
    automaton = Lexicon(weights, phrases).automaton()
    for _ in range(400):
        folded = fold(" ".join(random.choices(parts, k=random.randint(0, 25))))
        spans = [(m.start(), m.start() + len(p) + 1) for p in phrases for m in re.finditer(f"(?= {p} )", folded)]
        heaviest = {}
        for term, weight in weights.items():
            for m in re.finditer(f"(?={re.escape(term)})", folded):
                heaviest[m.start()] = max(weight, heaviest.get(m.start(), 0))
        total = sum(w for at, w in heaviest.items() if not any(a <= at < b for a, b in spans))
        assert isclose(score(folded, automaton), 1 - exp(-total / (1 + len(folded.split()) / 2000)), abs_tol=1e-12)


def test_many_excused_phrases_take_linear_time():
    import time

    automaton = Lexicon({" clown ": 4.0}).automaton()
    began = time.perf_counter()
    assert score("class clown " * 100_000, automaton) == 0 and time.perf_counter() - began < 20


def test_learnt_weights_against_brute_force(spark):
    from collections import Counter
    from math import isclose, log

    from plinth.llm.toxicity import BASE_TERMS, terms

    random.seed(11)
    words = [f"v{c}{i}x" for c in "abcde" for i in range(40)]
    rows = [(d, " ".join(random.choices(words[:150] if d % 3 else words, k=60)) + (" grumpf" if d % 3 == 0 else "")) for d in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = learn(docs, spark.createDataFrame([(d, int(d % 3 == 0)) for d, _ in rows], "doc_id long, toxic int"), most=30).weights
    known = [(t, d % 3 == 0) for d, t in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    pos, neg = (Counter(x for t, y in known if y == toxic for x in terms(fold(t))) for toxic in (True, False))
    n_pos, n_neg = (sum(y == toxic for _, y in known) for toxic in (True, False))
    strong = [t for t in pos if pos[t] >= 3 and pos[t] >= 0.95 * (pos[t] + neg[t])]
    ranked = []
    for t in strong:
        share = (pos[t] + neg[t]) / (n_pos + n_neg)
        ratio = 2 * sum(c * log(c / (n * share)) for c, n in ((pos[t], n_pos), (neg[t], n_neg)) if c)
        weight = log((pos[t] + 0.5) / (n_pos + 1)) - log((neg[t] + 0.5) / (n_neg + 1))
        if ratio >= 2 * log(max(2, len(strong) * 20)) and weight > 0:
            ranked.append((-round(ratio, 9), t, min(6.0, weight)))
    want = dict(BASE_TERMS) | {t: w for _, t, w in sorted(ranked)[:30]}
    assert got.keys() == want.keys() and all(isclose(got[t], want[t], abs_tol=1e-9) for t in want) and " grumpf " in got
