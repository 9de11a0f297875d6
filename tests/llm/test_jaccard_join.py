import random
import re
from fractions import Fraction

import numpy as np

from plinth.llm.jaccard_join import CountTree, bound, common, group_keys, groups_of, keep_one_of_each, link_documents, size_class

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, t=Fraction(9, 10)):
    sets = []
    for _, text, *_ in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= t * len(sets[i] | sets[j]) or rows[i][0] is not None and rows[i][0] == rows[j][0]:
                top[root(i)] = root(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, *_), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def fixture(seed=4):
    random.seed(seed)
    word = lambda: random.choice(["the", "of", *(f"W{i}" for i in range(500))])
    rows, common = [], [word() for _ in range(30)]
    for _ in range(25):
        base = [word() for _ in range(random.choice([2, 3, 5, 12, 22, 40, 90, 200, 500]))]
        if random.random() < 0.5:
            base += common
        for _ in range(random.choice([1, 2, 2, 5, 30])):
            w = list(base)
            for _ in range(random.randint(0, max(1, len(w) // 45))):
                at = random.randrange(len(w))
                w[at : at + random.choice([0, 1, 1, 2])] = random.choice([[], [word()], ["x"]])
            rows.append((len(rows) * 7 % 1009, " ".join(w), "x", 1))
    return rows


def test_components_match_brute_force(spark):
    for seed in (4, 5):
        rows = fixture(seed)
        rows += [(2000, None, "x", 1), (2001, "", "x", 1), (None, "a b c d e f g h i j k l m", "x", 1), (None, "A b c d e f g h i j k l M", "x", 1), (2002, "one", "x", 1), (2003, "ONE\n", "x", 1), (2003, "other words here", "x", 1)]
        rows += [(2004, "long word salad " * 6_000 + "end", "x", 1), rows[0]]
        docs = spark.createDataFrame(rows, "doc_id long, text string, d string, comp int")
        got = sorted(map(tuple, link_documents(docs).collect()), key=str)
        assert got == brute(rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = {x[2] for x in brute(rows) if x[2] is not None}
    assert {r.doc_id for r in kept.collect()} - {None} == want


def near_sets(r, n, t, wide=0):
    """A set and one made of it that is linked to it, the similarity being close to the threshold."""
    a = r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    if wide:  # few groups are filled
        a = a >> np.uint64(wide) << np.uint64(1)
    while True:
        drop, add = (int(x) for x in r.integers(0, int(n * (1 - t)) + 2, 2))
        if n > drop and (n - drop) >= t * (n + add):
            return np.unique(a), np.unique(np.concatenate([a[drop:], r.integers(0, 2**63, add, dtype=np.uint64) * np.uint64(2)]))


def test_linked_sets_have_a_key_in_common():
    r, shared = np.random.default_rng(1), []
    for t in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        for trial in range(300):
            a, b = near_sets(r, int(r.choice([1, 2, 3, 5, 8, 9, 10, 11, 14, 18, 19, 27, 50, 200, 400])), t, wide=(0, 0, 0, 20)[trial % 4])
            both = len(np.intersect1d(a, b))
            if both < t * (len(a) + len(b) - both):
                continue
            x, y = group_keys(a, t), group_keys(b, t)
            shared.append(len(np.intersect1d(x, y)))
            assert shared[-1]
            ca, cb = (np.bincount((s & np.uint64(127)).astype(int), minlength=128) for s in (a, b))
            assert bound(ca[None], cb, np.array([len(a)]), len(b), t / (1 + t))[0]
            assert common(a, [b, a]).tolist() == [both, len(a)]
    a, b = (np.unique(r.integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)) for _ in range(2))
    assert len(shared) > 500 and not len(np.intersect1d(group_keys(a, Fraction(9, 10)), group_keys(b, Fraction(9, 10))))


def test_groups_outnumber_differences():
    for t in (Fraction(9, 10), Fraction(4, 5)):
        for size in [*range(1, 200), 5000, 10**6]:
            low, high = size_class(size)
            assert low <= size <= high and size_class(low) == size_class(high)
            differ, count = groups_of(high, low, t)
            assert count > differ >= (2 * size) * (1 - t) / (1 + t) - 1


def test_chunks_and_large_ids(spark):
    """A key dealt out in chunks gives the same; ids may be as large as they come."""
    rows = [(d + 2**62 if d % 3 else d, text) for d, text, *_ in fixture(9)] + [(2**63 - 1, "a b c d"), (2**63 - 2, "A B C D"), (-5, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for chunk in (1500, 1 << 21):
        assert sorted(map(tuple, link_documents(docs, chunk=chunk).collect()), key=str) == want


def crowd(n, changed, seed):
    """Texts that differ from one text in some words, so that hardly two are linked."""
    random.seed(seed)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(n):
        w = list(base)
        for at in random.sample(range(150), changed):
            w[at] = f"x{random.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    return rows


def test_crowds(spark):
    for changed in (2, 4):
        rows = crowd(150, changed, 3)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        for chunk in (3000, 1 << 21):
            assert sorted(map(tuple, link_documents(docs, chunk=chunk).collect()), key=str) == brute(rows)


def test_full_groups_prune_no_copies():
    counts = np.full((3, 128), 65535, dtype=np.uint16)  # of sets with 70,000 hashes in each group
    counts[2] = 100
    sizes, share = np.array([70_000 * 128, 70_000 * 128, 12_800]), Fraction(9, 19)
    assert bound(counts, counts[0], sizes, int(sizes[0]), share).tolist() == [True, True, False]
    assert sorted(CountTree(counts, sizes).near(counts[0], int(sizes[0]), share)) == [0, 1]


def test_meetings(spark, monkeypatch):
    import plinth.llm.jaccard_join as module

    random.seed(2)
    rows = [(p, [random.randrange(60) for _ in range(random.randint(0, 4))] + [1000 + p, 99][: 1 + (p % 3 == 0)]) for p in range(150)]
    rows = [(p, sorted(set(k))) for p, k in rows]
    points = spark.createDataFrame(rows, "p long, keys array<long>").repartition(5)
    want = {(k, p) for p, keys in rows for k in keys if sum(k in other for _, other in rows) > 1}
    for combined in (1, 50, 1 << 21):
        monkeypatch.setattr(module, "COMBINED", combined)
        got = module.meetings(points).collect()
        assert len(got) == len(want) and {(r.key, r.p) for r in got} == want and all((r.key, r.lo) in want and r.lo <= r.p for r in got)
        assert sum(r.lo == r.p for r in got) == len({k for k, _ in want}) or combined < 1 << 21


def test_tree_finds_what_a_scan_finds():
    r = np.random.default_rng(2)
    counts = r.poisson(6, (3000, 32)).astype(np.uint16)
    counts[1000:2000] = np.maximum(counts[:1000].astype(int) + r.integers(-1, 2, (1000, 32)) * (r.random((1000, 32)) < 0.1), 0)
    sizes = counts.sum(axis=1).astype(np.int64)
    tree, share = CountTree(counts, sizes), Fraction(9, 19)
    for x in range(0, 3000, 37):
        want = np.flatnonzero(bound(counts, counts[x], sizes, sizes[x], share))
        assert sorted(tree.order[tree.near(counts[x], sizes[x], share)]) == want.tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert link_documents(docs).count() == 0 and keep_one_of_each(docs).count() == 0


def test_folded_counts_bound_as_well():
    from plinth.llm.jaccard_join import counted, folded, groups_for

    r = np.random.default_rng(5)
    a = np.unique(r.integers(0, 2**63, 3000, dtype=np.uint64))
    made = {g: np.bincount((a & np.uint64(g - 1)).astype(int), minlength=g).astype(np.uint16) for g in (128, 512, 1024)}
    assert groups_for(3000) == 1024 and groups_for(100) == 128
    assert (folded(made[1024][None], 128)[0] == made[128]).all() and (counted([made[512].tobytes(), made[1024].tobytes()])[1] == made[512]).all()
    assert folded(np.full((1, 256), 65000, dtype=np.uint16), 128).max() == 65535
