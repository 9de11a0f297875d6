import re

import corpus_pipeline
from plinth.llm.toxicity import learn, score

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_take_effect(spark, tmp_path):
    import random

    random.seed(6)
    word = lambda: "w" + str(random.randrange(3000))
    texts = [[word() for _ in range(random.randint(20, 120))] for _ in range(120)]
    rows = [(i, " ".join(w), "en", f"src{i % 4}", 0) for i, w in enumerate(texts)]
    rows += [(200 + i, rows[i][1], "en", "src1", 0) for i in range(10)]  # exact copies of 0 to 9
    near = [[*texts[i][:-1], "changed"] for i in range(20, 30)]
    rows += [(300 + i, " ".join(w), "en", "src2", 0) for i, w in enumerate(near)]
    rows += [(400 + i, " ".join([*texts[40 + i], "grumpf"][::-1]), "en", "src3", 0) for i in range(20)]
    rows += [(500, None, None, None, None), (501, "", "en", "src0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 0) for i in range(120)] + [(400 + i, 1) for i in range(20)], "doc_id long, toxic int")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")

    made, columns = docs, docs.columns
    seen = {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made, folder).write.parquet(f"{folder}/{at}")
        made = spark.read.parquet(f"{folder}/{at}")
        seen[name] = made
        assert at == 4 or made.columns == columns
    automaton = learn(docs, labels).automaton()
    clean = {r.doc_id for r in docs.collect() if score(r.text or "", automaton) < 0.3}
    assert {r.doc_id for r in seen["toxicity"].collect()} == clean and not clean & set(range(400, 420))
    exact = {r.doc_id for r in seen["exact_dedup"].collect()}
    assert exact == clean - set(range(10)) - {500} and set(range(200, 210)) <= exact
    linked = {300 + i for i in range(10) if len({tuple(texts[20 + i][k : k + 5]) for k in range(len(texts[20 + i]) - 4)}) >= 9}
    assert {r.doc_id for r in seen["jaccard_join"].collect()} == exact - linked
    taken = [r.doc_id for r in seen["mixing"].collect()]
    assert set(taken) <= exact - linked and max(taken.count(i) for i in set(taken)) == 2
    packed = seen["packing"]
    assert sorted(packed.where("start = 0").select("doc_id").rdd.map(lambda r: r[0]).collect()) == sorted(taken)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.select("doc_id", "start", "doc_tokens").where("start = 0").collect())) == sorted(map(tuple, packed.select("doc_id", "start", "doc_tokens").where("start = 0").collect()))
