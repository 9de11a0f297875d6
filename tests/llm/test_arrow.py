import pyarrow as pa

from plinth.llm.toxicity import Lexicon, keep_clean


def test_batches_have_few_bytes_whatever_a_row_has(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 3000, 1, 1).selectExpr("id as doc_id", "repeat(concat('word ', id, ' '), 1000) as text")
    assert keep_clean(docs, Lexicon({})).count() == 3000  # any operator sets it

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    got = docs.mapInArrow(run, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 5 << 20
