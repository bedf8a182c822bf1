"""What the text operators keep of an executor's memory."""

import pyarrow as pa
from pyspark.sql import functions as F

from ticketspark.llm import neardup, packing, quality, toxicity
from ticketspark.session import BATCH_BYTES, in_small_batches

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])


def test_texts_go_to_python_in_small_batches(spark):
    """Batches were bounded by Spark's 64 MiB alone; all rows still go."""
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))
    model = toxicity.Model(b"", b"", (0.0,))
    for use in (
        lambda: packing.tokenize(docs, packing.default_path(), with_ids=False),
        lambda: toxicity.score_texts(docs, model),
        lambda: neardup._features(docs, "doc_id", "text", 5),
    ):
        spark.conf.unset(BOUND)
        use()
        found = docs.mapInArrow(_sizes, "n long, size long").collect()
        assert sum(r.n for r in found) == 6000
        assert max(r.size for r in found) < BATCH_BYTES + 8000


def test_a_smaller_bound_of_the_session_stays(spark):
    docs = spark.range(1)
    for given, wanted in (("1m", "1m"), ("4096", "4096"), ("64MB", str(BATCH_BYTES)), (str(BATCH_BYTES + 1), str(BATCH_BYTES))):
        spark.conf.set(BOUND, given)
        in_small_batches(docs)
        assert spark.conf.get(BOUND) == wanted
    spark.conf.unset(BOUND)


def test_the_sample_of_the_rules_needs_no_python_workers(spark):
    """The sample was a list of rows, which Python workers passed on in each of the jobs that time the rules."""
    rows = [(f"text {i} of some words" if i % 5 else None,) for i in range(400)]
    docs = spark.createDataFrame(rows, "text string").repartition(4)
    sample = quality.sample_of(docs)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    picked = docs.where(F.pmod(F.xxhash64("text"), F.lit(quality.SAMPLE_STEP)) == 0)
    assert sorted(r.text for r in sample.collect()) == sorted(r.text for r in picked.collect())
    assert quality.sample_of(docs.where("false")).collect() == []
