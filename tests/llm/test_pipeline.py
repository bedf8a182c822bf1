"""The pipeline against plain versions of its stages."""

import corpus_pipeline
from tests.llm.test_queries import check_sequences, near_duplicate_classes, pieces_of
from tests.oracle import connect
from ticketspark.llm import toxicity
from ticketspark.llm.catalog import ORACLES
from ticketspark.llm.registry import table


def test_run(spark, data):
    con = connect(data)
    texts = dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op7_quality_rules']}) WHERE kept").fetchall()}
    model = toxicity.learn_from(table(spark, data, "documents"), table(spark, data, "labels"))
    gains = toxicity.Costs(model.toxic, model.ordinary) if model.toxic else None
    clean = {k: texts[k] for k in good if model.score(gains, texts[k].encode()) < corpus_pipeline.TOXIC}
    alone = {k for k, (_, c) in near_duplicate_classes(clean, 5, 80).items() if k == c}
    rows = corpus_pipeline.run(spark, data).collect()
    wanted = sorted(pieces_of({k: texts[k] for k in alone}))
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    check_sequences(rows, 4096)
    assert len(alone) < len(clean) < len(texts)


def test_near_duplicates_of_repeated_ids(spark, data):
    """Texts that share an id are judged each for itself."""
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    near = lambda text: text.rsplit(" ", 1)[0] + " end"
    rows = [(1, one), (1, two), (1, one), (2, near(two)), (3, near(one)), (4, three), (5, None), (5, ""), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicate_filter(spark, docs, data)
    assert kept.columns == docs.columns
    wanted = [(1, one), (1, two), (4, three), (5, None), (5, ""), (None, one)]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(wanted, key=str)
