import datetime as dt

import pytest
from pyspark.sql import types as T

from tests.frames import column, rows, series
from ticketspark import session, sources

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("issue_date", T.DateType()), T.StructField("note", T.StringType())]
)


def write(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)


def test_files_are_united_by_name(spark, tmp_path):
    write(tmp_path, "a.csv", "Id , Issue_Date\n1,2024-01-02\n2,bad\n")
    write(tmp_path, "b.csv", 'note,id\n"x, y",3\n')
    write(tmp_path, "c.csv", "note,id\nz,4\n")
    write(tmp_path, "empty.csv", "")
    out = sources.read_events(spark, str(tmp_path), SCHEMA)
    assert out.columns == ["id", "issue_date", "note"]
    assert rows(out, "id") == [(1, dt.date(2024, 1, 2), None), (2, None, None), (3, None, "x, y"), (4, None, "z")]


def test_no_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_events(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        sources.read_predictions(spark, f"{tmp_path}/predictions_*.csv")


def test_predictions_contract(spark, tmp_path):
    head = "date,split,y_true,y_pred,model"
    write(tmp_path, "predictions_a.csv", f"{head}\n2024-01-01,test,1,2,A\n")
    write(tmp_path, "predictions_b.csv", f"{head},horizon\n2024-01-03,val,1.5,2,B,3\n")
    out = sources.read_predictions(spark, f"{tmp_path}/predictions_*.csv")
    assert rows(out.select("model", "horizon", "y_true"), "model") == [("A", 1, 1.0), ("B", 3, 1.5)]
    write(tmp_path, "predictions_c.csv", "date,split,y_true\n2024-01-01,test,1\n")
    with pytest.raises(ValueError, match="y_pred"):
        sources.read_predictions(spark, f"{tmp_path}/predictions_*.csv")


def test_partitioned_write_prunes_on_read(spark, tmp_path):
    df = series(spark, range(40)).selectExpr("series_id", "month(date) AS month", "y")
    path = sources.write_table(df, str(tmp_path / "t"), partition_by=["month"])
    back = sources.read_table(spark, path)
    assert back.count() == 40
    assert len({r[0] for r in back.where("month = 2").selectExpr("input_file_name()").collect() if "month=1" in r[0]}) == 0
    csv = sources.write_table(df, str(tmp_path / "c"), "csv")
    assert sources.read_table(spark, csv, "csv", df.schema).count() == 40


def test_daily_dates_are_lenient(spark, tmp_path):
    write(tmp_path, "d.csv", "date,n\n2024-01-01,4\nnope,5\n")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("n", T.LongType())])
    assert rows(sources.read_daily(spark, str(tmp_path / "d.csv"), schema), "n") == [(dt.date(2024, 1, 1), 4), (None, 5)]


class _Conf(dict):
    pass


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf(conf)


def test_scratch_follows_the_session_setting(spark):
    named = _Session(**{"spark.checkpoint.dir": "hdfs://store/shared/"})
    assert session.scratch_path(named, "x").startswith("hdfs://store/shared/ticketspark/x-")
    assert session.scratch_path(_Session(), "x").split("/ticketspark/")[0] == session._local_scratch()
    out = session.materialize(series(spark, [1, 2]), "kept")
    assert column(out, "y", "date") == [1.0, 2.0]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import types

    def given(**conf):
        return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, default=None: conf.get(k.replace(".", "_"), default)))

    for master in ("spark://host:7077", "local-cluster[2,1,512]", "yarn"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.scratch_path(given(spark_master=master), "x")
    assert session.scratch_path(given(spark_master="yarn", spark_checkpoint_dir="/shared/"), "x").startswith("/shared/ticketspark/x-")
    assert session.scratch_path(given(spark_master="local[8]"), "x")
