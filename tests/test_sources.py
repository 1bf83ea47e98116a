import pytest
from pyspark.sql import functions as F

from shelfmark.sources import readers as rd
from shelfmark.sources import staging
from shelfmark.sources import writers as wr

from conftest import rows

DDL = "id int, name string, ok boolean, score double, n int"


def _write(tmp_path, text, name="a.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_declared_schema(spark, tmp_path):
    path = _write(tmp_path, "id,name,ok,score,n\n1,a,True,1.5,2.0\n2,,False,,\n3,c,maybe,x,y\n")
    assert rows(rd.read_csv(spark, path, DDL)) == [
        (1, "a", True, 1.5, 2), (2, None, False, None, None), (3, "c", None, None, None)]


def test_quotes_and_line_breaks(spark, tmp_path):
    path = _write(tmp_path, 'id,name,ok,score,n\n1,"say ""hi"",\nthen go",True,1,1\n')
    [got] = rows(rd.read_csv(spark, path, DDL, multiline=True, escape='"'))
    assert got[1] == 'say "hi",\nthen go'


def test_line_breaks_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\nd\\e', None), (2, None, 2.5)], "id int, t string, v double")
    path = str(tmp_path / "out")
    wr.write_csv(df, path)
    back = rd.read_csv(spark, path, "id int, t string, v double", multiline=True, escape='"')
    assert sorted(rows(back)) == sorted(rows(df))


def test_all_parts_of_a_folder(spark, tmp_path):
    path = str(tmp_path / "parts")
    wr.write_csv(spark.range(100).repartition(5), path)
    assert rd.read_csv(spark, path, "id long").count() == 100
    wr.write_csv(spark.range(10).repartition(5), path, single_file=True)
    assert len(list((tmp_path / "parts").glob("part-*.csv"))) == 1


def test_inferred_and_cast(spark, tmp_path):
    path = _write(tmp_path, "a,b\n1,2.0\n2,\n")
    df = rd.read_csv_inferred(spark, path, {"b": "int", "absent": "int"})
    assert df.dtypes == [("a", "int"), ("b", "int")] and rows(df) == [(1, 2), (2, None)]


@pytest.mark.parametrize("cols", [["a"], ["b"], ["a", "b", "c"]])
def test_lenient_skips_broken_rows(spark, tmp_path, cols):
    path = _write(tmp_path, "a,b,c\n1,x,1.5\n2,y,3,4\n3,z,oops\n")
    df = rd.read_lenient(spark, path, "a int, b string, c string", numeric=["c"])
    full = [(1, "x", 1.5), (3, "z", None)]
    assert rows(df.select(*cols)) == [tuple(r["abc".index(c)] for c in cols) for r in full]
    assert df.count() == 2


def test_snapshot_overwrites(spark, tmp_path):
    paths = [str(tmp_path / "x"), str(tmp_path / "y")]
    wr.write_snapshot(spark.range(5), paths)
    wr.write_snapshot(spark.range(3), paths)
    assert [rd.read_parquet(spark, p).count() for p in paths] == [3, 3]


def test_named_results(spark, tmp_path):
    wr.write_results({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path / "r"), fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "r" / "b")).count() == 3
    wr.write_results({"a": spark.range(2)}, str(tmp_path / "c"))
    assert rd.read_csv(spark, str(tmp_path / "c" / "a"), "id long").count() == 2


def test_partitioned_parquet(spark, tmp_path):
    path = str(tmp_path / "p")
    wr.write_parquet(spark.range(10).withColumn("k", F.col("id") % 2), path, ["k"])
    assert rd.read_parquet(spark, path).where("k = 1").count() == 5


def test_missing_models(tmp_path, spark):
    with pytest.raises(FileNotFoundError):
        rd.load_als(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        rd.load_features(str(tmp_path / "none"))


def test_stage_fixes_a_table(spark):
    df = spark.range(100).withColumn("r", F.rand())
    fixed = staging.stage(df, "random")
    assert rows(fixed.orderBy("id")) == rows(fixed.orderBy("id"))
    assert fixed.schema.simpleString() == df.schema.simpleString()


def test_scratch_goes_below_the_warehouse_where_no_folder_is_named():
    class Conf:
        def get(self, key, default=None):
            return "hdfs://store/warehouse/" if key == "spark.sql.warehouse.dir" else default

    class Context:
        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    assert staging.shared_dir(Session()) == "hdfs://store/warehouse/_scratch"


def test_scopes_delete_what_is_written_in_them(spark):
    from pathlib import Path

    from shelfmark.sources import staging as sg

    def there(df):
        return Path(df.inputFiles()[0].removeprefix("file://")).exists()

    with sg.scope():
        outer = sg.stage(spark.range(3), "outer")
        with sg.scope():
            inner = sg.stage(outer, "inner")
            result = sg.hand_out(inner.where("id > 0"), "result")
            files = inner.inputFiles()
        assert not Path(files[0].removeprefix("file://")).exists() and there(outer) and result.count() == 2
    with pytest.raises(ValueError):
        with sg.scope():
            lost = sg.stage(spark.range(3), "lost")
            files = lost.inputFiles()
            raise ValueError
    assert not Path(files[0].removeprefix("file://")).exists()
    assert sg.stage(spark.range(4), "kept").count() == 4
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key, None) is None
