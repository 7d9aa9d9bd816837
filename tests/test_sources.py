import uuid
import warnings
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import files, jdbc, sinks
from ledgerloom.sources.zones import Zones, shared_scratch

CONNECTION = jdbc.JdbcConnection("jdbc:x:y", "some.Driver", {"user": "u", "password": "p"})
BASE_OPTIONS = {
    "url": "jdbc:x:y", "driver": "some.Driver", "user": "u", "password": "p", "fetchsize": "10000",
}


class RecordingReader:
    """One ``spark.read``: records the options it was loaded with, gives fixed bounds."""

    def __init__(self, session):
        self.session, self.current = session, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def options(self, **items):
        self.current.update(items)
        return self

    def load(self):
        self.session.loads.append(self.current)
        return SimpleNamespace(first=lambda: self.session.bounds)

    def jdbc(self, url, table, predicates, properties):
        self.session.loads.append(
            {"url": url, "dbtable": table, "predicates": predicates, **properties}
        )


class RecordingSession:
    """Stands in for a session, since no database may be started here."""

    def __init__(self, bounds=(1, 9)):
        self.loads, self.bounds = [], bounds

    @property
    def read(self):
        return RecordingReader(self)


def test_jdbc_table_options():
    spark = RecordingSession()
    with pytest.warns(UserWarning, match="T1 is read by one task"):
        jdbc.read_table(spark, CONNECTION, "T1")
    assert spark.loads == [{**BASE_OPTIONS, "dbtable": "T1"}]


def test_jdbc_partitioned_options():
    spark = RecordingSession()
    jdbc.read_table(spark, CONNECTION, "T1", "ID", 6)
    probe, scan = spark.loads
    assert probe["dbtable"] == jdbc.bounds_table("T1", "ID")
    assert scan == {
        **BASE_OPTIONS, "dbtable": "T1", "partitionColumn": "ID", "lowerBound": "1",
        "upperBound": "9", "numPartitions": "6",
    }


def test_jdbc_partitioned_read_of_an_empty_table():
    spark = RecordingSession((None, None))
    jdbc.read_table(spark, CONNECTION, "T1", "ID")
    assert spark.loads[1] == {**BASE_OPTIONS, "dbtable": "T1"}


def test_jdbc_query_and_slices():
    spark = RecordingSession()
    with pytest.warns(UserWarning, match="one task"):
        jdbc.read_query(spark, CONNECTION, "SELECT 1 FROM T1")
    jdbc.read_table(spark, CONNECTION, "T1", predicates=["a", "b"])
    assert spark.loads[0] == {**BASE_OPTIONS, "query": "SELECT 1 FROM T1"}
    assert spark.loads[1] == {**BASE_OPTIONS, "dbtable": "T1", "predicates": ["a", "b"]}
    with pytest.raises(ValueError):
        jdbc.read_table(spark, CONNECTION, "T1", "ID", predicates=["a"])


def test_table_source_drives_jdbc():
    spark = RecordingSession()
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        files.TableSource("t", "T1", "jdbc", connection=CONNECTION, one_task=True).read(spark)
        files.TableSource(
            "t", "SELECT 1", "jdbc", connection=CONNECTION, is_query=True, one_task=True
        ).read(spark)
    files.TableSource("t", "T1", "jdbc", connection=CONNECTION, slice_on="ID",
                      num_partitions=3).read(spark)
    assert [set(load) - set(BASE_OPTIONS) for load in spark.loads] == [
        {"dbtable"}, {"query"}, {"dbtable", "predicates"},
    ]
    files.TableSource("t", "T1", "jdbc", connection=CONNECTION, slice_on="ID", cuts=(5, 9)).read(spark)
    files.TableSource("t", "T1", "jdbc", connection=CONNECTION, predicates=("a", "b")).read(spark)
    assert [load["predicates"] for load in spark.loads[3:]] == [
        ["ID < 5 OR ID IS NULL", "ID >= 5 AND ID < 9", "ID >= 9"], ["a", "b"],
    ]
    with pytest.raises(ValueError, match="connection"):
        files.TableSource("t", "T1", "jdbc").read(spark)


def test_bounds_probe_is_valid_sql(spark):
    spark.range(3, 8).createOrReplaceTempView("numbers")
    row = spark.sql(f"SELECT * FROM {jdbc.bounds_table('numbers', 'id')}").first()
    assert tuple(row) == (3, 7)


@pytest.mark.parametrize(
    "low, high, want",
    [
        (1, 9, ("1", "9")),
        (Decimal("-1.5"), Decimal("2.5"), ("-2", "3")),
        (0.5, 1.5, ("0", "2")),
        (date(2024, 1, 1), date(2024, 2, 1), ("2024-01-01", "2024-02-01")),
        (datetime(2024, 1, 1, 2), datetime(2024, 2, 1), ("2024-01-01 02:00:00", "2024-02-01 00:00:00")),
        (None, None, None),
    ],
)
def test_bounds_of_all_kinds(low, high, want):
    assert jdbc.bound_texts(low, high) == want


def test_text_bounds_are_refused():
    with pytest.raises(TypeError, match="even_slices"):
        jdbc.bound_texts("a", "z")


@settings(max_examples=12, deadline=None)
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=30),
    cuts=st.lists(st.integers(-50, 50), max_size=4, unique=True).map(sorted),
    slices=st.integers(1, 6),
)
def test_slices_hold_every_row_once(spark, values, cuts, slices):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for predicates in (jdbc.value_slices("v", cuts), jdbc.even_slices("v", slices)):
        hits = sum((F.expr(f"CASE WHEN {p} THEN 1 ELSE 0 END") for p in predicates), F.lit(0))
        assert df.filter(hits != 1).count() == 0


def test_date_slices_are_valid_sql(spark):
    df = spark.sql("SELECT DATE '2024-01-15' AS d UNION ALL SELECT NULL")
    counts = [df.filter(p).count() for p in jdbc.value_slices("d", [date(2024, 1, 1)])]
    assert counts == [1, 1]


def test_zone_paths():
    assert Zones("file:/data/").table("raw", "t") == "file:/data/raw/t"
    assert Zones("s3a://").table("raw", "t") == "s3a://raw/t"


def test_scratch_uses_the_shared_folder(spark):
    first, second = shared_scratch(spark, "x"), shared_scratch(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(f"{root}/x-")
    assert not sinks.path_exists(spark, first)


def test_scratch_without_a_folder_is_in_the_warehouse(spark):
    session = spark.newSession()
    root = session.conf.get("spark.checkpoint.dir")
    conf = SimpleNamespace(
        get=lambda key, *default: None if key == "spark.checkpoint.dir" else session.conf.get(key, *default)
    )
    without = SimpleNamespace(conf=conf, _jvm=session._jvm, _jsc=session._jsc)
    warehouse = session.conf.get("spark.sql.warehouse.dir")
    assert root and shared_scratch(without, "x").startswith(f"{warehouse}/_scratch/x-")


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_written_rows_are_counted_once(spark, path):
    df = spark.range(100).repartition(4)
    assert sinks.write_table(df, path).rows == 100
    assert sinks.write_table(df.limit(0), path).rows == 0
    assert sinks.write_table(df, path, "append").rows == 100
    assert sinks.write_table(df, path, "ignore").rows == 0
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(df, path, "error")
    with pytest.raises(ValueError, match="merge"):
        sinks.write_table(df, path, "merge")
    with pytest.raises(ValueError, match="partition_by"):
        sinks.write_table(df, path, replace_partitions=True)


def test_hot_partition_is_split_over_files(spark, path):
    """Nearly all rows share one date; rebalancing must not write them from one task."""
    df = spark.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") < 10, "d1").otherwise("d2").alias("day"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2m")
    try:
        sinks.write_table(df, path, partition_by=["day"], rebalance=True)
    finally:
        spark.conf.set(key, before)
    table = spark.read.parquet(path)
    assert table.count() == 300_000
    assert len([f for f in table.inputFiles() if "day=d2" in f]) > 1


def test_dynamic_overwrite_prunes(spark, path):
    df = spark.range(20).select("id", (F.col("id") > 9).cast("int").alias("half"))
    sinks.write_table(df, path, partition_by=["half"])
    sinks.write_table(
        df.filter("half = 1").withColumn("id", -F.col("id")), path, partition_by=["half"],
        replace_partitions=True,
    )
    table = spark.read.parquet(path)
    assert table.filter("half = 0 AND id >= 0").count() == 10
    assert table.filter("half = 1 AND id < 0").count() == 10
    plan = table.filter("half = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(half" in plan


def test_csv_misfits_are_kept(spark, path):
    spark.createDataFrame([("1,a",), ("x,b",), ("3,c",)], "v string").write.text(path)
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
    landed = files.read_csv(spark, path, schema, header=False)
    good, bad = files.split_corrupt(landed.cache())
    assert sorted(r.n for r in good.collect()) == [1, 3]
    assert [r[files.CORRUPT_COLUMN] for r in bad.collect()] == ["x,b"]
