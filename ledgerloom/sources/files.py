"""Reading zone tables and landed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.ranges import balanced_predicates
from ledgerloom.sources.jdbc import JdbcConnection, even_slices, read_cuts, value_slices
from ledgerloom.sources.jdbc import read_query as read_jdbc_query
from ledgerloom.sources.jdbc import read_table as read_jdbc_table

CORRUPT_COLUMN = "_corrupt_record"


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A Parquet table; ``merge_schema`` unites the columns of all files.

    Merging reads every footer, so it is for tables whose columns changed.
    """
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_whole_text(spark: SparkSession, path: str) -> str:
    """One small text file, such as a mapping file, from any store Spark reaches."""
    return spark.read.text(path, wholetext=True).first()[0]


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Landed CSV with a declared schema, so no pass is spent on inference.

    Lines that do not fit keep their text in ``_corrupt_record``. Spark parses only
    the columns a query asks for, so a query on fewer columns overlooks misfits in
    the others: write the table whole before splitting it (``land_csv`` does).
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return (
        spark.read.options(**(options or {}))
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .schema(full)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, rows with their raw text) of a written table from :func:`read_csv`."""
    good = df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    return good, df.filter(F.col(CORRUPT_COLUMN).isNotNull())


@dataclass(frozen=True)
class TableSource:
    """One table to ingest, as data.

    ``format`` is ``jdbc`` or a Spark file format. For files ``location`` is the
    path. For JDBC it is the table, or a query when ``is_query`` is set. A table is
    sliced by one of: ``partition_column`` in evenly spaced ranges; ``slice_on`` with
    ``cuts`` in the ranges between these; ``predicates``, such as row-id ranges; or
    ``slice_on`` alone by its remainder, at the cost of a scan per slice. ``balanced``
    has the source find the cuts of ``slice_on`` for ``num_partitions`` even slices, and
    divides values that fill several by ``spread_by``, a whole-number expression; the
    probe sorts that column once. A table or query that is small says ``one_task``.
    """

    name: str
    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    connection: JdbcConnection | None = None
    partition_column: str | None = None
    num_partitions: int = 4
    slice_on: str | None = None
    cuts: Sequence[int | date] = ()
    balanced: bool = False
    spread_by: str | None = None
    predicates: Sequence[str] = ()
    is_query: bool = False
    one_task: bool = False
    columns: Sequence[str] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        df = self._read_jdbc(spark) if self.format == "jdbc" else self._read_files(spark)
        return df.select(*self.columns) if self.columns else df

    def _read_files(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.schema:
            reader = reader.schema(self.schema)
        return reader.load(self.location)

    def _read_jdbc(self, spark: SparkSession) -> DataFrame:
        if self.connection is None:
            raise ValueError(f"{self.name}: a jdbc source needs a connection")
        if self.is_query:
            return read_jdbc_query(spark, self.connection, self.location, self.one_task)
        predicates = list(self.predicates)
        if self.slice_on and self.balanced and not predicates:
            cuts = read_cuts(
                spark, self.connection, self.location, self.slice_on, self.num_partitions
            )
            predicates = balanced_predicates(self.slice_on, cuts, self.spread_by)
        elif self.slice_on and not predicates:
            predicates = (
                value_slices(self.slice_on, self.cuts) if self.cuts
                else even_slices(self.slice_on, self.num_partitions)
            )
        return read_jdbc_table(
            spark,
            self.connection,
            self.location,
            self.partition_column,
            self.num_partitions,
            predicates,
            self.one_task,
        )
