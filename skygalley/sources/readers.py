from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skygalley.operators.cleaning import drop_columns
from skygalley.sources.schemas import RAW_DATASETS, SEEDS
from skygalley.sources.sinks import MONTH, month_key

# Larger than any file, so that a file is one task.
WHOLE_FILE = 1 << 60


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task's input; the rest of the file is never asked for."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def headers(spark: SparkSession, path: str) -> DataFrame:
    """Rows (header, files): the files that a path or pattern names, by their first line.

    A Spark job over the file list: each file is one task that reads its first lines only, so many files are
    opened by all executors at once. Empty files and files whose first line is empty are left out.
    """
    # Settings of a session of its own: no file is split, none shares a task, rows are handed on one by one.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(WHOLE_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(WHOLE_FILE))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.text(path).select(F.col("value").alias("header"), F.col("_metadata.file_path").alias("file"))
    first = lines.mapInArrow(_first_row, "header string, file string").where("header <> ''")
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """What the driver needs to plan the read: the names of the files, which Spark lists there anyway."""
    try:
        # paths come escaped, as in a URL
        return {r["header"]: [unquote(f) for f in r["files"]] for r in headers(spark, path).collect()}
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise


def read_raw(spark: SparkSession, folder: str, dataset: str, fmt: str = "csv") -> DataFrame:
    """All files of one raw dataset as one frame, columns renamed to the engine's names.

    CSV columns are matched by each file's own header: files of one header are read together, so files may add columns
    or order them differently. Prohibited columns are dropped here and so never reach a table.
    """
    spec = RAW_DATASETS[dataset]
    path = f"{folder.rstrip('/')}/{spec.pattern}"

    def named(df: DataFrame) -> DataFrame:
        df = drop_columns(df, spec.prohibited)
        have = set(df.columns)
        missing = [header for header, _, _ in spec.columns if header not in have]
        if missing:
            raise ValueError(f"{dataset}: missing columns {missing}")
        return df.select(
            *[F.col(f"`{header}`").cast(kind).alias(name) for header, name, kind in spec.columns]
        )

    if fmt == "parquet":
        return named(spark.read.option("mergeSchema", "true").parquet(path))
    groups = _files_by_header(spark, path)
    if not groups:
        raise ValueError(f"{dataset}: no file with a header at {path}")
    # The header decides the columns (all text, no inference scan); a file that disagrees with it is an error.
    frames = [
        named(spark.read.csv(files, sep=spec.separator, header=True, enforceSchema=False))
        for _, files in sorted(groups.items())
    ]
    return reduce(DataFrame.unionByName, frames)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_seed(spark: SparkSession, path: str, seed: str) -> DataFrame:
    """A small lookup. No hint: Catalyst broadcasts it while its file size is under the threshold."""
    return spark.read.csv(path, schema=SEEDS[seed], header=True, enforceSchema=False)


def read_mart_since(spark: SparkSession, path: str, since: str, column: str = "date") -> DataFrame:
    """A mart from a day on: months before it are never listed for the scan, and the day is pushed into it."""
    mart, day = spark.read.parquet(path), F.to_date(F.lit(since))
    if column == "date" and MONTH in mart.columns:
        mart = mart.where(F.col(MONTH) >= month_key(day)).drop(MONTH)
    return mart.where(F.col(column) >= day)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A warehouse table over JDBC; give a partition column so that many tasks share the read."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None and bounds is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load()
