from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 5

# Folder column of tables stored by month: year and month as one number (202603).
MONTH = "month_key"


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace a table and return it as stored. Keys are hex digests, which zstd halves and snappy leaves as they are."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def with_month(df: DataFrame, column: str) -> DataFrame:
    """Add the folder column for a date or a day number (20260315)."""
    is_date = isinstance(df.schema[column].dataType, T.DateType)
    month = month_key(F.col(column)) if is_date else F.floor(F.col(column) / 100).cast("int")
    return df.withColumn(MONTH, month)


def overwrite_by_month(df: DataFrame, path: str, column: str = "date", deal: bool = True) -> DataFrame:
    """Replace a table, one folder per month of a date or of a day number (20260315); return it as stored.

    The folder column is not part of what is returned. Rows are dealt by month before the write, so that a month is
    few files; a large month is split again by its size. ``deal=False`` saves that shuffle for rows that come from one
    already: each task then writes a file per month it holds. As a file holds one month, a comparison with a day also
    skips files by their statistics.
    """
    dealt = with_month(df, column)
    if deal:
        dealt = dealt.hint("rebalance", F.col(MONTH))
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).drop(MONTH)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at the path, in whatever store Spark reaches."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def append_or_replace(df: DataFrame, root: str, table: str) -> str:
    """Lookup tables are replaced, every other table grows."""
    path = f"{root.rstrip('/')}/{table}"
    df.write.mode("overwrite" if table.startswith("lookup_") else "append").parquet(path)
    return path


def write_with_sample(df: DataFrame, root: str, table: str) -> DataFrame:
    """The whole table as Parquet, plus its first five rows as a CSV and a Parquet sample."""
    root = root.rstrip("/")
    stored = overwrite(df, f"{root}/{table}")
    sample = stored.limit(SAMPLE_ROWS)
    sample.write.mode("overwrite").csv(f"{root}/samples/{table}_csv", header=True)
    sample.write.mode("overwrite").parquet(f"{root}/samples/{table}_parquet")
    return stored


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` win over rows of ``old`` with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` are added only where ``old`` lacks the key."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))



def merge_by_month(
    spark: SparkSession, path: str, new: DataFrame, keys: list[str], column: str, keep: str = "new"
) -> DataFrame:
    """Merge rows into a table of ``overwrite_by_month`` and return it as stored; ``keep`` names the side that wins.

    Only the months that the new rows lie in are read, merged and replaced; the files of all others stay. A key must keep
    its month, as keys of dated rows do. The merged months are written beside the table first, so a merge that
    fails leaves the table as it was, and one that is repeated gives the same rows. Without new rows nothing is written.
    """
    if keep not in ("new", "old"):
        raise ValueError("keep is 'new' or 'old'")
    # The month is a column of the folders; its type is stated so that a table of one odd month reads alike.
    stored = spark.read.schema(T.StructType([*new.schema.fields, T.StructField(MONTH, T.IntegerType())])).parquet(path)
    dated = with_month(new, column)
    months = [row[MONTH] for row in dated.select(MONTH).distinct().collect()]  # a row per month of the calendar
    if months:
        touched = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            touched = touched | F.col(MONTH).isNull()
        old = stored.where(touched).select(dated.columns)
        merged = (upsert if keep == "new" else insert_missing)(old, dated, keys)
        beside = overwrite(merged, f"{path.rstrip('/')}_merging")
        writer = beside.hint("rebalance", F.col(MONTH)).write.mode("overwrite").partitionBy(MONTH)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return spark.read.schema(new.schema).parquet(path).drop(MONTH)
