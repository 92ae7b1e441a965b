"""Table scans and access probes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from .local import local_rows


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A path in one of the file formats, or a catalog table name with ``fmt='table'``."""
    if fmt == "table":
        return spark.table(source)
    return spark.read.format(fmt).options(**options).load(source)


def scan(df: DataFrame, columns: list[str] | None = None, where: str | None = None,
         case: str | None = None) -> DataFrame:
    """Chosen columns under a predicate, names upper- or lower-cased for a side."""
    if where:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    if case:
        df = df.toDF(*[c.upper() if case == "upper" else c.lower() for c in df.columns])
    return df


#: So many rows are work enough for a task of the checks.
ROWS_A_TASK = 100_000


def spread(df: DataFrame) -> DataFrame:
    """A table dealt over the cores where its files would give most rows to a few tasks; else as it is.

    Splits follow bytes and row groups: a well compressed table of a million rows may be one split. Counting rows a split reads no
    column, and one row reaches the driver.
    """
    splits = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = splits.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_A_TASK))
    return df.repartition(tasks) if most > ROWS_A_TASK and most * tasks > 1.5 * rows else df


def probe(spark: SparkSession, source: str, fmt: str = "parquet") -> tuple[bool, str | None]:
    """Can one row be read? Returns the error class when not."""
    try:
        read_table(spark, source, fmt).limit(1).take(1)
        return True, None
    except Exception as error:  # any failure means "not accessible", as a result and not a crash
        get_condition = getattr(error, "getCondition", None)
        condition = get_condition() if get_condition else None
        return False, condition or type(error).__name__


def access_report(spark: SparkSession, sources: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """``(table_name, accessible, error)`` for a list of tables, one probe each."""
    rows = [(name, *probe(spark, path, fmt)) for name, path in sources.items()]
    return local_rows(spark, rows, "table_name string, accessible boolean, error string")


def files_of(df: DataFrame) -> list[list]:
    """Name, size and time of the files a table is read from; one listing per folder."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    names, found = set(df.inputFiles()), []
    for folder in sorted({name.rsplit("/", 1)[0] for name in names}):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for status in path.getFileSystem(conf).listStatus(path):
            raw = status.getPath().toUri().getRawPath().rsplit("/", 1)[1]
            if f"{folder}/{raw}" in names:
                found.append([folder, raw, status.getLen(), status.getModificationTime()])
    return sorted(found)
