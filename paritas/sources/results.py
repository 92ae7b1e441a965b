"""Stage results: a run layout on shared storage, and cut points between stages."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F


def run_path(base: str, run: str, step: str | None, name: str) -> str:
    """``base/run[/step]/name`` with empty parts left out and slashes trimmed."""
    parts = [p.strip("/") for p in (run, step, name) if p and p.strip("/")]
    return "/".join([base.rstrip("/"), *parts])


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for intermediate tables.

    Taken from ``spark.checkpoint.dir`` or the context's checkpoint folder; a session that has neither writes below
    its warehouse, unless that is a folder of the driver's machine which the executors of a cluster do not see.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return below_warehouse(warehouse, spark.sparkContext.master)


def below_warehouse(warehouse: str, master: str) -> str:
    on_one_machine = warehouse.startswith("file:") or ":" not in warehouse
    if on_one_machine and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir (or a base) to a folder that all machines share")
    return f"{warehouse}/scratch"


def scratch(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh path below ``base`` or the shared folder; what is written there goes when the program ends."""
    path = f"{(base or shared_dir(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    atexit.register(_discard, spark, path)
    return path


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str, base: str | None = None) -> DataFrame:
    """Cut the lineage behind a stage result: written as Parquet to shared storage and read again.

    Later stages read what was written, also after losing executors, instead of repeating the scans behind it. So what was
    exchanged for it is not kept either.
    """
    path = scratch(df.sparkSession, label, base)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove a stored stage whose successors are written; the program's end would do it later."""
    remove(df.sparkSession, df.scratch_path)


def _discard(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None:
        return
    try:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the program is ending; whatever is left is scratch
        pass


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write one step result; snappy parquet, JSON lines, or CSV with a header."""
    options = {"parquet": {"compression": "snappy"}, "csv": {"header": "true"}, "json": {"ignoreNullFields": "false"}}
    df.write.mode("overwrite").format(fmt).options(**options.get(fmt, {})).save(path)
    return path


def read_result(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a step result; text formats take the schema instead of guessing it."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_run(df: DataFrame, base: str, run: str, step: str, fmt: str = "parquet") -> str:
    """Results partitioned by run and step below one base path; writing a step again replaces it and leaves the others.

    An empty result replaces nothing, so a step that has become empty is removed first.
    """
    spark = df.sparkSession
    remove(spark, f"{base.rstrip('/')}/run_name={run}/step={step}")
    tagged = df.withColumns({"run_name": F.lit(run), "step": F.lit(step)})
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_name", "step").format(fmt).save(base)
    return base
