"""A named run of the checks over a list of pairs.

Each stage of each pair is one Parquet table below ``base/run/stage/pair``, with a manifest of what it was made from: the input
files of both sides with size and time, the plans over them, the mapping, the windows and the options. A stage counts as complete
only under the same manifest; anything else is computed again and replaces what was there. A pair that fails costs its own row of the
outcome only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..sources.local import local_rows
from ..sources.results import run_path, write_result
from ..sources.scan import files_of
from .pair import ALL, ReconPair

STAGES: dict[str, Callable[[ReconPair], DataFrame]] = {
    "meta_check": ReconPair.meta,
    "column_check": ReconPair.column_check,
    "hash_check": ReconPair.hash_check,
    "reconcile": ReconPair.reconcile,
}
DONE, RESUMED, FAILED = "DONE", "RESUMED", "FAILED"
OUTCOME_SCHEMA = "table_name string, stage string, status string, error string"
MANIFEST_SCHEMA = "digest string, made_from string"

Opener = Callable[[str], DataFrame]


def pair_of(row: Row, open_left: Opener, open_right: Opener, crosswalk: DataFrame, base: str | None = None, **options) -> ReconPair:
    """The pair that a row of the pair list (``controls.read_pairs``) asks for.

    Names, date columns, partition, window, conditions and the mapping come from the row; the mapping falls
    back to the right table's own name. ``crosswalk`` holds the mappings of all tables under ``col_map``.
    """
    get = lambda name: row[name] if name in row else None
    table = row["right_tbl"].split(".")[-1].lower()
    mapping = (get("col_map") or table).lower()
    asked = {
        "partition": get("partition") or ALL, "start": get("start_dt") or None, "end": get("end_dt") or None,
        "left_where": get("left_where"), "right_where": get("right_where"), "base": base,
    }
    return ReconPair(
        table, open_left(row["left_tbl"]), open_right(row["right_tbl"]), crosswalk.where(F.lower("col_map") == mapping).drop("col_map"),
        get("left_var"), get("right_var"), **{**asked, **options})


def _rows(df: DataFrame | None) -> list[str]:
    """A small control table as sorted JSON; mappings are as long as a schema, windows as a calendar."""
    return [] if df is None else sorted(df.toJSON().collect())


def made_from(pair: ReconPair) -> dict:
    """What the results of a pair depend on."""
    tables = {"left", "right", "crosswalk", "vintage_windows", "rules", "base"}
    sides = {side: {"files": files_of(df), "plan": df.semanticHash(), "schema": df.schema.simpleString()} for side, df in (("left", pair.left), ("right", pair.right))}
    options = {f.name: getattr(pair, f.name) for f in fields(pair) if f.name not in tables}
    rules = {name: getattr(rule, "__qualname__", str(rule)) for name, rule in pair.rules.items()}
    return {**sides, "crosswalk": _rows(pair.crosswalk), "windows": _rows(pair.vintage_windows), "options": options, "rules": rules}


def digest_of(told: dict) -> str:
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


@dataclass
class Run:
    """Stages over pairs below one folder of shared storage."""

    spark: SparkSession
    base: str
    name: str

    def path(self, stage: str, table: str) -> str:
        return run_path(self.base, self.name, stage, table)

    def _manifest(self, stage: str, table: str) -> str:
        return run_path(self.base, self.name, f"{stage}-manifest", table)

    def _exists(self, path: str) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        mark = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return mark.getFileSystem(conf).exists(mark)

    def complete(self, stage: str, table: str, digest: str | None = None) -> bool:
        """Is the stage's table there, made from what ``digest`` says (or from anything)?"""
        manifest = self._manifest(stage, table)
        if not (self._exists(self.path(stage, table)) and self._exists(manifest)):
            return False
        return digest is None or [r["digest"] for r in self.spark.read.schema(MANIFEST_SCHEMA).json(manifest).collect()] == [digest]

    def _write(self, stage: str, table: str, result: DataFrame, told: dict) -> None:
        """The manifest is emptied before the table is replaced and written behind it, so a run cut short leaves no false claim."""
        manifest = lambda rows: write_result(local_rows(self.spark, rows, MANIFEST_SCHEMA).coalesce(1), self._manifest(stage, table), "json")
        manifest([])
        write_result(result, self.path(stage, table))
        manifest([(digest_of(told), json.dumps(told, sort_keys=True))])

    def carry_out(self, makers: dict[str, Callable[[], ReconPair]], stages: Iterable[str] = tuple(STAGES)) -> DataFrame:
        """Run ``stages`` for all pairs, one after the other; one row per pair and stage."""
        rows, stages = [], list(stages)
        for name, make in makers.items():
            pair = told = None
            for stage in stages:
                try:
                    if pair is None:
                        pair = make()
                        told = made_from(pair)
                    if self.complete(stage, name, digest_of(told)):
                        rows.append((name, stage, RESUMED, None))
                        continue
                    self._write(stage, name, STAGES[stage](pair), told)
                    rows.append((name, stage, DONE, None))
                except Exception as error:  # the outcome of a pair, not of the run
                    condition = getattr(error, "getCondition", lambda: None)()
                    rows.append((name, stage, FAILED, condition or type(error).__name__))
        return local_rows(self.spark, rows, OUTCOME_SCHEMA)

    def results(self, stage: str, tables: Iterable[str], vintages: list[str] | None = None) -> DataFrame | None:
        """The stage's tables of the pairs that have one, under ``table_name``; ``vintages`` chooses some."""
        out = None
        for table in tables:
            if not self.complete(stage, table):
                continue
            rows = self.spark.read.parquet(self.path(stage, table)).withColumn("table_name", F.lit(table))
            if vintages is not None and "vintage" in rows.columns:
                rows = rows.where(F.col("vintage").isin(vintages))
            out = rows if out is None else out.unionByName(rows)
        return out
