"""Time the headline queries; prints one JSON line.

Every query is run once untimed at the same data to warm the JVM, then twice, of which the
better time counts. The extra fields put the figures into the units the checks are usually quoted in: seconds per
column for the column check and seconds per million rows of one side for the hash check.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from paritas.session import build_session  # noqa: E402
from paritas.workload import pairs  # noqa: E402
from paritas.workload.catalogue import QUERIES  # noqa: E402

HEADLINE = [
    "meta_check", "column_check", "hash_check", "reconcile", "hash_full_outer", "dup_key_fanout",
    "profile_continuous", "table_fingerprint", "column_fingerprint", "row_count_by_day", "parse_date_std",
    "norm_by_type",
]


def consume(df) -> None:
    df.write.mode("overwrite").format("noop").save()


def timed(fn) -> float:
    started = time.perf_counter()
    fn()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("paritas-bench", f"local[{cpus}]", **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")

    def line_pair(**options):
        # the given file is one row group, hence one task: as its caller, deal the rows out first
        pair = pairs.lineitem_pair(spark, sf, **options)
        return replace(pair, left=pair.left.repartition(int(cpus), "ORDER_ID", "LINE_NO"),
                       right=pair.right.repartition(int(cpus), "order_id", "line_no"))

    def line_columns():
        consume(line_pair().column_check())

    def line_hashes():
        consume(line_pair(keys=["ORDER_ID", "LINE_NO"], hash_all=True).hash_check(scoped=False))

    runs = {name: (lambda f=QUERIES[name]: consume(f(spark, sf))) for name in HEADLINE}
    runs["lineitem_column_check"] = line_columns
    runs["lineitem_hash_check"] = line_hashes
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    figures = {}
    for name, run in runs.items():
        if only and name not in only:
            continue
        run()
        figures[name] = min(timed(run), timed(run))
        print(f"{name}: {figures[name]} s", file=sys.stderr)
    rows = pairs.table(spark, sf, "lineitem").count()
    out = {
        "metric": "total_seconds", "value": round(sum(figures.values()), 3), "unit": "sec", "queries": figures,
        "sf": os.path.basename(sf.rstrip("/")), "lineitem_rows": rows,
    }
    if "lineitem_column_check" in figures:
        out["column_check_sec_per_column"] = round(figures["lineitem_column_check"] / len(pairs.LINEITEM_CROSSWALK), 3)
    if "lineitem_hash_check" in figures:
        out["hash_check_sec_per_million_rows"] = round(figures["lineitem_hash_check"] * 1e6 / rows, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
