"""Small control tables as local relations, folded into the plan without a job."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few literal rows under a DDL schema."""
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [()] * len(struct.fields)
    arrow = to_arrow_schema(struct)
    table = pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=struct)
