"""Small constant tables built JVM-side (no Python worker round trip)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, rows: Sequence[Sequence], ddl: str) -> DataFrame:
    """A DataFrame of literal rows with schema ``ddl`` (e.g. "a string, b bigint").

    ``spark.createDataFrame(list)`` ships pickled rows through Python
    workers; an inline array of literal structs stays inside the JVM plan.
    """
    schema = StructType.fromDDL(ddl)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.range(1).select(F.inline(F.array(*structs)))
