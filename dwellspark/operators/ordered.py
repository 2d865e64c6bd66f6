"""Running sums and maxima over a global order, distributed.

A window function ordered over the whole table without a partition key runs
in one task.  Instead:

1. range-partition on the (unique) order key and sort inside partitions —
   Spark samples the key, so even a hot time range is split evenly;
2. per partition, a vectorised cumulative sum (``mapInPandas``; the only
   per-partition sequential step) — no shuffle; each row is tagged with its
   partition id and the result is written once to the shared checkpoint
   dir, so the two passes below read identical partitions;
3. per-partition totals (one row per partition), an exclusive prefix sum
   (or maximum) over them, broadcast back and added.

Memory per task is one Arrow batch; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark.session import cut_lineage


def running_sums(df: DataFrame, order_cols: Sequence[str], weights: dict[str, str],
                 num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums ``out = Σ weight`` in ``order_cols`` order.

    ``weights`` maps output column → non-negative integer weight column.
    ``order_cols`` must order rows totally (include a unique id).
    """
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges neighbours, so partition order still follows the key order.
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order_cols)
    else:
        ranged = df.repartitionByRange(*order_cols)
    ordered = ranged.sortWithinPartitions(*order_cols)

    local_names = {out: f"_local_{out}" for out in weights}
    schema = T.StructType(list(ordered.schema.fields)
                          + [T.StructField("_pid", T.IntegerType())]
                          + [T.StructField(c, T.LongType()) for c in local_names.values()])

    def local_cumsum(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        acc = {out: 0 for out in weights}
        for pdf in batches:
            pdf = pdf.copy()
            pdf["_pid"] = pid
            for out, wcol in weights.items():
                cs = pdf[wcol].fillna(0).astype("int64").cumsum() + acc[out]
                if len(cs):
                    acc[out] = int(cs.iloc[-1])
                pdf[local_names[out]] = cs.astype("int64")
            yield pdf

    # Written once to the shared checkpoint dir: the partition id and the
    # local sums are stored with each row, so both passes below (totals and
    # the join) read the same result and the Python step runs once.
    local = cut_lineage(ordered.mapInPandas(local_cumsum, schema))
    totals = local.groupBy("_pid").agg(*[F.max(c).alias(f"_tot_{out}") for out, c in local_names.items()])
    # one row per partition: bounded by the partition count
    prefix = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_tot_{out}").over(prefix), F.lit(0))
                                      .cast("bigint").alias(f"_off_{out}") for out in weights])
    joined = local.join(F.broadcast(offsets), "_pid")
    for out, c in local_names.items():
        joined = joined.withColumn(out, F.col(f"_off_{out}") + F.col(c))
    return joined.drop("_pid", *local_names.values(), *[f"_off_{o}" for o in weights])


_NONE = -(1 << 63)


def running_max(df: DataFrame, order_cols: Sequence[str], value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: the largest ``value`` (BIGINT) of all rows *before* the row in ``order_cols`` order.

    Null where there is none before; null values raise no maximum.
    ``order_cols`` must order rows totally (include a unique id).
    """
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ordered = ranged.sortWithinPartitions(*order_cols).withColumn("_value", F.coalesce(F.col(value), F.lit(_NONE)))
    schema = T.StructType(list(ordered.schema.fields)
                          + [T.StructField("_pid", T.IntegerType()), T.StructField("_before", T.LongType())])

    def local_cummax(batches):  # over Arrow: columns with nulls go through unchanged
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        top = np.array([_NONE], dtype="int64")
        for batch in batches:
            upto = np.maximum.accumulate(np.concatenate([top, batch.column("_value").to_numpy()]))
            top = upto[-1:]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, pid, dtype="int32")), pa.array(upto[:-1])],
                                             schema.names)

    local = cut_lineage(ordered.mapInArrow(local_cummax, schema))
    tops = local.groupBy("_pid").agg(F.max("_value").alias("_top"))
    # one row per partition: bounded by the partition count
    prefix = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tops.select("_pid", F.max("_top").over(prefix).alias("_earlier"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.nullif(F.greatest("_before", "_earlier"), F.lit(_NONE)))
            .drop("_pid", "_value", "_before", "_earlier"))
