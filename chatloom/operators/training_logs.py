"""Rates from training logs: tokens per second, per device, and model FLOP utilization.

A log is a table ``(run, ts, tokens_seen)``. Rates are differences between
neighbouring records of a run, so the natural window is one run. A run may hold most of the
records; windows are therefore cut into time slices, and only the last record of each
slice is handed to the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Peak FLOP/s (16-bit) by a part of the device name, tried in this order.
PEAK_FLOPS = {"H200": 989e12, "H100": 989e12, "A100": 312e12}


def peak_flops(device_name: Column) -> Column:
    """Peak FLOP/s of a device by name; NULL when unknown."""
    out = F.lit(None).cast("double")
    for part, flops in reversed(PEAK_FLOPS.items()):
        out = F.when(F.contains(device_name, F.lit(part)), F.lit(flops)).otherwise(out)
    return out


def previous_records(log: DataFrame, starts: DataFrame | None = None, slice_seconds: int = 3600) -> DataFrame:
    """Each record that counts, with ``prev_ts`` and ``prev_tokens`` of the record before.

    Records without run, time or tokens do not count, nor does a second record at the same time (the one
    with the least tokens stays). *starts* ``(run, ts)`` gives the start of each run, which
    stands for zero tokens; a record at that very time does not count. Without *starts* the
    first record of a run only opens it.
    """
    records = log.where(F.col("tokens_seen").isNotNull()).select(
        "run",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("tokens_seen").cast("bigint").alias("tokens_seen"),
    )
    if starts is not None:
        # -1 marks a start: it is the least count at its time, so it wins there.
        records = records.unionByName(
            starts.select("run", F.col("ts").cast("timestamp").alias("ts"), F.lit(-1).cast("bigint").alias("tokens_seen"))
        )
    # Nulls go here, so that the two uses of the records below read one and the same shuffle.
    records = records.withColumn("_slice", F.expr(f"unix_seconds(ts) div {int(slice_seconds)}")).where(
        F.col("run").isNotNull() & F.col("_slice").isNotNull()
    )
    # Copies of a record meet before the shuffle (partial aggregation).
    unique = records.groupBy("run", "_slice", "ts").agg(F.min("tokens_seen").alias("tokens_seen"))
    in_slice = Window.partitionBy("run", "_slice").orderBy("ts")
    linked = unique.withColumn("_ts", F.lag("ts").over(in_slice)).withColumn(
        "_tokens", F.lag("tokens_seen").over(in_slice)
    )
    ends = unique.groupBy("run", "_slice").agg(
        F.max("ts").alias("_end"), F.max_by("tokens_seen", "ts").alias("_end_tokens")
    )
    slices = Window.partitionBy("run").orderBy("_slice")
    carried = ends.select(
        "run",
        "_slice",
        F.lag("_end").over(slices).alias("_carried_ts"),
        F.lag("_end_tokens").over(slices).alias("_carried_tokens"),
    )
    return (
        linked.join(carried, ["run", "_slice"], "left")
        .select(
            "run",
            "ts",
            "tokens_seen",
            F.coalesce("_ts", "_carried_ts").alias("prev_ts"),
            F.greatest(F.coalesce("_tokens", "_carried_tokens"), F.lit(0)).alias("prev_tokens"),
        )
        .where(F.col("prev_ts").isNotNull() & (F.col("tokens_seen") >= 0))
    )


def _rate() -> Column:
    elapsed = (F.unix_micros("ts") - F.unix_micros("prev_ts")) / F.lit(1e6)
    return (F.col("tokens_seen") - F.col("prev_tokens")) / elapsed


def throughput(
    log: DataFrame,
    starts: DataFrame | None = None,
    world_size: Column | int = 1,
    slice_seconds: int = 3600,
) -> DataFrame:
    """``tokens_per_sec`` and ``tokens_per_gpu_per_sec`` per record, in whole tokens."""
    size = F.lit(world_size) if isinstance(world_size, int) else world_size
    return previous_records(log, starts, slice_seconds).select(
        "run",
        "ts",
        "tokens_seen",
        F.bround(_rate(), 0).cast("bigint").alias("tokens_per_sec"),
        F.bround(_rate() / size, 0).cast("bigint").alias("tokens_per_gpu_per_sec"),
    )


def utilization(
    log: DataFrame,
    num_params: Column | int | None,
    peak: Column | float | None,
    starts: DataFrame | None = None,
    world_size: Column | int = 1,
    slice_seconds: int = 3600,
    digits: int = 4,
) -> DataFrame:
    """``mfu`` per record: achieved over peak FLOP/s at 6 FLOPs per token and parameter.

    No value where the parameter count or the peak is unknown.
    """

    def column(value, kind: str) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast(kind)

    size = F.lit(world_size) if isinstance(world_size, int) else world_size
    mfu = _rate() / size * 6 * column(num_params, "double") / column(peak, "double")
    return (
        previous_records(log, starts, slice_seconds)
        .select("run", "ts", "tokens_seen", F.bround(mfu, digits).alias("mfu"))
        .where(F.col("mfu").isNotNull())
    )
