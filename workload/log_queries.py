"""Training-log rates, device peaks and run folders."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import functions as F

from chatloom.functions.folders import new_path
from chatloom.operators.training_logs import peak_flops, throughput, utilization
from chatloom.sources.run_folders import map_runs
from chatloom.streaming.log_rates import stream_rates, use_rocksdb_state
from workload import shapes

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str):
    def add(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return add


LOG = """log AS (
  SELECT user_id AS run, ts, CASE WHEN event_type <> 'error' THEN event_id * 1000 + trunc(value)::BIGINT END AS tokens
  FROM events)"""
# Zero tokens at the start of a run, then the least count at each time.
RECORDS = """starts AS (SELECT run, min(ts) AS ts, -1 AS tokens FROM log GROUP BY run),
records AS (
  SELECT run, ts, min(tokens) AS tokens
  FROM (SELECT * FROM log WHERE tokens IS NOT NULL UNION ALL SELECT * FROM starts) GROUP BY run, ts),
linked AS (
  SELECT *, lag(ts) OVER w AS prev_ts, greatest(lag(tokens) OVER w, 0) AS prev_tokens
  FROM records WINDOW w AS (PARTITION BY run ORDER BY ts)),
rates AS (
  SELECT run, ts, tokens, (tokens - prev_tokens) / ((epoch_us(ts) - epoch_us(prev_ts)) / 1e6::DOUBLE) AS rate
  FROM linked WHERE prev_ts IS NOT NULL AND tokens >= 0)"""


def _round(value: str) -> str:
    return f"CAST(round_even({value}, 0) AS BIGINT)"


@query(
    "throughput",
    f"""WITH {LOG}, {RECORDS}
SELECT run, epoch_us(ts) AS ts_us, tokens AS tokens_seen, {_round("rate")} AS tokens_per_sec,
  {_round("rate / 4")} AS tokens_per_gpu_per_sec FROM rates""",
)
def throughput_query(spark, sf_dir):
    rates = throughput(
        shapes.training_log(spark, sf_dir), shapes.run_starts(spark, sf_dir), world_size=4, slice_seconds=86400
    )
    return rates.select(
        "run", F.unix_micros("ts").alias("ts_us"), "tokens_seen", "tokens_per_sec", "tokens_per_gpu_per_sec"
    )


_PARAMS, _PEAK = 70_000_000_000, 312e12


@query(
    "mfu",
    f"""WITH {LOG}, {RECORDS}
SELECT run, epoch_us(ts) AS ts_us, tokens AS tokens_seen,
  round_even(rate / 4 * 6 * {float(_PARAMS)!r}::DOUBLE / {_PEAK!r}::DOUBLE, 4) AS mfu FROM rates""",
)
def mfu_query(spark, sf_dir):
    values = utilization(
        shapes.training_log(spark, sf_dir),
        _PARAMS,
        _PEAK,
        shapes.run_starts(spark, sf_dir),
        world_size=4,
        slice_seconds=86400,
    )
    return values.select("run", F.unix_micros("ts").alias("ts_us"), "tokens_seen", "mfu")


_DEVICES = """CASE event_type WHEN 'click' THEN 'NVIDIA H200 141GB' WHEN 'view' THEN 'NVIDIA H100 80GB HBM3'
  WHEN 'purchase' THEN 'NVIDIA A100-SXM4-80GB' ELSE 'Tesla V100' END"""


@query(
    "peak_flops",
    f"""SELECT device, count(*) AS n_rows, CASE WHEN contains(device, 'H200') OR contains(device, 'H100') THEN 989e12::DOUBLE
  WHEN contains(device, 'A100') THEN 312e12::DOUBLE END AS peak
FROM (SELECT {_DEVICES} AS device FROM events) GROUP BY device""",
)
def peak_flops_query(spark, sf_dir):
    devices = shapes.training_log(spark, sf_dir).select(F.expr(_DEVICES).alias("device"))
    counted = devices.groupBy("device").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("peak", peak_flops(F.col("device")))


#: A part of the log is written in so many tasks, and a micro-batch reads as many files.
_PART_FILES = 12


def _late_files(spark, sf_dir):
    """The log as five parts of *_PART_FILES* files that a stream reads in turn, and the longest time a record is behind.

    A third of the records of each quarter of the time come with the next quarter; a record without tokens closes the log.
    """
    log = shapes.training_log(spark, sf_dir).drop("event_type").where("ts IS NOT NULL")
    first, last = log.agg(F.min("ts"), F.max("ts")).first()
    quarter = (last - first) / 4 + timedelta(seconds=1)
    own = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(first))) / (quarter / timedelta(microseconds=1)))
    behind = F.when(F.xxhash64("run", "ts", "tokens_seen") % 3 == 0, 1).otherwise(0)
    folder = new_path(spark, "log")
    for i in range(5):
        log.where(own + behind == i).repartition(_PART_FILES).write.mode("append").parquet(folder)
    closing = log.limit(1).select("run", F.lit(last + 10 * quarter).alias("ts"), F.lit(None).cast("bigint").alias("tokens_seen"))
    closing.write.mode("append").parquet(folder)
    return log.schema, folder, 2 * quarter


@query(
    "throughput_stream",
    f"""WITH {LOG}, {RECORDS}
SELECT CAST(run AS VARCHAR) AS run, epoch_us(ts) AS ts_us, tokens AS tokens_seen, {_round("rate")} AS tokens_per_sec,
  {_round("rate / 4")} AS tokens_per_gpu_per_sec, false AS late FROM rates""",
)
def throughput_stream(spark, sf_dir):
    """The same rates from a stream of files that overlap in time, one part a micro-batch."""
    use_rocksdb_state(spark)
    schema, folder, delay = _late_files(spark, sf_dir)
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", _PART_FILES).parquet(folder)
    rates = stream_rates(
        log,
        shapes.run_starts(spark, sf_dir),
        world_size=4,
        delay=f"{math.ceil(delay.total_seconds())} seconds",
        slice_seconds=30 * 86400,
    )
    out = new_path(spark, "stream")
    running = (
        rates.writeStream.format("parquet")
        .option("path", f"{out}/rates")
        .option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(f"{out}/rates").select(
        "run", F.unix_micros("ts").alias("ts_us"), "tokens_seen", "tokens_per_sec", "tokens_per_gpu_per_sec", "late"
    )


@query(
    "run_map",
    """WITH named AS (
  SELECT 'offline-run-2024-' || c_custkey || '-' || 'id' || c_custkey AS folder, 'id' || c_custkey AS run_id, c_name AS run_name,
    CASE WHEN c_acctbal > 5000 THEN 'out/' || c_name END AS output_dir
  FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0)
SELECT *, output_dir IS NOT NULL AS output_exists FROM named""",
)
def run_map_query(spark, sf_dir):
    customers = shapes.table(spark, sf_dir, "customer")
    logs = customers.select(
        F.expr(
            "concat(IF(c_mktsegment = 'BUILDING', 'run-2024-', 'offline-run-2024-'), c_custkey, '-id', c_custkey)"
        ).alias("folder"),
        F.expr(
            r"""concat('start\n', IF(c_acctbal > 0, concat("config {'run_name':  '", c_name, "', 'lr': 1}\n'run_name': 'later'\n"), 'no name\n'))"""
        ).alias("log_text"),
    )
    outputs = customers.where("c_acctbal > 5000").select(
        F.col("c_name").alias("run_name"), F.concat(F.lit("out/"), "c_name").alias("output_dir")
    )
    return map_runs(logs, outputs)
