import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chatloom.operators.training_logs import peak_flops, previous_records, throughput, utilization
from chatloom.sources.run_folders import read_run_map, run_name
from chatloom.streaming.log_rates import STATE_STORE, stream_rates, use_rocksdb_state

ZERO = datetime(2025, 1, 1, tzinfo=timezone.utc)
LOG = "run string, ts timestamp, tokens_seen bigint"


def at(seconds):
    return ZERO + timedelta(seconds=seconds)


def expected_rates(records, starts=None):
    """The rule, record by record: ``{(run, second): tokens per second}``."""
    out = {}
    by_run = defaultdict(list)
    for run, second, tokens in records:
        by_run[run].append((second, tokens))
    for run, rows in by_run.items():
        last = (starts[run], 0) if starts else None
        for second, tokens in sorted((r for r in rows if r[1] is not None)):
            if last is not None:
                if second <= last[0]:
                    continue
                out[run, second] = round((tokens - last[1]) / (second - last[0]))
            last = (second, tokens)
    return out


def generated(seed, runs=("a", "b"), hot=400):
    rng = random.Random(seed)
    records = []
    for run in runs:
        second, tokens = 0, 0
        for _ in range(hot if run == "a" else 15):
            second += rng.choice([0, 1, 7, 300, 5000])
            tokens += rng.randint(0, 100_000)
            records.append((run, second, None if rng.random() < 0.2 else tokens))
    rng.shuffle(records)
    return records


def frame(spark, records):
    return spark.createDataFrame([(r, at(s), n) for r, s, n in records], LOG).repartition(3)


def rates_of(df):
    return {(r.run, round((r.ts - datetime(2025, 1, 1)).total_seconds())): r.tokens_per_sec for r in df.collect()}


@pytest.mark.parametrize("slice_seconds", [60, 3600, 10**7])
@pytest.mark.parametrize("with_starts", [False, True])
def test_throughput(spark, slice_seconds, with_starts):
    records = generated(5)
    starts = {"a": -10, "b": -20} if with_starts else None
    starts_df = None
    if with_starts:
        starts_df = spark.createDataFrame([(r, at(s)) for r, s in starts.items()], "run string, ts timestamp")
    got = throughput(frame(spark, records), starts_df, slice_seconds=slice_seconds)
    assert rates_of(got) == expected_rates(records, starts)


def test_skipped_records_do_not_move_the_state(spark):
    log = frame(spark, [("a", 0, 0), ("a", 10, None), ("a", 10, 500), ("a", 10, 900), ("a", 20, 1500)])
    rows = previous_records(log).orderBy("ts").collect()
    assert [(r.prev_tokens, r.tokens_seen) for r in rows] == [(0, 500), (500, 1500)]


def test_start_at_the_time_of_a_record(spark):
    log = frame(spark, [("a", 0, 100), ("a", 10, 300)])
    starts = spark.createDataFrame([("a", at(0))], "run string, ts timestamp")
    assert rates_of(throughput(log, starts)) == {("a", 10): 30}


def test_world_size_and_mfu(spark):
    log = frame(spark, [("a", 0, 0), ("a", 10, 40_000)])
    row = throughput(log, world_size=8).first()
    assert (row.tokens_per_sec, row.tokens_per_gpu_per_sec) == (4000, 500)
    value = utilization(log, 7_000_000_000, 989e12, world_size=8).first().mfu
    assert value == pytest.approx(round(500 * 6 * 7e9 / 989e12, 4), abs=1e-4)
    assert utilization(log, None, 989e12).count() == 0
    assert utilization(log, 10, None).count() == 0
    by_device = utilization(log.withColumn("device", F.lit("x")), 7_000_000_000, peak_flops(F.lit("NVIDIA A100")))
    assert by_device.count() == 1


def test_peaks(spark):
    names = ["NVIDIA H200", "NVIDIA H100 80GB", "A100-SXM", "V100", None, "A100 or H100"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1).select(peak_flops(F.col("n"))).collect()
    assert [r[0] for r in rows] == [989e12, 989e12, 312e12, None, None, 989e12]


def streamed(spark, tmp_path, files, starts=None, **options):
    """Rates of a stream that reads one file a micro-batch and ends when all are read."""
    use_rocksdb_state(spark)
    for rows in files:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    log = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    running = (
        stream_rates(log, starts, **options)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


CLOSING = [("close", 10**6, None)]


def test_interleaved_files_equal_batch(spark, tmp_path):
    records = generated(9, hot=60)
    halves = [[r for i, r in enumerate(records) if i % 2 == half] for half in (0, 1)]
    starts = spark.createDataFrame([("a", at(-10)), ("b", at(-20))], "run string, ts timestamp")
    out = streamed(
        spark, tmp_path, [*halves, CLOSING], starts, world_size=2, num_params=10**9, peak=989e12, delay="1 day", slice_seconds=10
    )
    assert rates_of(out) == expected_rates(records, {"a": -10, "b": -20})
    assert out.where("mfu IS NULL OR late").count() == 0


def test_runs_of_one_group_share_their_state(spark, tmp_path):
    """Forty runs in three groups, with several records at one time and one without tokens."""
    records = [(f"r{i % 40}", (i * 7) % 61, 100 * i) for i in range(400)] + [("r1", 5, 7), ("r1", 5, 3), ("r2", 45, None)]
    halves = [records[0::2], records[1::2]]
    starts = {f"r{i}": -10 for i in range(40)}
    starts_df = spark.createDataFrame([(r, at(s)) for r, s in starts.items()], "run string, ts timestamp")
    out = streamed(spark, tmp_path, [*halves, CLOSING], starts_df, delay="1 day", slice_seconds=10, run_groups=3)
    assert rates_of(out) == expected_rates(records, starts)


def test_late_records_come_out_marked(spark, tmp_path):
    options = {"delay": "20 seconds", "slice_seconds": 10}
    streamed(spark, tmp_path, [[("a", 0, 0), ("a", 10, 100)], [("a", 5, 70), ("a", 60, 400)]], **options)
    # The stream goes on from its state. Second 5 was in time, 7 is not; a run of its own is not too late.
    out = streamed(spark, tmp_path, [[("a", 7, 80), ("b", 55, 1), ("b", 57, 11), ("a", 62, 440)], CLOSING], **options)
    late = out.where("late").collect()
    assert [(r.run, r.tokens_seen, r.tokens_per_sec, r.mfu) for r in late] == [("a", 80, None, None)]
    assert rates_of(out.where("NOT late")) == {("a", 5): 14, ("a", 10): 6, ("a", 60): 6, ("a", 62): 20, ("b", 57): 5}


def test_stream_needs_its_state_store(spark):
    spark.conf.unset(STATE_STORE)
    with pytest.raises(ValueError, match="RocksDB"):
        stream_rates(frame(spark, []))


def test_run_names(spark):
    texts = [
        "x\n'run_name': 'first', 'run_name': 'second'\n",
        "'run_name':\n'next line'\n'run_name':   'found'",
        "run_name: 'no'",
        "'run_name': ''\n'run_name': 'later'",
        "",
    ]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").coalesce(1).select(run_name(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["first", "found", None, "later", None]


def test_run_map(spark, tmp_path):
    def folder(name, text):
        logs = tmp_path / "logs" / name / "logs"
        logs.mkdir(parents=True)
        if text is not None:
            (logs / "debug.log").write_text(text)

    folder("offline-run-2024-b-id2", "start\nconfig {'run_name': 'gone'}\n")
    folder("offline-run-2024-a-id1", "config {'run_name': 'here'}\n")
    folder("offline-run-2024-c-id3", "nothing\n")
    folder("offline-run-2024-d-id4", None)
    folder("run-2024-e-id5", "'run_name': 'here'\n")
    (tmp_path / "outputs" / "here").mkdir(parents=True)
    rows = read_run_map(spark, str(tmp_path / "logs"), str(tmp_path / "outputs")).collect()
    assert [(r.folder, r.run_id, r.run_name, r.output_exists) for r in rows] == [
        ("offline-run-2024-a-id1", "id1", "here", True),
        ("offline-run-2024-b-id2", "id2", "gone", False),
    ]
    assert rows[0].output_dir.endswith("/outputs/here") and rows[1].output_dir is None
    (tmp_path / "empty").mkdir()
    assert read_run_map(spark, str(tmp_path / "empty"), str(tmp_path / "outputs")).count() == 0
