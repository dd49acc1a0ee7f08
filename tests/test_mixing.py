import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.operators.mixing import (
    Mix,
    Part,
    Source,
    cap_rows,
    check_weights,
    mix_fingerprint,
    mix_parts,
    mix_stats,
    number_rows,
    sample_exact,
    target_rows,
    with_row_key,
)
from chatloom.operators.registry import register_transform, transform_names
from chatloom.operators.shaping import sft_filter
from chatloom.plans.prepare import (
    prepare_mix,
    prepare_once,
    prepare_preferences,
    prepare_sft,
    read_source,
    row_outcomes,
    settings_fingerprint,
)

MSG = "array<struct<role:string,content:string>>"


def dataset(spark, source, n):
    rows = [(source, i, [("user", f"q{i} {source}"), ("assistant", f"answer{i}")]) for i in range(n)]
    return spark.createDataFrame(rows, f"source string, idx bigint, messages {MSG}")


def mixed(spark, sizes, weights, seed=123, **options):
    frames = {name: dataset(spark, name, n) for name, n in sizes.items()}
    sources = [Source(name, name, weight, key=("idx",)) for name, weight in weights.items()]
    return prepare_mix(spark, Mix(sources, seed), read=lambda s, source: frames[source.path], **options)


def order(mix):
    return [(r.source, r.idx) for r in mix.rows.collect()]


def test_weights_use_each_size(spark):
    mix = mixed(spark, {"a": 4, "b": 2}, {"a": 0.5, "b": 2.0})
    assert Counter(s for s, _ in order(mix)) == {"a": 2, "b": 4}
    assert Counter(order(mix))[("b", 0)] == 2
    assert mix.targets == {"a": 2, "b": 4}
    assert sorted(map(tuple, mix.manifest.collect())) == [("a", 0.5, 4, 2), ("b", 2.0, 2, 4)]


def test_same_seed_same_order(spark):
    sizes, weights = {"a": 5, "b": 5}, {"a": 0.6, "b": 0.6}
    first, again, other = (mixed(spark, sizes, weights, seed) for seed in (7, 7, 8))
    assert len(order(first)) == 6
    assert order(first) == order(again)
    assert order(first) != order(other)


def test_order_does_not_depend_on_partitions(spark):
    sizes, weights = {"a": 50, "b": 30}, {"a": 1.3, "b": 0.5}
    one = mixed(spark, sizes, weights, position=True, partitions=1)
    many = mixed(spark, sizes, weights, position=True, partitions=7)
    key = F.struct("position", "source", "idx")
    assert one.rows.select(key).orderBy("position").collect() == many.rows.select(key).orderBy("position").collect()
    positions = [r.position for r in many.rows.collect()]
    assert positions == list(range(80))


def test_weight_zero_negative_and_empty(spark):
    mix = mixed(spark, {"a": 2, "b": 2}, {"a": 0.0, "b": 1.0})
    assert Counter(s for s, _ in order(mix)) == {"b": 2}
    with pytest.raises(ValueError, match="non-negative"):
        mixed(spark, {"a": 2}, {"a": -0.1})
    with pytest.raises(ValueError, match="No rows left"):
        mixed(spark, {"a": 2}, {"a": 0.0})
    with pytest.raises(ValueError, match="No rows left"):
        mixed(spark, {"a": 2}, {"a": 0.2})
    with pytest.raises(ValueError, match="at least one dataset"):
        check_weights([])


def test_negative_weight_is_found_before_reading(spark):
    def read(session, source):
        raise AssertionError("read")

    with pytest.raises(ValueError, match="non-negative"):
        prepare_mix(spark, Mix([Source("a", "a", -1.0), Source("b", "b")]), read=read)


def test_rounding_is_half_to_even():
    assert [target_rows(0.5, n) for n in (1, 3, 5, 7)] == [0, 2, 2, 4]


@pytest.mark.parametrize("weight,copies", [(2.5, {2, 3}), (3.0, {3}), (1.0, {1}), (0.4, {1}), (1.1, {1, 2})])
def test_copies_are_balanced(spark, weight, copies):
    mix = mixed(spark, {"a": 30}, {"a": weight})
    counts = Counter(order(mix))
    assert sum(counts.values()) == round(weight * 30)
    assert set(counts.values()) == copies
    if weight >= 1:
        assert len(counts) == 30


def test_larger_samples_hold_smaller_ones(spark):
    small = set(order(mixed(spark, {"a": 40}, {"a": 0.25})))
    large = set(order(mixed(spark, {"a": 40}, {"a": 0.75})))
    assert small < large


def test_native_fields_stay(spark):
    schema = "messages array<struct<role:string,content:string,functions:string,function_calls:string>>, unused string"
    rows = [([("user", "u", "[sum]", None), ("assistant", None, None, "sum(1, 2)")], "gone")]
    df = spark.createDataFrame(rows, schema)
    mix = prepare_mix(
        spark, Mix([Source("a", "a")]), keep=["messages"], enforce_schema=True, read=lambda s, x: df
    ).rows.drop("_dataset")
    assert mix.columns == ["messages"]
    turns = mix.first().messages
    assert turns[0].functions == "[sum]" and turns[1].function_calls == "sum(1, 2)"


def test_transform_drops_sources(spark):
    if "hi_test" not in transform_names():
        from chatloom.functions.turns import pair

        register_transform("hi_test")(lambda schema, policy: pair(F.col("prompt"), F.lit("hi")))
    df = spark.createDataFrame([("good day", "gone")], "prompt string, unused string")
    mix = prepare_mix(
        spark, Mix([Source("a", "a", transform="hi_test")]), enforce_schema=True, read=lambda s, x: df
    ).rows.drop("_dataset")
    assert mix.columns == ["messages"]
    assert mix.dtypes[0][1] == "array<struct<content:string,role:string>>"


def test_unknown_transform_names_the_dataset(spark):
    df = spark.createDataFrame([("x",)], "prompt string")
    with pytest.raises(KeyError, match="'set-a' asks for an unknown transform. No transform is called 'nope'"):
        prepare_mix(spark, Mix([Source("set-a", "a", transform="nope")]), read=lambda s, x: df)


def test_weights_apply_after_the_filter(spark):
    rows = [(i, [("user", "x")] if i < 4 else []) for i in range(10)]
    df = spark.createDataFrame(rows, f"idx bigint, messages {MSG}")
    mix = prepare_mix(
        spark, Mix([Source("a", "a", 0.5, key=("idx",))]), row_filter=sft_filter, keep=["messages"], read=lambda s, x: df
    )
    assert mix.rows.count() == 2


def test_column_filter(spark):
    df = dataset(spark, "a", 10)
    source = Source("a", "a", key=("idx",))
    mix = prepare_mix(spark, Mix([source]), row_filter=F.col("idx") < 3, read=lambda s, x: df)
    assert mix.rows.count() == 3


def test_columns_align_by_name(spark):
    one = spark.createDataFrame([(1, "x")], "idx bigint, a string")
    two = spark.createDataFrame([("y", 2)], "b string, idx bigint")
    frames = {"one": one, "two": two}
    mix = prepare_mix(
        spark, Mix([Source("one", "one", key=("idx",)), Source("two", "two", key=("idx",))]), read=lambda s, x: frames[x.path]
    )
    assert sorted((r.idx, r.a, r.b) for r in mix.rows.collect()) == [(1, "x", None), (2, None, "y")]


def test_preferences_keep_all_columns(spark):
    df = spark.createDataFrame([(1, "c", "r"), (2, "", "r")], "id int, chosen string, rejected string")
    mix = prepare_preferences(spark, Mix([Source("a", "a", key=("id",))]), read=lambda s, x: df)
    assert [tuple(r) for r in mix.rows.drop("_dataset").collect()] == [(1, "c", "r")]


def test_one_dataset_of_equal_rows(spark):
    """Copies of one row make up most rows: counts stay exact without a key column."""
    df = spark.range(3000).select(F.when(F.col("id") < 2500, "same").otherwise(F.col("id").cast("string")).alias("t"))
    mix = mix_parts([Part("a", with_row_key(df), 1.5)], 3, position=True)
    assert mix.rows.count() == 4500
    assert mix.rows.agg(F.countDistinct("position"), F.max("position")).first()[:] == (4500, 4499)
    copies = mix.rows.where("t <> 'same'").groupBy("t").count().agg(F.min("count"), F.max("count")).first()
    assert copies[0] >= 1 and copies[1] <= 2


def test_key_that_is_not_unique_is_refused_at_the_threshold(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    with pytest.raises(ValueError, match="does not identify"):
        sample_exact(df, 30, 1, ["k"])


def test_sample_and_cap(spark):
    df = spark.range(100)
    assert sample_exact(df, 33, 5, ["id"]).distinct().count() == 33
    counts = [r["count"] for r in sample_exact(df, 250, 5, ["id"]).groupBy("id").count().collect()]
    assert sorted(set(counts)) == [2, 3] and len(counts) == 100
    assert cap_rows(df, 40, 5, ["id"]).count() == 40
    assert cap_rows(df, 400, 5, ["id"]).count() == 100
    assert cap_rows(df, None, 5) is df
    with pytest.raises(ValueError, match="positive"):
        sample_exact(df, 0, 5, ["id"])
    with pytest.raises(ValueError, match="empty dataset"):
        sample_exact(spark.range(0), 1, 5, ["id"])


def test_max_samples_comes_before_the_weight(spark):
    df = spark.range(100)
    mix = mix_parts([Part("a", with_row_key(df, ["id"]), 2.5, max_samples=20)], 1)
    counts = Counter(r.id for r in mix.rows.collect())
    assert len(counts) == 20 and sum(counts.values()) == 50 and set(counts.values()) == {2, 3}


def test_max_samples_with_as_many_copies_as_rows(spark):
    mix = mix_parts([Part("a", with_row_key(spark.range(40), ["id"]), 4.0, max_samples=10)], 1, position=True)
    counts = Counter(r.id for r in mix.rows.collect())
    assert len(counts) == 10 and set(counts.values()) == {4}
    assert sorted(r.position for r in mix.rows.collect()) == list(range(40))


def test_number_rows_totals(spark):
    rows = number_rows(spark.range(500).withColumn("n", F.col("id") % 7), 4, ["id"], size=F.col("n")).orderBy("position").collect()
    total = 0
    for place, row in enumerate(rows):
        assert (row.position, row.start) == (place, total)
        total += row.n


def test_fingerprint():
    one = [Source("b", "p", 1.0), Source("a", "q", 0.5)]
    assert mix_fingerprint(one) == mix_fingerprint(one[::-1])
    assert mix_fingerprint(one) != mix_fingerprint([Source("b", "p", 1.0), Source("a", "q", 0.6)])
    # sha256 of '[{"name": "a", "path": "q", "weight": 0.5}]'
    assert len(mix_fingerprint([Source("a", "q", 0.5)])) == 8


def test_row_outcomes(spark):
    schema = "prompt string, response_1 string, response_2 string, preference_strength double"
    df = spark.createDataFrame([("p", "a", "b", 1.0), ("p", "a", "b", None)], schema)
    out = row_outcomes(spark, Mix([Source("a", "a", transform="helpsteer2")]), read=lambda s, x: df)
    assert [tuple(r) for r in out.collect()] == [("a", 2, 0, 1)]


@pytest.mark.parametrize("packing,staged", [("wrap", True), ("best_fit", False), (None, False)])
def test_prepare_sft_from_files(spark, tmp_path, packing, staged):
    dataset(spark, "a", 9).drop("source").write.parquet(str(tmp_path / "a" / "train"))
    dataset(spark, "b", 4).drop("source").write.json(str(tmp_path / "b" / "train"))
    sources = [Source("a", str(tmp_path / "a"), 1.0), Source("b", str(tmp_path / "b"), 2.0)]
    prepared = prepare_sft(
        spark,
        Mix(sources, 1, "olmo3-think-sft"),
        packing=packing,
        max_length=64,
        staging=str(tmp_path / "staged") if staged else None,
    )
    prepared.write(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out" / "data"))
    tokens = rows.agg(F.sum(F.size("input_ids")), F.max(F.size("input_ids"))).first()
    # 17 chats: 26 words of the default system turn, 2 in the user turn, 1 + 1 in the answer.
    per_chat = tokens[0] // 17
    assert tokens[0] == 17 * per_chat and tokens[1] <= 64
    assert rows.where(F.size("input_ids") != F.size("labels")).count() == 0
    trained = rows.agg(F.sum(F.size(F.filter("labels", lambda x: x != -100)))).first()[0]
    assert trained == 17
    manifest = {r.dataset: (r.rows_before, r.rows_after) for r in spark.read.parquet(str(tmp_path / "out" / "manifest")).collect()}
    assert manifest == {"a": (9, 9), "b": (4, 8)}
    assert len(prepared.fingerprint) == 8


def test_prepare_sft_needs_markers(spark):
    with pytest.raises(ValueError, match="'chatml' does not mark the assistant's text"):
        prepare_sft(spark, Mix([Source("a", "a")], 1, "chatml"))


def test_parquet_key_is_file_and_row(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "train"))
    rows = read_source(spark, Source("a", str(tmp_path)))
    assert rows.select("_row_key").distinct().count() == 10


def test_partitions_follow_the_rows(spark):
    from chatloom.operators.mixing import HASH_BUCKETS, ROWS_PER_PARTITION, shuffle_partitions

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert shuffle_partitions(spark, 10) == least
    assert shuffle_partitions(spark, 1000 * ROWS_PER_PARTITION + 1) == 1001
    assert shuffle_partitions(spark, 10**15) == HASH_BUCKETS


def test_statistics_over_a_mix_equal_the_mixed_rows(spark):
    def part(name, n, weight, cap=None):
        rows = spark.range(n).select(F.col("id").cast("string").alias("_row_key"), (F.col("id") * 7 % 31).alias("len"))
        return Part(name, rows, weight, cap, F.col("len"))

    parts = [part("thin", 200, 0.37), part("twice", 90, 2.4), part("capped", 300, 1.5, 40), part("none", 5, 0.0)]
    lengths = mix_parts(parts, 9).rows.select("_dataset", "len").collect()
    stats = {r.dataset: r for r in mix_stats(parts, 9).collect()}
    assert set(stats) == {"thin", "twice", "capped", None}
    for name, row in stats.items():
        own = [r.len for r in lengths if name in (None, r._dataset)]
        assert (row.n_rows, row.total, row.min, row.max) == (len(own), sum(own), min(own), max(own))
        assert row.mean == pytest.approx(statistics.mean(own)) and row.std == pytest.approx(statistics.stdev(own))


def test_statistics_of_one_row_and_of_large_sizes(spark):
    rows = spark.createDataFrame([("a", 4_000_000_000), ("b", 4_000_000_001)], "_row_key string, len bigint")
    both = mix_stats([Part("x", rows, size=F.col("len"))], 1).first()
    assert both.std == pytest.approx(0.5**0.5, rel=1e-12) and both.total == 8_000_000_001
    one = mix_stats([Part("x", rows.limit(1), size=F.col("len"))], 1).first()
    assert one.n_rows == 1 and one.std is None


def test_many_copies_of_a_row_without_key(spark, monkeypatch):
    monkeypatch.setattr("chatloom.operators.mixing._COPIES_AT_ONCE", 40)
    hot = spark.range(1000).select(F.lit("same").alias("text"), F.lit(None).cast("int").alias("n"))
    rows = hot.union(spark.range(100).select(F.col("id").cast("string"), F.col("id").cast("int")))
    keyed = with_row_key(rows)
    assert keyed.count() == 1100 and keyed.select("_row_key").distinct().count() == 1100
    assert keyed.where("text = 'same' AND n IS NULL").count() == 1000
    # The runs of the hot row lie in several partitions.
    places = keyed.where("text = 'same'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert places > 1
    sample = sample_exact(rows, 300, 5)
    again = sample_exact(rows.repartition(7), 300, 5)
    assert sample.count() == 300
    assert sorted(map(str, sample.collect())) == sorted(map(str, again.collect()))


def test_a_prepared_set_is_found_again(spark, tmp_path):
    dataset(spark, "a", 9).drop("source").write.parquet(str(tmp_path / "a" / "train"))
    mix = Mix([Source("a", str(tmp_path / "a"))], 1, "olmo3-think-sft")
    out, calls = str(tmp_path / "out"), []

    def counted(spark, mix, max_length=64, packing="wrap", **more):
        calls.append(max_length)
        return prepare_sft(spark, mix, max_length=max_length, packing=packing, **more)

    first = prepare_once(spark, mix, out, counted, max_length=64)
    again = prepare_once(spark, mix, out, counted, partitions=2)
    assert calls == [64] and first.fingerprint == again.fingerprint
    assert again.rows.count() == first.rows.count() > 0
    assert [tuple(r) for r in again.manifest.collect()] == [("a", 1.0, 9, 9)]
    with pytest.raises(FileExistsError, match="another prepared set"):
        prepare_once(spark, mix, out, counted, max_length=32)
    with pytest.raises(FileExistsError, match="another prepared set"):
        prepare_once(spark, Mix(mix.sources, 2, mix.chat_template), out, counted)
    assert calls == [64]


def test_settings_fingerprint():
    mix = Mix([Source("a", "q", 0.5), Source("b", "q")])
    name = settings_fingerprint(mix, {"x": 1, "f": target_rows})
    assert name == settings_fingerprint(Mix(tuple(mix.sources)), {"f": target_rows, "x": 1})
    others = [
        settings_fingerprint(Mix(mix.sources[::-1]), {"x": 1, "f": target_rows}),
        settings_fingerprint(mix, {"x": 2, "f": target_rows}),
        settings_fingerprint(mix, {"x": 1, "f": cap_rows}),
        settings_fingerprint(Mix(mix.sources, 3), {"x": 1, "f": target_rows}),
    ]
    assert len({name, *others}) == 5
