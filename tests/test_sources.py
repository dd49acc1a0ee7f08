import json

import pytest
from pyspark.sql import functions as F

from chatloom.sources.readers import (
    list_splits,
    load_dataset,
    map_tags,
    read_files,
    read_prepared,
    stored_fingerprint,
    write_prepared,
)

ROWS = [{"q": "one", "n": 1}, {"q": 'two "quoted"\nlines, here', "n": 2}]


@pytest.fixture
def files(spark, tmp_path):
    spark.createDataFrame([(r["q"], r["n"]) for r in ROWS], "q string, n int").toPandas().to_parquet(tmp_path / "d.parquet")
    (tmp_path / "d.jsonl").write_text("\n".join(map(json.dumps, ROWS)))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, ROWS)))
    (tmp_path / "list.json").write_text("\n " + json.dumps(ROWS, indent=1))
    (tmp_path / "d.csv").write_text('q,n\none,1\n"two ""quoted""\nlines, here",2\n')
    (tmp_path / "d.txt").write_text("first\n\nthird\n")
    return tmp_path


@pytest.mark.parametrize("name", ["d.parquet", "d.jsonl", "lines.json", "list.json", "d.csv"])
def test_formats(spark, files, name):
    rows = load_dataset(spark, str(files / name)).select("q", "n").orderBy("n").collect()
    assert [(r.q, r.n) for r in rows] == [(r["q"], r["n"]) for r in ROWS]


def test_text(spark, files):
    df = load_dataset(spark, str(files / "d.txt"))
    assert df.columns == ["text"] and [r.text for r in df.collect()] == ["first", "", "third"]


def test_other_suffixes(spark, files):
    for name in ("d.PARQUET", "d.tsv", "plain"):
        (files / name).write_text("x")
        with pytest.raises(ValueError, match=r"Readable: \['.csv', '.json', '.jsonl', '.parquet', '.txt'\]"):
            load_dataset(spark, str(files / name))
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, str(files / "absent"))
    with pytest.raises(ValueError, match="different formats"):
        read_files(spark, [str(files / "d.csv"), str(files / "d.txt")])


def test_schema_and_splittable(spark, files):
    df = load_dataset(spark, str(files / "d.jsonl"), schema="n bigint", splittable=True)
    assert df.dtypes == [("n", "bigint")] and df.agg(F.sum("n")).first()[0] == 3


def tree(spark, root):
    for subset, split, n in [("en", "train", 5), ("en", "test", 2), ("fr", "train", 3)]:
        spark.range(n).coalesce(1).write.parquet(str(root / subset / split))
    spark.range(4).toPandas().to_parquet(root / "train-00000-of-00002.parquet")
    spark.range(6).toPandas().to_parquet(root / "train-00001-of-00002.parquet")
    spark.range(1).toPandas().to_parquet(root / "validation.parquet")


def test_directories(spark, tmp_path):
    tree(spark, tmp_path)
    assert load_dataset(spark, str(tmp_path)).count() == 10
    assert load_dataset(spark, str(tmp_path), "validation").count() == 1
    assert load_dataset(spark, str(tmp_path), subset="en").count() == 5
    assert load_dataset(spark, str(tmp_path), "test", subset="en").count() == 2
    assert load_dataset(spark, str(tmp_path.parent), data_dir=tmp_path.name, subset="fr").count() == 3
    assert load_dataset(spark, str(tmp_path / "fr" / "train")).count() == 3
    with pytest.raises(ValueError, match="Unknown split 'test'.*train"):
        load_dataset(spark, str(tmp_path), "test", subset="fr")


def test_list_splits(spark, tmp_path):
    tree(spark, tmp_path)
    got = sorted(map(tuple, list_splits(spark, str(tmp_path)).collect()))
    assert got == [
        ("default", "train", 10),
        ("default", "validation", 1),
        ("en", "test", 2),
        ("en", "train", 5),
        ("fr", "train", 3),
    ]
    with pytest.raises(FileNotFoundError):
        list_splits(spark, str(tmp_path / "absent"))


def test_tags(spark):
    df = spark.createDataFrame([([("human", "a"), ("gpt", "b")],)], "chat array<struct<from:string,value:string>>")
    tags = {"role_tag": "from", "content_tag": "value", "user_tag": "human", "assistant_tag": "gpt", "system_tag": "system"}
    assert map_tags(df, {"messages": "chat"}, tags).first().messages == [("a", "user"), ("b", "assistant")]
    odd = spark.createDataFrame([([("tool", "a")],)], "chat array<struct<from:string,value:string>>")
    with pytest.raises(Exception, match="unknown role tag"):
        map_tags(odd, {"messages": "chat"}, tags).collect()
    assert map_tags(odd, {"messages": "chat"}, tags, "drop").first().messages is None


def test_sink(spark, tmp_path):
    out = str(tmp_path / "out")
    write_prepared(spark.range(3), spark.range(1), out)
    assert spark.read.parquet(f"{out}/data").count() == 3 and spark.read.parquet(f"{out}/manifest").count() == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        write_prepared(spark.range(3), None, out)


def test_sink_leaves_nothing_half_written(spark, tmp_path):
    out = str(tmp_path / "out")
    broken = spark.range(3).select(F.expr("if(id = 2, raise_error('no'), id)").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_prepared(broken, spark.range(1), out, "f")
    assert list(tmp_path.iterdir()) == [] and stored_fingerprint(spark, out) is None
    write_prepared(spark.range(3), spark.range(1), out, "f")
    assert stored_fingerprint(spark, out) == "f"
    assert [df.count() for df in read_prepared(spark, out)] == [3, 1]
    write_prepared(spark.range(3), spark.range(1), f"{out}2")
    with pytest.raises(FileExistsError, match="no whole prepared set"):
        stored_fingerprint(spark, f"{out}2")


def test_split_words(spark, tmp_path):
    for i, name in enumerate(["data/train-00000.jsonl", "data/test-00000.jsonl", "b/train_sft.jsonl", "b/test_sft.jsonl", "c/part-0.jsonl"]):
        path = tmp_path / ("a/" + name if name.startswith("data") else name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"n": i}))
    read = lambda *a: [r.n for r in load_dataset(spark, *a).collect()]
    assert read(str(tmp_path / "a")) == [0] and read(str(tmp_path / "a"), "test") == [1]
    assert read(str(tmp_path / "b")) == [2] and read(str(tmp_path / "b"), "test") == [3]
    assert read(str(tmp_path / "b"), "test_sft") == [3] and read(str(tmp_path / "c")) == [4]
    with pytest.raises(ValueError, match="Unknown split 'validation'"):
        read(str(tmp_path / "a"), "validation")


def test_json_lists_beside_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"n": 1}, {"n": 2}]))
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps({"n": i, "m": "x"}) for i in range(3, 8)))
    rows = load_dataset(spark, str(tmp_path)).collect()
    assert sorted(r.n for r in rows) == [1, 2, 3, 4, 5, 6, 7] and sum(r.m is None for r in rows) == 2


def test_broken_records_fail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"n": 1}\n{"n": \n{"n": 3}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        load_dataset(spark, str(tmp_path / "a.jsonl"), schema="n bigint").collect()


def test_row_keys(spark):
    from chatloom.operators.mixing import KEY, with_row_key

    rows = [("a:b", "c"), ("a", "b:c"), (None, ""), ("", None), ("x", "y"), ("x", "y")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert with_row_key(df, ["p", "q"]).select(KEY).distinct().count() == 5
    keys = [{r[KEY] for r in with_row_key(df.repartition(n)).collect()} for n in (1, 5)]
    assert len(keys[0]) == 6 and keys[0] == keys[1]


def test_a_folder_of_json_lists_and_lines(spark, tmp_path):
    folder = tmp_path / "set" / "train.json"
    (folder / "day=1").mkdir(parents=True)
    (folder / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (folder / "b.json").write_text("".join(f'{{"x": {i}}}\n' for i in range(3, 8)))
    (folder / "_SUCCESS").write_text("")
    df = read_files(spark, [str(folder)])
    assert sorted(r.x for r in df.collect()) == [1, 2, 3, 4, 5, 6, 7]
    (folder / "a.json").write_text("")
    assert sorted(r.x for r in read_files(spark, [str(folder)]).collect()) == [3, 4, 5, 6, 7]
