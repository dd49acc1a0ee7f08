"""Readers: single files by suffix, dataset directories, split listing, tag mapping, the sink."""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from posixpath import basename
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.basics import fail_when
from chatloom.functions.turns import role_from, turn
from chatloom.operators.mixing import KEY

# File suffix -> Spark reader.
FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".jsonl": "json", ".txt": "text"}


def _suffix(path: str) -> str:
    name = basename(path.rstrip("/"))
    return name[name.rindex(".") :] if "." in name[1:] else ""


def _list(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """``(path, is_directory)`` of everything that matches, on any file system Spark knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted((s.getPath().toString(), s.isDirectory()) for s in found)


def _visible(entries: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
    return [e for e in entries if not basename(e[0]).startswith((".", "_"))]


def read_files(
    spark: SparkSession, paths: list[str], schema=None, row_key: bool = False, splittable: bool = False
) -> DataFrame:
    """Read data files of one format, chosen by suffix (case matters).

    CSV cells and top-level JSON arrays may span lines, which keeps a file in one task; pass
    ``splittable=True`` when each record is on its own line. Each JSON file may be a list or lines, also those of one
    folder; the files are read in two groups. A broken CSV or JSON record fails the job. With *row_key*, Parquet rows get a key from file and
    row number.
    """
    suffixes = {_suffix(p) for p in paths}
    unknown = sorted(s for s in suffixes if s not in FORMATS)
    if unknown:
        raise ValueError(
            f"No reader for files that end in '{unknown[0]}' ('{paths[0]}'). Readable: {sorted(FORMATS)}"
        )
    kinds = {FORMATS[s] for s in suffixes}
    if len(kinds) != 1:
        raise ValueError(f"Files of different formats in one split: {sorted(suffixes)}")
    kind = kinds.pop()
    options: dict[str, object] = {}
    if kind == "csv":
        options = {"header": True, "quote": '"', "escape": '"', "multiLine": not splittable, "inferSchema": schema is None}
    if kind in ("csv", "json"):
        options["mode"] = "FAILFAST"

    def load(files: list[str], **more) -> DataFrame:
        reader = spark.read.format(kind).options(**options, **more)
        if schema is not None and kind != "text":
            reader = reader.schema(schema)
        return reader.load(files)

    if kind == "json" and not splittable:
        files = [f for p in paths for f in _data_files(spark, p)]
        with ThreadPoolExecutor(_OPEN_AT_ONCE) as pool:
            is_list = list(pool.map(lambda f: _starts_with_bracket(spark, f), files))
        if len(set(is_list)) < 2:
            df = load(paths, multiLine=any(is_list))
        else:
            # Folders like ``day=1`` below the one that was asked for still give a column.
            base = {"basePath": paths[0]} if len(paths) == 1 else {}
            groups = [[f for f, found in zip(files, is_list, strict=True) if found is kind] for kind in (True, False)]
            frames = [load(group, multiLine=kind, **base) for group, kind in zip(groups, (True, False), strict=True)]
            df = frames[0].unionByName(frames[1], allowMissingColumns=True)
    else:
        df = load(paths)
    if kind == "text":
        df = df.withColumnRenamed("value", "text")
    if row_key and kind == "parquet":
        place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        df = df.select("*", place.alias(KEY))
    return df


#: Files whose first bytes are looked at together.
_OPEN_AT_ONCE = 32


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """*path* if it is a file, else all files below it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return [path]
    return [f for inner, _ in _visible(_list(spark, f"{path}/*")) for f in _data_files(spark, inner)]


def _starts_with_bracket(spark: SparkSession, path: str) -> bool:
    """Whether the first character of a file other than white space is ``[``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.open(at)
    try:
        byte = stream.read()
        while byte in (0x20, 0x09, 0x0A, 0x0D, 0xEF, 0xBB, 0xBF):  # white space and a byte order mark
            byte = stream.read()
        return byte == ord("[")
    finally:
        stream.close()


# Words in file and folder names, and the split they stand for.
SPLIT_WORDS = {
    "train": "train",
    "training": "train",
    "validation": "validation",
    "valid": "validation",
    "val": "validation",
    "dev": "validation",
    "test": "test",
    "testing": "test",
    "eval": "test",
    "evaluation": "test",
}


def _split_classes(name: str) -> set[str]:
    """The splits that a name's words stand for: ``train_sft`` is training data."""
    return {SPLIT_WORDS[w] for w in re.split(r"[-_. ]+", name.lower()) if w in SPLIT_WORDS}


def _stem(path: str) -> str:
    """Split name of a file: ``train-00000-of-00004.parquet`` belongs to ``train``."""
    name = basename(path)
    name = name[: -len(_suffix(name))] if _suffix(name) else name
    return re.sub(r"[-_.]\d+(?:-of-\d+)?$", "", name)


def _split_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    splits: dict[str, list[str]] = {}
    for path, is_dir in _visible(_list(spark, f"{folder}/*")):
        if is_dir and _suffix(path) not in FORMATS:
            for inner, _ in _visible(_list(spark, f"{path}/*")):
                if _suffix(inner) in FORMATS:
                    # A folder like ``data`` names no split; its files may.
                    named = _split_classes(basename(path)) or not _split_classes(_stem(inner))
                    splits.setdefault(basename(path) if named else _stem(inner), []).append(inner)
        elif _suffix(path) in FORMATS:
            splits.setdefault(_stem(path), []).append(path)
    return splits


def load_dataset(
    spark: SparkSession,
    path: str,
    split: str = "train",
    data_dir: str | None = None,
    subset: str | None = None,
    schema=None,
    row_key: bool = False,
    splittable: bool = False,
) -> DataFrame:
    """Read one file, or one split of a dataset directory.

    Directory layout: ``path/[data_dir/][subset/]`` holding ``split`` folders or ``split*.suffix`` files, or a folder of
    such files. A name that is exactly *split* comes first, else all names with a word for it, so ``train`` reads
    ``train_sft`` and never ``test_sft``. A folder in which no name has a word for any split is all ``train``.
    """
    entries = _list(spark, path)
    if not entries:
        raise FileNotFoundError(f"No dataset at '{path}'.")
    if not entries[0][1] or _suffix(path) in FORMATS:
        return read_files(spark, [path], schema, row_key, splittable)
    folder = "/".join(p.rstrip("/") for p in (path, data_dir, subset) if p)
    splits = _split_files(spark, folder)
    classes = {name: _split_classes(name) for name in splits}
    if split in splits:
        files = splits[split]
    elif any(c == {split} for c in classes.values()):
        files = [f for name, fs in splits.items() if classes[name] == {split} for f in fs]
    elif split == "train" and splits and not any(classes.values()):
        files = [f for fs in splits.values() for f in fs]
    else:
        raise ValueError(f"Unknown split '{split}' in '{folder}'. Available: {sorted(splits)}")
    return read_files(spark, sorted(files), schema, row_key, splittable)


def list_splits(spark: SparkSession, path: str) -> DataFrame:
    """``(subset, split, n_rows)`` of a dataset directory, in one job.

    Files directly in the directory form the subset ``default``.
    """
    found: list[tuple[str, str, list[str]]] = []
    own = basename(path.rstrip("/"))
    for split, files in _split_files(spark, path).items():
        files = [f for f in files if basename(f.rsplit("/", 1)[0]) == own]
        if files:
            found.append(("default", split, files))
    for folder, is_dir in _visible(_list(spark, f"{path}/*")):
        if is_dir and _suffix(folder) not in FORMATS:
            inner = _split_files(spark, folder)
            found.extend((basename(folder), split, files) for split, files in inner.items())
    if not found:
        raise FileNotFoundError(f"No data files under '{path}'.")
    frames = [
        read_files(spark, files).select(F.lit(subset).alias("subset"), F.lit(split).alias("split"))
        for subset, split, files in found
    ]
    return (
        reduce(DataFrame.unionAll, frames)
        .groupBy("subset", "split")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def map_tags(
    df: DataFrame, columns: Mapping[str, str], tags: Mapping[str, str], on_bad_row: str = "fail"
) -> DataFrame:
    """Bring a chat column with its own field and role names to ``messages``.

    *columns* names the list column under ``messages``; *tags* gives ``role_tag``,
    ``content_tag``, ``user_tag``, ``assistant_tag``, ``system_tag``. A role outside the
    tags makes the row bad.
    """
    turns = F.col(columns["messages"])
    roles = {tags[f"{r}_tag"]: r for r in ("user", "assistant", "system") if f"{r}_tag" in tags}
    role_of, content_of = tags.get("role_tag", "from"), tags.get("content_tag", "value")
    unknown = F.exists(turns, lambda m: role_from(m[role_of], roles).isNull())
    mapped = F.transform(turns, lambda m: turn(role_from(m[role_of], roles), m[content_of]))
    return df.withColumn("messages", fail_when(unknown, "unknown role tag", mapped, on_bad_row))


def write_prepared(rows: DataFrame, manifest: DataFrame | None, out: str, fingerprint: str | None = None) -> None:
    """Store a prepared set as ``out/data``, its manifest as ``out/manifest`` and its *fingerprint* as ``out/fingerprint``.

    Data and manifest are written to a folder beside *out* that gets its name when they are whole, so a job that ends
    half-way leaves no *out*. The fingerprint comes last: also where a rename copies file by file, a set with a fingerprint is
    whole. An *out* that exists is refused.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(out)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise FileExistsError(f"'{out}' already exists.")
    unfinished = f"{out.rstrip('/')}.unfinished-{uuid4().hex}"
    try:
        rows.write.parquet(f"{unfinished}/data")
        if manifest is not None:
            manifest.coalesce(1).write.parquet(f"{unfinished}/manifest")
        # A rename to a folder that has come up meanwhile would move ours into it.
        if files.exists(target) or not files.rename(hadoop.Path(unfinished), target):
            raise FileExistsError(f"'{out}' came up while the set was written.")
    finally:
        files.delete(hadoop.Path(unfinished), True)
    if fingerprint is not None:
        spark.createDataFrame([(fingerprint,)], "fingerprint string").coalesce(1).write.parquet(f"{out}/fingerprint")


def stored_fingerprint(spark: SparkSession, out: str) -> str | None:
    """The fingerprint of the prepared set in *out*, or None where nothing is; a folder without one is refused."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(out).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop.Path(out)):
        return None
    if not files.exists(hadoop.Path(f"{out}/fingerprint/_SUCCESS")):
        raise FileExistsError(f"'{out}' exists and holds no whole prepared set.")
    return spark.read.parquet(f"{out}/fingerprint").first()["fingerprint"]


def read_prepared(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Rows and manifest of a stored prepared set."""
    return spark.read.parquet(f"{out}/data"), spark.read.parquet(f"{out}/manifest")
