"""Exact weighted mixing: sampling, concatenation and the final shuffle.

How it scales
-------------
Every row has a unique key, and its place in the random order is
``md5(seed + dataset number : key)``. Exact sampling then needs no sort of the
rows: a row is taken when its hash is at or below a *threshold hash*, and the threshold
of each dataset comes from a histogram over 65,536 hash buckets plus a look into
one bucket. Hashes are uniform, so a dataset that holds most rows spreads over all
buckets like any other. The only shuffle of whole rows is the final shuffle itself;
its partition number is computed from the hash, so no sampling job runs first.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from fractions import Fraction
from operator import attrgetter

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.basics import HASH_BUCKETS, hash_bucket, order_hash

KEY = "_row_key"


@dataclass(frozen=True)
class Source:
    """One dataset of a mix.

    Give *schema* (DDL) for large JSON or CSV data: without it Spark reads everything once to
    infer it. *key* names columns that identify a row. *splittable* says that each CSV or JSON record is on a line of its
    own, so that large files are read by many tasks. *spread* deals the rows out to that many partitions, for files that
    are few and costly per row.
    """

    name: str
    path: str
    weight: float = 1.0
    transform: str | None = None
    split: str = "train"
    data_dir: str | None = None
    subset: str | None = None
    key: tuple[str, ...] = ()
    max_samples: int | None = None
    schema: str | None = None
    splittable: bool = False
    spread: int | None = None


@dataclass(frozen=True)
class Mix:
    sources: Sequence[Source] = field(default_factory=tuple)
    seed: int = 42
    chat_template: str = "chatml"


@dataclass(frozen=True)
class Part:
    """A prepared dataset: rows with a ``_row_key`` column, and how often to take them.

    *size* is an optional per-row amount (say, tokens) for running totals over the mix.
    """

    name: str
    rows: DataFrame
    weight: float = 1.0
    max_samples: int | None = None
    size: Column | None = None


def check_weights(sources: Iterable[Source | Part]) -> None:
    """Refuse empty mixes and negative weights before anything is read."""
    sources = list(sources)
    if not sources:
        raise ValueError("A mix needs at least one dataset.")
    for s in sources:
        if s.weight < 0:
            raise ValueError(f"Dataset '{s.name}' has weight {s.weight}; weights must be non-negative.")
    if sum(s.weight for s in sources) <= 0:
        raise ValueError("No rows left: the weights sum up to zero.")


def target_rows(weight: float, rows: int) -> int:
    """``round(weight * rows)``, half to even."""
    return round(weight * rows)


# What a fingerprint is made of, in this order.
FINGERPRINT_FIELDS = ("name", "path", "weight")


def mix_fingerprint(sources: Iterable[Source]) -> str:
    """Short hash that names a mix: same entries, same name."""
    digest = hashlib.sha256()
    listed = [{f: getattr(s, f) for f in FINGERPRINT_FIELDS} for s in sorted(sources, key=attrgetter("name"))]
    digest.update(json.dumps(listed).encode("utf-8"))
    return digest.hexdigest()[:8]


# -- row keys -------------------------------------------------------------------


def _content(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 of the columns' values; NULL, empty and shifted values all differ."""
    # JSON quotes and names each value, and the option keeps NULLs.
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}))


def with_row_key(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Add a ``_row_key``.

    From *key* columns if given (they must identify a row), else from the Parquet file and row number, else from the
    row's content and its place among equal rows, which are interchangeable. Where rows are split between tasks
    makes no difference to any of them.
    """
    if KEY in df.columns:
        return df
    if len(key) == 1:
        return df.withColumn(KEY, F.coalesce(F.col(key[0]).cast("string"), F.lit("\0")))
    if key:
        return df.withColumn(KEY, _content(df, key))
    return _numbered_copies(df)


#: Copies of one row that are written out in one place; more of them are dealt out first.
_COPIES_AT_ONCE = 10_000


def _numbered_copies(df: DataFrame) -> DataFrame:
    """*df* with a key from each row's content and its number among equal rows.

    Copies meet in partial aggregation, so a task sends one row for all copies that it has, and what moves is
    distinct rows with their counts. The copies are written out again where their keys are made; those of a row with
    very many are dealt out in runs first, so no task has them all.
    """
    columns = df.columns
    hashed = df.select(_content(df, columns).alias("_content"), F.struct(*[F.col(c) for c in columns]).alias("_row"))
    distinct = hashed.groupBy("_content").agg(F.any_value("_row").alias("_row"), F.count(F.lit(1)).alias("_n"))
    few = distinct.where(F.col("_n") <= _COPIES_AT_ONCE).withColumn("_from", F.lit(1).cast("bigint"))
    runs = F.sequence(F.lit(1).cast("bigint"), "_n", F.lit(_COPIES_AT_ONCE).cast("bigint"))
    many = distinct.where(F.col("_n") > _COPIES_AT_ONCE).withColumn("_from", F.explode(runs))
    # A given number of partitions stays, however few bytes the runs have before they are written out.
    many = many.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_content", "_from")
    upto = F.least(F.col("_from") + (_COPIES_AT_ONCE - 1), F.col("_n"))
    each = few.unionByName(many).select("_content", "_row", F.explode(F.sequence("_from", upto)).alias("_copy"))
    key = F.concat_ws(":", "_content", F.col("_copy").cast("string"))
    return each.select(*[F.col("_row")[c].alias(c) for c in columns], key.alias(KEY))


# -- thresholds -----------------------------------------------------------------


def hash_at_rank(keys: DataFrame, wanted: Sequence[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """The hash with rank *r* (1-based) in dataset *d*, for each wanted ``(d, r)``.

    *keys* holds ``_part`` and ``_hash``. Two narrow passes: running bucket counts find the
    bucket of each rank, then only the rows of those buckets are ranked. *wanted* holds a
    rank or two per dataset, so it enters the plan as a literal.
    """
    if not wanted:
        return {}
    bucketed = keys.select("_part", "_hash", hash_bucket(F.col("_hash")).alias("_bucket"))
    running = Window.partitionBy("_part").orderBy("_bucket")
    counts = (
        bucketed.groupBy("_part", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(running))
    )
    ranks = _literals(["part", "rank"], wanted)
    inside = F.filter(
        ranks,
        lambda w: (w["part"] == F.col("_part"))
        & (w["rank"] > F.col("_upto") - F.col("_n"))
        & (w["rank"] <= F.col("_upto")),
    )
    found = (
        counts.select("_part", "_bucket", "_n", "_upto", F.explode(inside).alias("_w"))
        .select("_part", "_bucket", "_w.rank", (F.col("_w.rank") - F.col("_upto") + F.col("_n")).alias("inside"))
        .collect()
    )
    places = _literals(["part", "bucket", "rank", "inside"], [tuple(r) for r in found])
    ordered = Window.partitionBy("_part", "_bucket").orderBy("_hash")
    here = F.filter(
        places,
        lambda w: (w["part"] == F.col("_part"))
        & (w["bucket"] == F.col("_bucket"))
        & (w["inside"] == F.col("_row")),
    )
    hits = (
        bucketed.where(F.col("_bucket").isin([r["_bucket"] for r in found]))
        .withColumn("_row", F.row_number().over(ordered))
        .withColumn("_next", F.lead("_hash").over(ordered))
        .select("_part", "_hash", "_next", F.explode(here).alias("_w"))
        .select("_part", "_w.rank", "_hash", "_next")
        .collect()
    )
    for hit in hits:
        if hit["_next"] == hit["_hash"]:
            raise ValueError(f"The row key of dataset {hit['_part']} does not identify its rows.")
    return {(r["_part"], r["rank"]): r["_hash"] for r in hits}


def _literals(names: Sequence[str], rows: Sequence[tuple]) -> Column:
    """A short list of driver-side tuples as an array of structs."""
    return F.array(
        *[F.struct(*[F.lit(int(v)).cast("bigint").alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    )


@dataclass(frozen=True)
class Take:
    """How a dataset is resampled: ``copies`` of all capped rows, one more up to ``extra``."""

    rows: int
    target: int
    cap: int

    @property
    def copies(self) -> int:
        return self.target // self.cap if self.cap else 0

    @property
    def extra(self) -> int:
        return self.target % self.cap if self.cap else 0

    def ranks(self) -> list[int]:
        """Ranks whose hash must be known."""
        out = {self.extra} if self.extra else set()
        if self.cap < self.rows and self.copies:
            out.add(self.cap)
        return sorted(out)


def _plan_takes(parts: Sequence[Part], counts: dict[int, int]) -> list[Take]:
    takes = []
    for i, part in enumerate(parts):
        rows = counts.get(i, 0)
        cap = rows if part.max_samples is None else min(rows, part.max_samples)
        takes.append(Take(rows, target_rows(part.weight, cap), cap))
    return takes


def _copies(hash_col: Column, take: Take, thresholds: dict[int, str]) -> Column:
    """How often a row is in the mix."""
    if take.target <= 0:
        return F.lit(0)
    n = F.lit(take.copies)
    if take.copies and take.cap < take.rows:
        n = F.when(hash_col <= thresholds[take.cap], n).otherwise(0)
    if take.extra:
        n = n + F.when(hash_col <= thresholds[take.extra], 1).otherwise(0)
    return n


def _copy_numbers(hash_col: Column, take: Take, thresholds: dict[int, str]) -> Column:
    """``array<int>`` with one entry per copy of the row."""
    n = _copies(hash_col, take, thresholds)
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _resampled(rows: DataFrame, take: Take, thresholds: dict[int, str]) -> DataFrame:
    if take.target == take.cap == take.rows:
        return rows.withColumn("_copy", F.lit(0))
    if take.target <= take.cap:
        wanted = thresholds[take.extra if take.extra else take.cap]
        return rows.where(F.col("_hash") <= wanted).withColumn("_copy", F.lit(0))
    return rows.select("*", F.explode(_copy_numbers(F.col("_hash"), take, thresholds)).alias("_copy"))


# -- the mix --------------------------------------------------------------------


@dataclass(frozen=True)
class Mixed:
    """The mixed rows, and what became of each dataset."""

    rows: DataFrame
    manifest: DataFrame
    targets: dict[str, int]


def _hashed(parts: Sequence[Part], seed: int) -> dict[int, DataFrame]:
    """The parts that are read, each row with the hash that is its place in its part."""
    return {i: p.rows.withColumn("_hash", order_hash(seed + i, F.col(KEY))) for i, p in enumerate(parts) if p.weight > 0}


@contextmanager
def _keys(parts: Sequence[Part], hashed: dict[int, DataFrame]) -> Iterator[DataFrame]:
    """Part, hash and size of each row, kept on disk while they are looked at."""
    keys = None
    for i, rows in hashed.items():
        amount = F.lit(0) if parts[i].size is None else parts[i].size
        one = rows.select(F.lit(i).alias("_part"), "_hash", amount.cast("bigint").alias("_size"))
        keys = one if keys is None else keys.unionAll(one)
    keys = keys.persist(StorageLevel.DISK_ONLY)
    try:
        yield keys
    finally:
        keys.unpersist()


def _planned(parts: Sequence[Part], keys: DataFrame) -> tuple[list[Take], dict[int, dict[int, str]]]:
    """How often each part is taken, and the hashes up to which its rows are."""
    counts = {r["_part"]: r["n"] for r in keys.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    takes = _plan_takes(parts, counts)
    if sum(t.target for t in takes) <= 0:
        raise ValueError("No rows left: the weights and filters leave nothing to take.")
    wanted = [(i, r) for i, t in enumerate(takes) if t.target > 0 for r in t.ranks()]
    found = hash_at_rank(keys, wanted)
    return takes, {i: {r: h for (d, r), h in found.items() if d == i} for i in range(len(parts))}


def mix_stats(parts: Sequence[Part], seed: int) -> DataFrame:
    """Statistics of the parts' *size* over the mix, which is neither made nor moved.

    ``(dataset, n_rows, total, mean, min, max, std)``, a row for each part with rows in the mix and one of NULL name for all.
    A row's number of copies is its weight in sums, sums of squares and counts, which are exact; the
    deviation is that of a sample and NULL for one row. A NULL size counts as a row of no size.
    """
    check_weights(parts)
    hashed = _hashed(parts, seed)
    with _keys(parts, hashed) as keys:
        takes, thresholds = _planned(parts, keys)
        copies, name = F.lit(0), F.lit(None).cast("string")
        for i in hashed:
            copies = F.when(F.col("_part") == i, _copies(F.col("_hash"), takes[i], thresholds[i])).otherwise(copies)
            name = F.when(F.col("_part") == i, F.lit(parts[i].name)).otherwise(name)
        size, wide = F.col("_size").cast("decimal(19, 0)"), "decimal(38, 0)"
        taken = keys.withColumn("_copies", copies.cast("decimal(10, 0)")).where(F.col("_copies") > 0)
        sums = taken.groupBy("_part").agg(
            F.sum("_copies").cast(wide).alias("n"),
            F.sum(F.col("_copies") * F.coalesce(size, F.lit(0))).cast(wide).alias("total"),
            F.sum((F.col("_copies") * F.coalesce(size * size, F.lit(0))).cast(wide)).cast(wide).alias("squares"),
            F.min("_size").alias("min"),
            F.max("_size").alias("max"),
        )
        # A row for each part is left; those come to the driver, as the keys go.
        rows = [tuple(r) for r in sums.select(name.alias("dataset"), *sums.columns[1:]).collect()]
    spark = parts[0].rows.sparkSession
    order = {p.name: i for i, p in enumerate(parts)}
    each = [_moments(r[0], [r]) for r in sorted(rows, key=lambda r: order[r[0]])]
    return spark.createDataFrame(
        [*each, _moments(None, rows)],
        "dataset string, n_rows bigint, total bigint, mean double, min bigint, max bigint, std double",
    )


def _moments(name: str | None, rows: Sequence[tuple]) -> tuple:
    """Merged counts, sums and sums of squares as statistics; the sums are whole numbers, so nothing cancels out."""
    n, total, squares = (sum(int(r[i]) for r in rows) for i in (1, 2, 3))
    least = [r[4] for r in rows if r[4] is not None]
    most = [r[5] for r in rows if r[5] is not None]
    std = math.sqrt(Fraction(n * squares - total * total, n * (n - 1))) if n > 1 else None
    return name, n, total, total / n, min(least, default=None), max(most, default=None), std


def mix_parts(
    parts: Sequence[Part],
    seed: int,
    *,
    position: bool = False,
    shuffle: bool = True,
    partitions: int | None = None,
) -> Mixed:
    """Resample each part by weight, concatenate by column name, shuffle.

    Weights apply to the rows as given (after transforms and filters). A part of weight
    zero is never read. Adds ``_dataset`` (the part's name). With *position*, rows get their
    exact place ``0..n-1`` in the shuffled order, and, where the parts have a *size*,
    ``start``: the total size of all rows before.

    A narrow pass over keys (and sizes) finds counts, thresholds and bucket starts; it is kept on
    disk while those are computed. The rows themselves move once, in the final shuffle.
    """
    check_weights(parts)
    spark = parts[0].rows.sparkSession
    hashed = _hashed(parts, seed)
    with _keys(parts, hashed) as keys:
        takes, thresholds = _planned(parts, keys)
        used = [(i, p) for i, p in enumerate(parts) if i in hashed and takes[i].target > 0]
        starts = None
        if position and shuffle:
            starts = _bucket_starts(keys, used, takes, thresholds, seed)

    mixed = None
    for i, part in used:
        one = _resampled(hashed[i], takes[i], thresholds[i]).withColumn("_dataset", F.lit(part.name))
        if position and part.size is not None:
            one = one.withColumn("_size", part.size.cast("bigint"))
        mixed = one if mixed is None else mixed.unionByName(one, allowMissingColumns=True)
    if shuffle:
        rows = sum(t.target for t in takes if t.target > 0)
        mixed = _shuffled(mixed, seed, starts, partitions or shuffle_partitions(spark, rows))
    manifest = spark.createDataFrame(
        [(p.name, float(p.weight), t.rows, max(t.target, 0)) for p, t in zip(parts, takes, strict=True)],
        "dataset string, weight double, rows_before bigint, rows_after bigint",
    )
    targets = {p.name: t.target for p, t in zip(parts, takes, strict=True)}
    return Mixed(mixed.drop("_hash", KEY), manifest, targets)


#: Rows that one partition of the final shuffle gets at most, while there are hash buckets left.
ROWS_PER_PARTITION = 200_000


def shuffle_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of the final shuffle: the session's number, or more where the counted rows need them."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(HASH_BUCKETS, max(least, -(-rows // ROWS_PER_PARTITION)))


def _shuffle_hash(seed: int) -> Column:
    return order_hash("shuffle", seed, F.col("_hash"), F.col("_copy"))


def _bucket_starts(keys, used, takes, thresholds, seed) -> DataFrame:
    """First position of each shuffle bucket: at most 65,536 rows, whatever the data size."""
    numbers = F.array().cast("array<int>")
    for i, _ in used:
        own = _copy_numbers(F.col("_hash"), takes[i], thresholds[i])
        numbers = F.when(F.col("_part") == i, own).otherwise(numbers)
    copies = keys.select("_hash", "_size", F.explode(numbers).alias("_copy"))
    counted = (
        copies.groupBy(hash_bucket(_shuffle_hash(seed)).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_amount"))
        .toPandas()
        .sort_values("_bucket")
    )
    counted["_first"] = counted["_n"].cumsum() - counted["_n"]
    counted["_before"] = counted["_amount"].cumsum() - counted["_amount"]
    return copies.sparkSession.createDataFrame(
        counted[["_bucket", "_first", "_before"]], "_bucket int, _first bigint, _before bigint"
    )


def _shuffled(rows: DataFrame, seed: int, starts: DataFrame | None, partitions: int | None) -> DataFrame:
    """Move each row straight to its partition by hash, then sort inside the partition."""
    return place_by_hash(rows.withColumn("_place", _shuffle_hash(seed)), starts, partitions).drop("_copy")


def place_by_hash(rows: DataFrame, starts: DataFrame | None, partitions: int | None) -> DataFrame:
    """Globally order rows by ``_place`` (an md5); with *starts* also number them."""
    n = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_bucket", hash_bucket(F.col("_place"))).withColumn(
        "_pid", F.floor(F.col("_bucket") * F.lit(n) / F.lit(HASH_BUCKETS)).cast("int")
    )
    rows = rows.repartitionById(n, "_pid")
    if starts is None:
        return rows.sortWithinPartitions("_place").drop("_place", "_bucket", "_pid")
    inside = Window.partitionBy("_pid", "_bucket").orderBy("_place")
    rows = rows.withColumn("_inside", F.row_number().over(inside))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = "_size" in rows.columns
    if sized:
        rows = rows.withColumn("_upto", F.sum("_size").over(upto))
    # A left join: every bucket has a start, and no null test is pushed below the shuffle.
    placed = rows.join(F.broadcast(starts), "_bucket", "left").withColumn(
        "position", F.col("_first") + F.col("_inside") - 1
    )
    if sized:
        placed = placed.withColumn("start", F.col("_before") + F.col("_upto") - F.col("_size"))
    return placed.drop("_place", "_bucket", "_pid", "_inside", "_first", "_before", "_upto", "_size")


# -- single-table forms -----------------------------------------------------------


def sample_exact(df: DataFrame, n: int, seed: int, key: Sequence[str] = ()) -> DataFrame:
    """Exactly *n* rows: without replacement up to the table size, else balanced copies."""
    if n <= 0:
        raise ValueError("The number of rows must be positive.")
    keyed = with_row_key(df, key).withColumn("_hash", order_hash(seed, F.col(KEY)))
    keys = keyed.select(F.lit(0).alias("_part"), "_hash").persist(StorageLevel.DISK_ONLY)
    try:
        rows = keys.count()
        if rows == 0:
            raise ValueError("An empty dataset cannot be resampled.")
        take = Take(rows, n, rows)
        found = hash_at_rank(keys, [(0, r) for r in take.ranks()])
    finally:
        keys.unpersist()
    out = _resampled(keyed, take, {r: h for (_, r), h in found.items()})
    return out.drop("_hash", "_copy") if KEY in df.columns else out.drop("_hash", "_copy", KEY)


def cap_rows(df: DataFrame, limit: int | None, seed: int, key: Sequence[str] = ()) -> DataFrame:
    """At most *limit* rows, picked by hash; NULL means all."""
    if limit is None:
        return df
    keyed = with_row_key(df, key)
    n = keyed.count()
    if n <= limit:
        return df
    return sample_exact(keyed, limit, seed).drop(*([] if KEY in df.columns else [KEY]))


def number_rows(
    df: DataFrame,
    seed: int,
    key: Sequence[str] = (),
    size: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Shuffle one table by seed; add ``position`` and, with *size*, ``start``."""
    part = Part("all", with_row_key(df, key), size=size)
    return mix_parts([part], seed, position=True, partitions=partitions).rows.drop("_dataset")
