"""SimHash fingerprints in DataFrame functions, and a search over permuted block tables.

A text's terms are its pairs of neighbouring words. Each term's 64-bit hash votes on every bit with the weight of its first
word, its length: long words are rare ones. Two votes are summed in each of 32 long columns, so that the work is one
hash aggregation. Fingerprints within a Hamming radius agree in one of ``radius + 1`` blocks of bits; a table for each
block puts that block first, and equal leading blocks give the candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LANES = 32
_TWO_LANES = (1 << 32) + 1
_FANOUT = 256
_LEAST = -(1 << 63)


def term_pairs(text: Column) -> Column:
    """Array of the pairs of neighbouring words; the last word stands alone. A text without words has one empty term."""
    words = F.split(text, r"\s+")
    return F.arrays_zip(words.alias("first"), F.slice(words, 2, F.size(words)).alias("second"))


def votes(term: Column) -> list[Column]:
    """Sums over a text's terms that :func:`bits` makes a fingerprint of."""
    weight = F.octet_length(term["first"]).cast("long")
    digest = F.xxhash64(term["first"], term["second"])
    lanes = [F.shiftrightunsigned(digest, i).bitwiseAND(F.lit(_TWO_LANES)) * weight for i in range(_LANES)]
    # A lane holds at most the text's bytes, which are below 2^31.
    return [F.sum(lane).alias(f"_v{i}") for i, lane in enumerate(lanes)] + [F.sum(weight).alias("_weight")]


def bits() -> Column:
    """The fingerprint (long): bits with more than half of the weight."""
    out = F.lit(0).cast("long")
    for i in range(_LANES):
        low, high = F.col(f"_v{i}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"_v{i}", 32)
        for value, place in ((low, i), (high, i + 32)):
            mask = 1 << place
            mask -= (1 << 64) if place == 63 else 0
            out = out.bitwiseOR(F.when(value * 2 > F.col("_weight"), F.lit(mask)).otherwise(F.lit(0)).cast("long"))
    return out


def fingerprint_hex(value: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, fingerprint long)``; NULL text is empty, rows that share id and text give one row, NULL ids stay."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.xxhash64(text)
    terms = df.select(F.col(id_column), key.alias("_text"), F.explode(term_pairs(text)).alias("term"))
    return terms.groupBy(id_column, "_text").agg(*votes(F.col("term"))).select(id_column, bits().alias("fingerprint"))


def near_fingerprints(index: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """``(query, fp, distance)``: for each fingerprint of *queries* ``query`` all those of *index* ``fp`` within *radius*.

    Both sides are made distinct first, so copies are found once.
    """
    cuts = [round(k * 64 / (radius + 1)) for k in range(radius + 2)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        keys = []
        for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
            # Rotate the block to the front; what is in front is the key.
            turned = F.shiftleft(name, 64 - high) if high < 64 else F.col(name)
            keys.append(F.struct(F.lit(number).alias("table"), F.shiftrightunsigned(turned, 64 - (high - low)).alias("block")))
        return df.select(name).distinct().withColumn("key", F.explode(F.array(*keys))).select(name, "key.*")

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    pairs = tables(index, "fp").join(tables(queries, "query"), ["table", "block"])
    return pairs.withColumn("distance", distance).where(F.col("distance") <= radius).select("query", "fp", "distance").distinct()


def _id_bounds(ids: DataFrame, rows_per_bucket: int) -> list[int]:
    """Ids of the table at which buckets of about *rows_per_bucket* rows begin, at most 65,536; the least id is the first."""
    n, least = ids.agg(F.count("*"), F.min("ord")).first()
    buckets = max(1, min(_FANOUT * _FANOUT, n // rows_per_bucket))
    if not n:
        return [_LEAST]
    shares = [k / buckets for k in range(1, buckets)] or [0.0]
    found = ids.agg(F.percentile_approx("ord", shares, max(10000, 10 * buckets))).first()[0]
    return sorted({least, *found})


def with_next(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows_per_bucket: int = 200
) -> DataFrame:
    """Rows ``(bucket, row, guest, id, text, next_text)``, the next by ascending id, after the last the first.

    NULL ids come first and rows that share an id are in the order of their texts. Rows are bucketed by id ranges; the
    first row of a range is also a guest of the range before, so a bucket never needs another one. Guests are no results.
    """
    rows = df.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST)).alias("ord"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    bounds = _id_bounds(rows.select("ord"), rows_per_bucket)
    groups = [bounds[i : i + _FANOUT] for i in range(0, len(bounds), _FANOUT)]
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    rows = rows.withColumn("_at", F.size(F.filter(longs([g[0] for g in groups]), lambda b: b <= F.col("ord"))))
    rows = rows.withColumn("_group", F.element_at(F.array(*map(longs, groups)), F.col("_at")))
    rows = rows.withColumn("_in", F.size(F.filter("_group", lambda b: b <= F.col("ord"))))
    bucket = (F.col("_at") - 1) * _FANOUT + F.col("_in") - 1
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"), F.lit(0).alias("lap"))
    last = F.lit(len(bounds) - 1)
    guest = F.struct(
        F.when(bucket == 0, last).otherwise(bucket - 1).alias("bucket"),
        F.lit(True).alias("guest"),
        F.when(bucket == 0, 1).otherwise(0).alias("lap"),
    )
    begins = F.element_at("_group", F.col("_in")) == F.col("ord")
    placed = rows.select("id", "ord", "text", F.explode(F.when(begins, F.array(own, guest)).otherwise(F.array(own))).alias("p"))
    placed = placed.select("id", "ord", "text", "p.*")
    order = Window.partitionBy("bucket").orderBy("lap", "ord", "text", "guest")
    return placed.select(
        "bucket", F.row_number().over(order).alias("row"), "guest", "id", "text", F.lead("text").over(order).alias("next_text")
    )


def edited_fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last half is the beginning of the next text.

    Columns: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. NULL texts are empty; a
    table of one row is its own next; an empty table gives none. Order as in :func:`with_next`.
    """
    half = F.expr("n_chars div 2").cast("int")
    rows = with_next(df, id_column, text_column).withColumn("n_chars", F.length("text"))
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)
    )
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    kinds = F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("text")),
        F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")),
    )
    keys = ["bucket", "row", "guest", "id", "n_chars", "edited_sha256"]
    both = rows.select(*keys, F.explode(kinds).alias("kind"))
    terms = both.select(*keys, F.col("kind.is_edited").alias("is_edited"), F.explode(term_pairs(F.col("kind.text"))).alias("term"))
    prints = terms.groupBy(*keys, "is_edited").agg(*votes(F.col("term"))).select(*keys, "is_edited", bits().alias("fp"))
    pairs = prints.groupBy(*keys).agg(
        F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"), F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited")
    )
    following = F.lead("fp").over(Window.partitionBy("bucket").orderBy("row"))
    pairs = pairs.withColumn("next", following).where(~F.col("guest"))
    return pairs.select(
        F.col("id").alias(id_column),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint_hex("fp").alias("fingerprint"),
        fingerprint_hex("edited").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next")).alias("near_next"),
    )
