"""SimHash near-duplicates: BK-trees over shards of fingerprints.

Fingerprints that differ in at most *radius* of 64 bits agree in at least one of ``radius + 1`` blocks of bits. A
shard is all distinct fingerprints with the same value of one block, so each pair within the radius meets in a shard and
no tree has to be sent to all rows. A shard beyond *shard_rows* is cut again by blocks of its remaining bits. In a
shard's task the fingerprints form a BK-tree, children keyed by the integer Hamming distance to their parent; a search
follows only the edges within the radius. Links leave a shard as a spanning forest, nearest pairs first, so a dense
shard gives no more rows than it has fingerprints and no connection is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import connected_components, forget, sorted_groups, stored

#: Term hashes that are turned into votes at once; bounds the memory of one very long text.
_VOTES_AT_ONCE = 1 << 18
#: Shingle hashes that are multiplied at once, for the same reason.
_HASHES_AT_ONCE = 1 << 10
#: Groups of so many members are compared pair by pair.
_FEW = 4
#: Members of a group are tested against so many centres; those still apart then meet by their rare shingles.
_CENTRES = 8


def _majority(hashes: np.ndarray, weights: np.ndarray | None = None) -> int:
    """Signed 64-bit fingerprint: the bits set in over half of the (weighted) *hashes*."""
    votes = np.zeros(64)
    for at in range(0, len(hashes), _VOTES_AT_ONCE):
        part = np.ascontiguousarray(hashes[at : at + _VOTES_AT_ONCE])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64) if weights is None else weights[at : at + _VOTES_AT_ONCE] @ bits
    total = len(hashes) if weights is None else weights.sum()
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.int64)[0])


def shingle_fingerprint(text: Column | str, words: int = 3, seed: int = 42) -> Column:
    """SimHash over XXH64 of the *words*-word shingles, repeats included (long).

    Words are runs without ASCII white space, with A-Z lower-cased. Fewer words make one shingle; no word, an empty text
    or NULL gives 0. ``bytes.split`` and ``bytes.lower`` know ASCII only, which is the definition.
    """

    def fingerprint(text: str | None) -> int:
        import xxhash

        tokens = (text or "").encode().lower().split()
        if not tokens:
            return 0
        line = b" ".join(tokens)
        ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = max(1, len(tokens) - words + 1)
        digest = xxhash.xxh64_intdigest
        pairs = zip(starts[:n].tolist(), ends[-n:].tolist())
        return _majority(np.fromiter((digest(line[s:e], seed) for s, e in pairs), np.uint64, n))

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    return run(text)


def shingle_bands(text: Column | str, words: int = 5, bands: int = 32, rows: int = 5) -> Column:
    """``(size int, keys array<long>)``: the number of different *words*-word shingles, and a key for each band.

    A key is made of *rows* least values of the shingles under hashes of their own. Two texts share the key of a band with
    probability ``J ** rows``, J being the Jaccard similarity of their shingles, whatever the kind of edit: with the
    defaults no band in common has a probability of 3e-6 at J = 0.8 and of less above. No words give no keys.
    """
    factors = np.random.default_rng(17).integers(1 << 62, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out_type = pa.struct([("size", pa.int32()), ("keys", pa.list_(pa.int64()))])

    def band_keys(text: str | None) -> dict:
        import xxhash

        tokens = (text or "").encode().lower().split()
        if not tokens:
            return {"size": 0, "keys": []}
        digest, n = xxhash.xxh64_intdigest, max(1, len(tokens) - words + 1)
        hashes = {digest(b" ".join(tokens[i : i + words])) for i in range(n)}
        values = np.fromiter(hashes, np.uint64, len(hashes))
        least = np.full(len(factors), np.iinfo(np.uint64).max)
        for at in range(0, len(values), _HASHES_AT_ONCE):
            least = np.minimum(least, (values[at : at + _HASHES_AT_ONCE, None] * factors).min(0))
        keys = [digest(part.tobytes(), band) for band, part in enumerate(least.reshape(bands, rows))]
        return {"size": len(hashes), "keys": np.array(keys, np.uint64).view(np.int64)}

    @F.arrow_udf("size int, keys array<long>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([band_keys(t.as_py()) for t in texts], out_type)

    return run(text)


def _shingle_hashes(text: Column | str, words: int) -> Column:
    """The different *words*-word shingles of a text with words, as 64-bit hashes (array<long>)."""

    def hashes(text: str) -> np.ndarray:
        import xxhash

        tokens = text.encode().lower().split()
        n = max(1, len(tokens) - words + 1)
        found = {xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words])) for i in range(n)}
        return np.fromiter(found, np.uint64, len(found)).view(np.int64)

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([hashes(t.as_py()) for t in texts], pa.list_(pa.int64()))

    return run(text)


class BkTree:
    """BK-tree of integers under Hamming distance; the children of a node are keyed by their distance to it."""

    def __init__(self) -> None:
        self._values: list[int] = []
        self._children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        values, children = self._values, self._children
        values.append(value)
        children.append({})
        at = 0
        while at != len(values) - 1:
            at = children[at].setdefault((values[at] ^ value).bit_count(), len(values) - 1)

    def within(self, value: int, radius: int) -> list[tuple[int, int]]:
        """``(distance, position)`` of all values at most *radius* away; only edges within the radius are followed."""
        values, children, found = self._values, self._children, []
        open_nodes = [0] if values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append((distance, at))
            open_nodes += [c for d, c in children[at].items() if distance - radius <= d <= distance + radius]
        return found


def _forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links between *values* (distinct) that connect all pairs within *radius*; the nearest pairs are taken first."""
    if len(values) == 2:
        if (values[0] ^ values[1]).bit_count() <= radius:
            yield values[0], values[1]
        return
    tree = BkTree()
    for value in values:
        tree.add(value)
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for level in range(1, radius + 1):
        for i, value in enumerate(values):
            for distance, j in tree.within(value, level):
                if distance == level and j < i and root(i) != root(j):
                    parent[root(i)] = root(j)
                    yield value, values[j]


def _masks(bits: int, parts: int) -> list[int]:
    """The set bits of *bits*, dealt in order to *parts* masks."""
    places = [i for i in range(64) if bits >> i & 1]
    cuts = [round(k * len(places) / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in places[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _sharded(rows: DataFrame, radius: int, shard_rows: int, left: int, levels: int) -> DataFrame:
    """Rows ``(shard, fp, id)``: each fingerprint once for each block; shards beyond *shard_rows* are cut again."""
    out = None
    for number, mask in enumerate(_masks(left, radius + 1)):
        key = F.xxhash64("shard", F.lit(number), F.col("fp").bitwiseAND(F.lit(_signed(mask))))
        block = rows.select(key.alias("shard"), "fp", "id")
        if levels > 1:
            large = block.groupBy("shard").count().where(F.col("count") > shard_rows).select("shard")
            if not large.isEmpty():
                finer = _sharded(block.join(large, "shard", "left_semi").select("shard", "fp", "id"), radius, shard_rows, left & ~mask, levels - 1)
                block = block.join(large, "shard", "left_anti").select("shard", "fp", "id").union(finer)
        out = block if out is None else out.union(block)
    return out


def link_fingerprints(fingerprints: DataFrame, radius: int = 2, shard_rows: int = 16384, levels: int = 3) -> DataFrame:
    """``(a, b)`` links between ids that connect all fingerprints at most *radius* bits apart.

    *fingerprints* has ``fp``, ``id`` (longs) and ``space``; only fingerprints of one space are compared, and they are
    distinct there. With three levels a shard of radius 2 agrees in 45 bits or more, which bounds it whatever the data.
    """
    rows = fingerprints.select(F.xxhash64("space").alias("shard"), "fp", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for group in sorted_groups(batches, "shard"):
            if group.num_rows > 1:
                values, at = np.unique(group.column("fp").to_numpy().view(np.uint64), return_index=True)
                ids = dict(zip(values.tolist(), group.column("id").to_numpy()[at].tolist()))
                for a, b in _forest(list(ids), radius):
                    left.append(ids[a])
                    right.append(ids[b])
            if len(left) > 10000:
                yield _links(left, right)
                left, right = [], []
        yield _links(left, right)

    shards = _sharded(rows, radius, shard_rows, (1 << 64) - 1, levels)
    return shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "a long, b long")


def _links(left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left, right)], names=["a", "b"])


def simhash_components(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """``(id, fingerprint long, component)``: rows linked when fingerprints differ in at most *radius* bits.

    The component is the smallest id reachable, the row itself included. A NULL id takes no part in that minimum and
    leaves a component of such rows NULL; repeated rows give repeated results; an empty table gives none. Other columns
    are not read.
    """
    own = df.select(F.col(id_column).alias("id"), shingle_fingerprint(text_column, words).alias("fp"))
    own = stored(own, "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    # Fingerprints stand for themselves, as ids may be NULL or repeat.
    points = distinct.select("fp", F.col("fp").alias("id"), F.lit(0).alias("space"))
    labels = connected_components(link_fingerprints(points, radius))
    labelled = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "first"
    )
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component"))
    components = labelled.join(smallest, "label").select("fp", "component")
    joined = own.join(components, "fp")
    return joined.select(F.col("id").alias(id_column), F.col("fp").alias("fingerprint"), "component")


def _near_fingerprints(found: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` that connect all rows ``(id, fp)`` whose fingerprints differ in at most *radius* bits."""
    distinct = stored(found.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    near = link_fingerprints(distinct.select("fp", F.col("first").alias("id"), F.lit(0).alias("space")), radius)
    equal = found.join(distinct, "fp").where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    return near.union(equal)


def similar_links(docs: DataFrame, links: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The *links* ``(a, b)`` between rows of *docs* ``(id, text)`` whose word shingles have that Jaccard similarity."""

    def shingles(text: str) -> set[bytes]:
        tokens = text.encode().lower().split()
        return {b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))}

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            p, q = shingles(x.as_py()), shingles(y.as_py())
            both = len(p & q)
            out.append(both >= similarity * (len(p) + len(q) - both))
        return pa.array(out, pa.bool_())

    left = docs.select(F.col("id").alias("a"), F.col("text").alias("_left"))
    right = docs.select(F.col("id").alias("b"), F.col("text").alias("_right"))
    pairs = links.join(left, "a").join(right, "b")
    return pairs.where(similar("_left", "_right")).select("a", "b")


def _pairs_by_rare_shingles(texts: DataFrame, members: DataFrame, words: int, similarity: float) -> DataFrame:
    """``(a, b)``: all pairs of *members* ``(id, size, label)`` with different labels that can be similar.

    Similar texts share so many shingles that, with the rarest first, they meet in one of the first of both (prefix
    filter). From the first that they share, both must have as many left as similar texts share (position filter). Both are
    exact for any order; the order by frequency lets texts that differ in many places meet nowhere.
    """
    own = texts.join(members, "id").select("id", "size", "label", F.explode(_shingle_hashes("text", words)).alias("shingle"))
    own = stored(own, "shingles")
    several = own.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    # A shingle that no other member has comes first and makes no pair, so only the number of the others counts.
    each = Window.partitionBy("id")
    place = F.row_number().over(each.orderBy("often", "shingle"))
    own_several = own.join(several, "shingle").withColumn("left", (F.count("*").over(each) - place + 1).cast("double"))
    # Rounding must not lose a pair that has just the similarity.
    first = own_several.where(F.col("left") + 1e-6 >= similarity * F.col("size"))
    first = stored(first.select("shingle", "id", "size", "label", "left"), "rare-shingles")
    labels = first.groupBy("shingle", "label").agg(F.count("*").alias("n")).groupBy("shingle")
    labels = labels.agg(F.max_by("label", "n").alias("main"), F.count("*").alias("labels")).where("labels > 1")
    meeting = stored(first.join(labels.drop("labels"), "shingle"), "meeting")
    forget(own)
    forget(first)
    # Members with the label that most have are connected; only the others look for partners.
    others = meeting.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("id", "size", "label", "left")])
    pairs = meeting.where("label <> main").join(others, "shingle")
    pairs = pairs.where("label <> _label AND (_label = main OR id > _id)")
    enough = similarity / (1 + similarity) * (F.col("size") + F.col("_size"))
    pairs = pairs.where(F.least("left", "_left") + 1e-6 >= enough)
    pairs = stored(pairs.select(F.greatest("id", "_id").alias("a"), F.least("id", "_id").alias("b")).distinct(), "candidates")
    forget(meeting)
    return pairs


def _verified(
    texts: DataFrame, members: DataFrame, words: int, similarity: float, links: DataFrame | None = None
) -> DataFrame:
    """Links ``(a, b)`` that connect all *members* ``(id, size, key)`` of one key whose texts are similar.

    *links* between similar texts may be known; what they connect is not compared again. Only links that passed connect. In
    each round some members of a key become centres, and all members of the key that are not yet connected to a centre are
    tested against it. A key is done when its members that never were centres are all connected. If large keys are
    not done after eight centres, open members are paired by :func:`_pairs_by_rare_shingles`, so in the end each pair of a key is connected,
    has been tested, or shares too few shingles to be similar. Of the keys that two members share only the
    least makes them a pair, if *members* has an array ``keys`` of all keys of an id: a pair that is not similar then costs one
    row and not one for each key.

    The first centres are worked off in two rounds: each member is tested against the smallest of its keys' centres, then
    against the rest. Members of one group mostly share their smallest centre, so the first round
    connects them and a large group costs a pair for each member and not for each member and key.
    """
    if "keys" not in members.columns:
        members = members.withColumn("keys", F.array("key"))
    groups = members.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("end"), F.max("id").alias("last"))
    groups = stored(groups.where("end <> last").drop("last"), "band-groups")

    def labels_of(links: DataFrame) -> DataFrame:
        labels = connected_components(links).select(F.col("node").alias("id"), F.col("label").alias("_label"))
        return stored(labels, "near-labels")

    def open_keys(rows: DataFrame) -> DataFrame:
        """*rows* with their labels, without the keys whose members, old centres aside, are all connected."""
        rows = rows.join(labels, "id", "left").withColumn("label", F.coalesce("_label", "id")).drop("_label")
        apart = rows.where("NOT was").groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        return stored(rows.join(apart.select("key"), "key", "left_semi"), "band-members")

    if links is None:
        links = texts.sparkSession.createDataFrame([], "a long, b long")
    labels = labels_of(links)
    rest = open_keys(members.join(groups, "key").withColumn("was", F.lit(False)))
    forget(groups)
    tested = None
    centres, most = 1, [1]
    while not rest.isEmpty():
        if centres > _CENTRES and not rest.where(F.col("n") > centres).isEmpty():
            # Against ever more centres, members that are like none would cost the square of their number.
            apart = stored(rest.where("NOT was").select("id", "size", "label").distinct(), "apart")
            pairs = _pairs_by_rare_shingles(texts, apart, words, similarity)
            links = links.union(stored(similar_links(texts, pairs, words, similarity), "similar"))
            forget(apart)
            forget(pairs)
            break
        # Members of small groups are all centres. Drawn by the hash of the id, a centre is one in all keys and later rounds.
        centre = F.col("was") | (F.col("id") == F.col("end")) | (F.col("n") <= max(centres, _FEW))
        if centres > 1:
            centre = centre | (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) * F.col("n") < centres * (1 << 30))
        now = rest.withColumn("centre", centre)
        ends = now.where("centre AND NOT was")
        ends = ends.select("key", *[F.col(c).alias(f"_{c}") for c in ("id", "size", "keys", "label")])
        # Of two new centres the larger is on the left; an old one has met all members of the key.
        pairs = now.where("NOT was").join(ends, "key").where("id <> _id AND label <> _label AND (id > _id OR NOT centre)")
        # Sets that differ more in size are not similar.
        pairs = pairs.where(F.least("size", "_size") >= similarity * F.greatest("size", "_size"))
        pairs = pairs.where(F.array_min(F.array_intersect("keys", "_keys")) == F.col("key"))
        pairs = pairs.select(F.greatest("id", "_id").alias("a"), F.least("id", "_id").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        # A list holds one centre for each key of a member at most.
        part = most.pop(0) if most else None
        if part is not None:
            own = pairs.groupBy("a").agg(F.slice(F.array_sort(F.collect_set("b")), 1, part).alias("some"))
            pairs = own.select("a", F.explode("some").alias("b"))
        pairs = stored(pairs, "candidates")
        passed = stored(similar_links(texts, pairs, words, similarity).distinct(), "similar")
        # Later rounds have new centres; only those of the first come again.
        tested = pairs if part is not None else None
        known = labels.where("id <> _label").select(F.col("id").alias("a"), F.col("_label").alias("b"))
        links = known.union(passed)
        labels = labels_of(links)
        now = now.withColumn("was", F.col("centre") if part is None else F.col("was"))
        last, rest = rest, open_keys(now.select(*members.columns, "n", "end", "was"))
        forget(last)
        if part is None:
            centres *= 8
    forget(rest)
    return links


def near_duplicate_components(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    similarity: float = 0.8,
    bands: int = 32,
    band_rows: int = 5,
    radius: int = 2,
) -> DataFrame:
    """``(id, component)`` of near-duplicate texts: the component is the smallest id of the group.

    Equal texts are one text. BK-trees find the texts whose SimHashes differ in at most *radius* bits, as in
    :func:`simhash_components`; a link stays if the *words*-word shingles of both have a Jaccard similarity of at least
    *similarity*. SimHashes of texts that differ by a run of words lie further apart, and a tree hands on a forest, of which
    a link may fail that test: so texts not yet connected that share a key of :func:`shingle_bands` are tested as well. Texts without words (NULL, empty, white space) form groups of equal
    texts only. Rows without id get no row. Rows that share an id count as one document.
    """
    rows = df.where(F.col(id_column).isNotNull())
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.concat(F.sha2(text, 256), F.length(text))
    own = rows.select(F.col(id_column).alias("id"), key.alias("key"))
    first = stored(own.groupBy("key").agg(F.min("id").alias("first")), "first-texts")
    once = rows.join(first.select(F.col("first").alias(id_column)).distinct(), id_column, "left_semi")
    texts = once.select(F.col(id_column).alias("id"), text.alias("text")).where(F.trim("text") != "")
    found = texts.select("id", shingle_fingerprint("text").alias("fp"), shingle_bands("text", words, bands, band_rows).alias("found"))
    found = stored(found.select("id", "fp", "found.size", "found.keys"), "shingle-bands")
    links = stored(similar_links(texts, _near_fingerprints(found, radius), words, similarity).distinct(), "similar")
    members = found.select("id", "size", "keys", F.explode("keys").alias("key"))
    labels = connected_components(_verified(texts, members, words, similarity, links))
    named = first.join(labels.withColumnRenamed("node", "first"), "first", "left")
    named = named.select("key", F.coalesce("label", "first").alias("component"))
    return own.join(named, "key").select(F.col("id").alias(id_column), "component")
