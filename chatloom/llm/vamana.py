"""Approximate nearest neighbours by largest inner product: robust-pruned directed graphs over shards.

Each shard's graph starts as random links and is refined point by point: a greedy search from the medoid proposes
neighbours, and robust pruning keeps a proposal only if no nearer kept neighbour is *alpha* times nearer to it than the point
is, so edges stay short and diverse. All points of a batch are searched together. Queries go through every shard's graph by
beam search and the shards' lists are merged, with exact scores.

Inner products become distances by one more component that makes all vectors equally long. Shards are balanced by a
hash of the vector, and equal vectors are one point: only the ids that can be among the nearest go along with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.common import stored

_TOGETHER = 512


def _distances(points: np.ndarray, squares: np.ndarray, targets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances, less the targets' own squares, of each target to its row of *ids*; missing ids are far away."""
    found = squares[ids] - 2 * np.matmul(points[ids], targets[:, :, None])[:, :, 0]
    return np.where(ids < 0, np.inf, found)


def beam_search(
    points: np.ndarray, links: np.ndarray, entry: int, targets: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, distances)`` of the *beam* nearest points found for each target, nearest first; -1 fills short rows.

    In each step a target opens its nearest unopened point of the beam and looks at that point's links, which are all
    different.
    """
    n, rows = len(targets), np.arange(len(targets))
    squares = (points**2).sum(1)
    ids = np.full((n, beam), -1, np.int64)
    ids[:, 0] = entry
    near = _distances(points, squares, targets, ids).astype(np.float32)
    opened = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(points) + 1), bool)  # The last column stands for missing links.
    seen[:, [entry, -1]] = True
    going = rows
    while len(going):
        waiting = np.where(opened[going] | (ids[going] < 0), np.inf, near[going])
        at = waiting.argmin(1)
        busy = np.isfinite(waiting[np.arange(len(going)), at])
        going, at = going[busy], at[busy]
        if not len(going):
            break
        opened[going, at] = True
        more = links[ids[going, at]]
        new = ~seen[going[:, None], more]
        seen[going[:, None], more] = True
        more = np.where(new, more, -1)
        far = _distances(points, squares, targets[going], more)
        all_ids = np.concatenate([ids[going], more], 1)
        all_near = np.concatenate([near[going], far], 1)
        all_opened = np.concatenate([opened[going], np.zeros(more.shape, bool)], 1)
        best = np.argpartition(all_near, beam - 1, axis=1)[:, :beam]
        ids[going] = np.take_along_axis(all_ids, best, 1)
        near[going] = np.take_along_axis(all_near, best, 1)
        opened[going] = np.take_along_axis(all_opened, best, 1)
    order = np.argsort(near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def robust_prune(points: np.ndarray, at: np.ndarray, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most *degree* of each row's *proposals* (-1: none) for the points *at*; the rest of a row is -1."""
    n = len(at)
    own = points[at]
    vectors = points[proposals]
    to_own = ((vectors - own[:, None, :]) ** 2).sum(2)
    to_own[(proposals < 0) | (proposals == at[:, None])] = np.inf
    kept, rows = np.full((n, degree), -1, np.int64), np.arange(n)
    for k in range(degree):
        nearest = to_own.argmin(1)
        left = np.isfinite(to_own[rows, nearest])
        if not left.any():
            break
        kept[left, k] = proposals[rows, nearest][left]
        chosen = vectors[rows, nearest]
        to_chosen = ((vectors - chosen[:, None, :]) ** 2).sum(2)
        # Distances are squared, so alpha is too.
        to_own[alpha * alpha * to_chosen <= to_own] = np.inf
        to_own[rows, nearest] = np.inf
    return kept


def build_graph(points: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, passes: int = 1) -> tuple[np.ndarray, int]:
    """``(links, entry)``: each point's links (-1: none) and the point where searches begin."""
    n = len(points)
    rng = np.random.default_rng(11)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    links = np.full((n, degree), -1, np.int64)
    if n == 1:
        return links, entry
    few = min(degree, n - 1)
    links[:, :few] = (np.arange(n)[:, None] + 1 + rng.choice(n - 1, few, replace=False)) % n
    for _ in range(passes):
        order = rng.permutation(n)
        for start in range(0, n, _TOGETHER):
            batch = order[start : start + _TOGETHER]
            found, _ = beam_search(points, links, entry, points[batch], min(beam, n))
            links[batch] = robust_prune(points, batch, np.concatenate([found, links[batch]], 1), degree, alpha)
            # Links back; a point that gets too many is pruned again.
            source = np.repeat(batch, degree)
            target = links[batch].ravel()
            new = (target >= 0) & ~(links[target] == source[:, None]).any(1)
            source, target = source[new], target[new]
            if not len(target):
                continue
            by_target = np.argsort(target, kind="stable")
            source, target = source[by_target], target[by_target]
            points_back, first = np.unique(target, return_index=True)
            counts = np.diff([*first, len(target)])
            nth = np.arange(len(target)) - np.repeat(first, counts)
            proposals = np.full((len(points_back), degree + counts.max()), -1, np.int64)
            proposals[:, :degree] = links[points_back]
            proposals[np.repeat(np.arange(len(points_back)), counts), degree + nth] = source
            full = (proposals >= 0).sum(1) > degree
            packed = np.take_along_axis(proposals, np.argsort(proposals < 0, axis=1, kind="stable"), 1)
            links[points_back[~full]] = packed[~full, :degree]
            # In parts, as one point may have been chosen by many.
            for part in np.array_split(np.flatnonzero(full), 1 + full.sum() // _TOGETHER):
                if len(part):
                    links[points_back[part]] = robust_prune(points, points_back[part], packed[part], degree, alpha)
    return links, entry


def _lifted(vectors: np.ndarray, scale: float, longest: float) -> np.ndarray:
    """One more component, after which the nearest vector is that with the largest inner product.

    *scale* is the largest component of all vectors and *longest* the largest squared length at that scale, so that single
    precision holds them whatever their size.
    """
    vectors = vectors / scale
    rest = np.sqrt(np.maximum(longest - (vectors**2).sum(1), 0))
    return np.concatenate([vectors, rest[:, None]], 1).astype(np.float32)


def usable_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``(id, vector array<double>)`` of the rows that take part: not NULL, empty or zero, all components finite, id known."""
    vector = F.col(vector_column).cast("array<double>")
    rows = df.select(F.col(id_column).alias("id"), vector.alias("vector")).where("id IS NOT NULL AND size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def _columns(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, list[list[int]]]:
    table = pa.Table.from_batches(batches)
    vectors = table.column("vector").combine_chunks().flatten().to_numpy()
    return vectors.reshape(table.num_rows, -1), table.column("ids").to_pylist()


def answers(
    batches: Iterator[pa.RecordBatch], scale: float, longest: float, k: int, degree: int, beam: int, query_beam: int
) -> Iterator[pa.RecordBatch]:
    """``(query_id, id, score)`` from rows ``(shard, ids, vector, asks)`` sorted by shard, its points before its queries.

    A shard's graph is built when its first query comes. Held are the points of one shard and at most 512 queries.
    """
    shard, held, graph = None, [], None
    for batch in batches:
        keys = batch.column("shard").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if start == end:
                continue
            if keys[start] != shard:
                shard, held, graph = keys[start], [], None
            if not asks[start]:
                held.append(batch.slice(start, end - start))
                continue
            if graph is None:
                if not held:
                    continue
                own, own_ids = _columns(held)
                lifted = _lifted(own, scale, longest)
                held, graph = [], build_graph(lifted, degree, beam)
            links, entry = graph
            for at in range(start, end, _TOGETHER):
                part, target_ids = _columns([batch.slice(at, min(_TOGETHER, end - at))])
                # Only a query's direction counts.
                aims = part / np.abs(part).max(1, keepdims=True)
                aims = np.concatenate([aims, np.zeros((len(part), 1))], 1).astype(np.float32)
                found, _ = beam_search(lifted, links, entry, aims, min(max(query_beam, k + 1), len(own)))
                # A search that was cut off from most of the graph looks at all points of the shard.
                short = np.flatnonzero((found >= 0).sum(1) < min(k + 1, len(own)))
                if len(short):
                    products = (own / scale) @ part[short].T
                    most = np.argsort(-products, axis=0, kind="stable")[: found.shape[1]].T
                    found[short] = most
                # The points found are scored again in double precision, of them the best k + 1 are enough.
                scores = np.einsum("qbd,qd->qb", own[found], part)
                scores[found < 0] = -np.inf
                out: dict[str, list] = {"query_id": [], "id": [], "score": []}
                for row, (query,) in enumerate(target_ids):
                    order = np.argsort(-scores[row], kind="stable")
                    least = scores[row][order[min(k, len(order) - 1)]]
                    near = [
                        (-scores[row][c], i)
                        for c in order
                        if scores[row][c] >= least and found[row][c] >= 0
                        for i in own_ids[found[row][c]]
                        if i != query
                    ]
                    for score, i in sorted(near)[:k]:
                        out["query_id"].append(query)
                        out["id"].append(i)
                        out["score"].append(-score)
                yield pa.RecordBatch.from_pydict(out, pa.schema({"query_id": pa.int64(), "id": pa.int64(), "score": pa.float64()}))


def nearest_by_inner_product(
    df: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = 4096,
    degree: int = 32,
    beam: int = 64,
    query_beam: int = 96,
) -> DataFrame:
    """``(query_id, rank, id, score)``: for each row of *queries* its *k* nearest rows of *df*, its own id left out.

    Nearest is the largest inner product in double precision, ties go to the smaller id. Rows whose vector is NULL, empty
    or zero, or holds NULL or non-finite components, and rows without id, take no part. All vectors need one length.
    Repeated rows count once. Shards have about *shard_rows* different vectors.
    """
    spark = df.sparkSession
    rows = usable_vectors(df, id_column, vector_column)
    # Of equal vectors only the k + 1 smallest ids can be among the nearest.
    smallest = Window.partitionBy("key").orderBy("id")
    keyed = rows.distinct().withColumn("key", F.sha2(F.to_json(F.struct("vector")), 256))
    few = keyed.withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k + 1)
    points = few.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
    points = stored(points.select("ids", "vector", F.xxhash64("key").alias("hash")), "points")
    n, scale = points.agg(F.count("*"), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    out_type = "query_id long, id long, score double"
    if not n:
        return spark.createDataFrame([], out_type).select("query_id", F.lit(0).alias("rank"), F.col("id").alias(id_column), "score")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.lit(scale)) * (x / F.lit(scale)))
    longest = points.agg(F.max(squares)).first()[0]
    shards = -(-n // shard_rows)
    wanted = stored(usable_vectors(queries, id_column, vector_column).distinct(), "queries")
    # A query visits each shard: the query set is stated, and streams past the shard's graph.
    to_all = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    asked = wanted.select(to_all.alias("shard"), F.array("id").alias("ids"), "vector", F.lit(True).alias("asks"))
    held = points.select(F.pmod("hash", F.lit(shards)).alias("shard"), "ids", "vector", F.lit(False).alias("asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return answers(batches, scale, longest, k, degree, beam, query_beam)

    # One task for each shard; a hash of the number would put several into one.
    together = held.union(asked).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "asks")
    found = together.mapInArrow(run, out_type)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
