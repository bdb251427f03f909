"""Approximate nearest neighbours by inner product, over balanced posting lists.

Centroids are fitted on a bounded sample: a cluster that would hold more than its share is split again,
so lists come out even. Every vector goes to its nearest centroid, and a vector near a boundary to
further ones too, unless such a centroid is close to one already chosen. Queries walk an in-memory graph
over the centroids (each linked with its nearest) from several entries, and search the lists whose
distance is within a ratio of the nearest, which is few where vectors cluster and many where they do not.
Lists are put together into blocks; only the best of a block leave
its task.

Inner products of vectors of unequal length are turned into distances by one more coordinate that makes
all vectors equally long. Equal vectors are stored once, with their `top + 1` smallest ids: ties go to
smaller ids, so no result needs more. A list that holds more than `block` vectors is dealt over several
tasks.

Defined cases: vectors that are NULL, empty, zero or hold NULL, NaN or infinite components take no part,
as candidates or queries; of vectors of several lengths, those of the commonest length take part (of
equally common ones, the longest); rows without an id take no part; rows that share an id but not a vector
are separate candidates, of which a query never meets any with its own id; a table without vectors gives
no rows; with fewer candidates than `top`, all are returned that the search meets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import texts as tx

TOP = 20
SAMPLE = 64_000  # vectors that centroids are fitted on, at most about
PER_LIST = 400  # vectors of the table for each centroid, up to MOST_LISTS
MOST_LISTS = 16_384
COPIES = 2  # lists that one vector goes to at most
NEAR_BOUNDARY = 1.05  # distance to a further centroid, as a ratio of the nearest
COVERED = 0.3  # a further centroid this near to a chosen one, as a ratio of its distance, adds nothing
PRUNE = 1.15  # distance of lists that are searched, as a ratio of the nearest
SEARCHED = 0.45  # share of all lists that a query searches at most
ALWAYS = 0.25  # share of lists that it searches whatever their distance: norms may differ widely
LINKS = 24
BLOCK = 32_768


class Centroids:
    """Centroids with a graph of their nearest neighbours."""

    def __init__(self, points: np.ndarray, links: int = LINKS):
        self.points = points
        self.squares = (points * points).sum(axis=1)
        self.links = np.empty((len(points), min(links, len(points))), np.int32)
        for start in range(0, len(points), 512):
            d = self._all(points[start : start + 512])
            self.links[start : start + 512] = np.argsort(d, axis=1, kind="stable")[:, : self.links.shape[1]]
        step = max(len(points) // 64, 1)
        self.entries = np.arange(0, len(points), step)

    def _all(self, vectors: np.ndarray) -> np.ndarray:
        return self.squares[None, :] - 2 * vectors @ self.points.T

    def search(self, vector: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids that a best-first walk over the graph meets, and their distances."""
        seen = np.zeros(len(self.points), bool)
        square = float(vector @ vector)

        def distances(places: np.ndarray) -> np.ndarray:
            return np.maximum(self.squares[places] - 2 * self.points[places] @ vector + square, 0)

        best = self.entries
        seen[best] = True
        far = distances(best)
        open_ = np.ones(len(best), bool)
        while True:
            order = np.argsort(far, kind="stable")[: 2 * count]
            best, far, open_ = best[order], far[order], open_[order]
            # The nearest few that were not followed yet; done when all that count have been.
            todo = np.flatnonzero(open_[:count])[:8]
            if len(todo) == 0:
                return best[:count], np.sqrt(far[:count])
            open_[todo] = False
            fresh = np.unique(self.links[best[todo]])
            fresh = fresh[~seen[fresh]]
            if len(fresh) == 0:
                continue
            seen[fresh] = True
            best = np.concatenate((best, fresh))
            far = np.concatenate((far, distances(fresh)))
            open_ = np.concatenate((open_, np.ones(len(fresh), bool)))


def balanced_centroids(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """About `lists` centroids whose clusters hold even shares of the sample: oversized ones split."""
    rng = np.random.default_rng(seed)
    share = max(len(sample) // max(lists, 1), 1)
    todo = [np.arange(len(sample))]
    done = []
    while todo:
        members = todo.pop()
        if len(members) <= 1.5 * share or len(done) + len(todo) >= 2 * lists:
            done.append(sample[members].mean(axis=0))
            continue
        points = sample[members]
        ways = int(min(max(round(len(members) / share), 2), 32))
        centres = points[rng.choice(len(points), ways, replace=False)]
        for _ in range(8):
            near = np.argmin((centres * centres).sum(1)[None, :] - 2 * points @ centres.T, axis=1)
            for k in range(ways):
                if (near == k).any():
                    centres[k] = points[near == k].mean(axis=0)
        parts = [members[near == k] for k in range(ways) if (near == k).any()]
        if len(parts) == 1:  # equal points cannot be split
            done.append(points.mean(axis=0))
        else:
            todo += parts
    return np.array(done)


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _lifted(vectors: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Vectors with the coordinate that makes nearness by distance equal to that by inner product."""
    squares = (vectors * vectors).sum(axis=1)
    if query:  # only the direction of a query matters
        unit = vectors * (longest / np.sqrt(squares))[:, None]
        return np.hstack([unit, np.zeros((len(vectors), 1))])
    return np.hstack([vectors, np.sqrt(np.maximum(longest**2 - squares, 0))[:, None]])


def _lists_of(vector: Column, centroids: Centroids, longest: float, query: bool) -> Column:
    """The lists that a vector is stored in, or that a query searches: array of int."""

    def run(column: pa.Array) -> pa.Array:
        chosen, counts = [], []
        for point in _lifted(_matrix(column), longest, query) if len(column) else []:
            if query:
                most = max(int(np.ceil(SEARCHED * len(centroids.points))), 8)
                best, far = centroids.search(point, most)
                sure = max(int(np.ceil(ALWAYS * len(centroids.points))), 8)
                near = best[(far <= PRUNE * max(far[0], 1e-12)) | (np.arange(len(best)) < sure)]
            else:
                best, far = centroids.search(point, 2 * COPIES)
                near = []
                for place, distance in zip(best, far):
                    if len(near) == COPIES or distance > NEAR_BOUNDARY * max(far[0], 1e-12):
                        break
                    apart = centroids.points[near] - centroids.points[place]
                    if near and np.sqrt((apart * apart).sum(axis=1)).min() < COVERED * distance:
                        continue  # another chosen list covers this side of the boundary
                    near.append(int(place))
            chosen.extend(int(x) for x in near)
            counts.append(len(near))
        return tx.lists(np.array(chosen, np.int32), np.array(counts, np.int64), pa.int32())

    return F.arrow_udf(run, "array<int>").asNondeterministic()(vector)


def _exact(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products one by one, in one order of additions, so that equal vectors score equal."""
    return (queries * candidates).sum(axis=1)


def _search_block(left: pd.DataFrame, right: pd.DataFrame, top: int) -> pd.DataFrame:
    """The best `top + 1` candidates of a block of lists, for each query that searches some of them."""
    out = {"q": [], "c": [], "first_id": [], "score": []}
    if len(left) and len(right):
        candidates = np.array(right["vector"].tolist(), np.float64)
        ids, firsts = right["c"].to_numpy(np.int64), right["first_id"].to_numpy(np.int64)
        longest = np.linalg.norm(candidates, axis=1).max()
        lists, list_of = np.unique(right["list"].to_numpy(np.int64), return_inverse=True)
        for start in range(0, len(left), 256):
            part = left.iloc[start : start + 256]
            queries = np.array(part["vector"].tolist(), np.float64)
            searched = np.array([np.isin(lists, wanted) for wanted in part["lists"]])
            rough = np.where(searched[:, list_of], queries @ candidates.T, -np.inf)
            keep = min(COPIES * (top + 1), len(ids))  # a candidate may stand on several lists
            best = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
            for row, places in enumerate(best):
                # All that may tie with the last that counts: both sums are off by rounding, at most by this.
                off = 4 * queries.shape[1] * np.finfo(float).eps * np.linalg.norm(queries[row]) * longest
                _, once = np.unique(ids[places], return_index=True)
                scores = np.sort(rough[row, places[once]])[::-1]
                edge = scores[top] - off if len(scores) > top else -np.inf
                places = np.flatnonzero((rough[row] >= edge) & (rough[row] > -np.inf))
                _, once = np.unique(ids[places], return_index=True)
                places = places[once]
                score = _exact(queries[row][None, :], candidates[places])
                order = np.lexsort((firsts[places], -score))[: top + 1]
                out["q"].append(np.full(len(order), part["q"].iloc[row]))
                out["c"].append(ids[places[order]])
                out["first_id"].append(firsts[places[order]])
                out["score"].append(score[order])
    return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}).astype(
        {"q": "int64", "c": "int64", "first_id": "int64", "score": "float64"}
    )


def _blocks(heights: dict[int, int], lists: int, block: int) -> list[tuple[int, int, int]]:
    """(list, block, ways): lists in order put together into blocks of about `block` vectors.

    A longer list is a block of its own, dealt over several tasks.
    """
    dealt, number, held = [], 0, 0
    for one in range(lists):
        height = heights.get(one, 0)
        if held and held + height > block:
            number, held = number + 1, 0
        dealt.append((one, number, max(-(-height // block), 1)))
        held += height
    return dealt


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    vector = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vector.alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    rows = rows.where(~odd & F.exists("vector", lambda x: x != 0))
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    common = widths.orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.size("vector") == (common["width"] if common else 0))


def nearest(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    query: Column | None = None,
    top: int = TOP,
    sample: int = SAMPLE,
    per_list: int = PER_LIST,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of each query, ties to the smaller vec_id.

    `query` tells the rows that are queries (by default those whose id is divisible by 20).
    """
    spark = vectors.sparkSession
    rows = staging.stage(usable(vectors, vec_id, embedding))
    asked = (F.col("vec_id") % 20 == 0) if query is None else query
    # Equal vectors once: `c` numbers them by their smallest id and a hash, `ids` are the smallest ids.
    rows = rows.withColumn("print", F.xxhash64("vector")).withColumn("asked", asked)
    small = rows.groupBy("print", "vector").agg(F.min("vec_id").alias("first_id"))
    unique = staging.stage(small.withColumn("c", F.xxhash64("vector", "first_id")))
    size = unique.count()
    if size == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(sample / size, 1.0)
    cut = int((1 << 40) * share)
    drawn = unique.where(F.pmod(F.xxhash64("print", F.lit("sample")), F.lit(1 << 40)) < cut)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    longest = float(unique.agg(F.sqrt(F.max(squares))).first()[0])
    picked = drawn.select("c", "vector").toArrow()
    if picked.num_rows == 0:
        picked = unique.orderBy("c").limit(1).select("c", "vector").toArrow()
    picked = picked.sort_by("c").column("vector").combine_chunks()
    picked = _matrix(picked.chunk(0) if isinstance(picked, pa.ChunkedArray) else picked)
    lists = int(min(max(-(-size // per_list), 1), MOST_LISTS))
    centroids = Centroids(balanced_centroids(_lifted(picked, longest, False), lists))

    stored = unique.select("c", "first_id", "vector", _lists_of(F.col("vector"), centroids, longest, False).alias("lists"))
    postings = staging.stage(stored.select("c", "first_id", "vector", F.explode("lists").alias("list")))
    # One row per list reaches the driver, MOST_LISTS or so of them.
    heights = dict(postings.groupBy("list").count().collect())
    plan = _blocks(heights, len(centroids.points), block)

    def blocks() -> DataFrame:
        return F.broadcast(spark.createDataFrame(plan, "list int, block int, ways int"))

    dealt = postings.join(blocks(), "list").withColumn("part", F.pmod("c", F.col("ways")).cast("int")).drop("ways")
    asking = rows.where("asked").select("print", "vector").distinct()
    queries = unique.join(asking, ["print", "vector"])
    searched = queries.select(
        F.col("c").alias("q"), "vector", _lists_of(F.col("vector"), centroids, longest, True).alias("lists")
    )
    searched = staging.stage(searched)
    in_block = searched.select("q", F.explode("lists").alias("list")).join(blocks(), "list")
    in_block = in_block.groupBy("q", "block").agg(F.collect_list("list").alias("lists"), F.max("ways").alias("ways"))
    parts = F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("part")
    asked_of = in_block.join(searched.select("q", "vector"), "q").select("q", "vector", "lists", "block", parts)
    keys = ["block", "part"]
    found = (
        asked_of.groupBy(*keys)
        .cogroup(dealt.groupBy(*keys))
        .applyInPandas(lambda a, b: _search_block(a, b, top), "q long, c long, first_id long, score double")
    )
    best = staging.stage(found.distinct())
    return _ranked(rows, unique, best, top)


def _ranked(rows: DataFrame, unique: DataFrame, best: DataFrame, top: int) -> DataFrame:
    """Vectors found, as ids: the smallest ids of each, without the query's own."""
    # A limit by rank cuts each task's rows before they are shuffled, also those of one hot vector.
    numbered = rows.join(unique.select("print", "vector", "c"), ["print", "vector"]).select("c", "vec_id", "asked")
    numbered = staging.stage(numbered)
    by_id = F.row_number().over(Window.partitionBy("c").orderBy("vec_id"))
    lowest = numbered.select("c", "vec_id").distinct().withColumn("place", by_id)
    lowest = lowest.where(F.col("place") <= top + 1).drop("place")
    # Only the best top + 1 vectors of a query can matter: each holds an id, one of them its own.
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "first_id")
    kept = best.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= top + 1)
    ids = kept.join(lowest, "c").select("q", "vec_id", "score")
    of_query = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("place", F.row_number().over(of_query)).where(F.col("place") <= top + 1)
    asking = numbered.where("asked").select(F.col("vec_id").alias("query_id"), F.col("c").alias("q")).distinct()
    met = asking.join(ids.drop("place"), "q").where("vec_id <> query_id")
    of_id = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(of_id)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
