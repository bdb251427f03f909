"""Mixing sources to target weights: documents whose lengths add up to each source's budget.

Every document of a source is taken a whole number of times first. What remains of the budget is a
subset-sum over counts of exact lengths: each length gives the same share of its documents, the
longest that still fit follow, and bounded-knapsack dynamic programming settles the last words. Where
texts longer than its table leave a gap, their sums over the whole budget are tried too. The documents of a length are then picked by a seeded hash, as many as its count says.

What a task holds: the counts of one source by length (one row per distinct length), and a table of
about `max_table` sums (twice that for long texts). Picking ranks only the documents of one hash bucket of one length.

Defined cases: a NULL text has length 0; a NULL source is a source of its own, the last in order;
documents of length 0 are taken 0 words; repeated rows count, and are picked, one by one; without
any words all targets are 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import texts as tx

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 17
MAX_TABLE = 1 << 16  # budget that dynamic programming settles, in words
_BUCKETS = 4096


def _lengths(column: pa.Array) -> pa.Array:
    parts = [np.diff(tx.words(t).first) for _, t in tx.slices(tx.flat(column))]
    return pa.array(np.concatenate(parts) if parts else [], pa.int64())


def length(text: Column | str) -> Column:
    """The number of words of a text."""
    return F.arrow_udf(_lengths, "long").asNondeterministic()(text)


def capped_targets(sizes: Sequence[float], weights: Sequence[float], total: float, most: float) -> list[float]:
    """`total` shared by weight; what lies above `most` times a size goes to the others by weight."""
    targets = [0.0] * len(sizes)
    open_ = [i for i, size in enumerate(sizes) if size > 0]
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int, max_table: int = MAX_TABLE) -> np.ndarray:
    """How many items of each length to take so that their lengths add up to about `budget`."""
    whole = int((lengths * counts).sum())
    if budget <= 0 or whole == 0:
        return np.zeros(len(lengths), np.int64)
    if budget >= whole:
        return counts.astype(np.int64)
    take = np.minimum((counts * (budget / whole)).astype(np.int64), counts)
    left = budget - int((lengths * take).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order[lengths[order] > 0]:
        if left <= max_table:
            break
        more = min(int(counts[i] - take[i]), (left - max_table) // int(lengths[i]) + 1)
        more = max(min(more, left // int(lengths[i])), 0)
        take[i] += more
        left -= more * int(lengths[i])
    if 0 < left <= max_table:
        take += _knapsack(lengths, counts - take, left)
    if (lengths[take > 0] > max_table).any() or left > max_table:
        if int((lengths * take).sum()) < budget:
            other = _fill_around_long(lengths, counts, budget, max_table)
            take = max(take, other, key=lambda t: int((lengths * t).sum()))
    return take


def _fill_around_long(lengths: np.ndarray, counts: np.ndarray, budget: int, max_table: int) -> np.ndarray:
    """Like `fill`: texts beyond `max_table` chosen over the whole budget, the others for what they leave."""
    long = lengths > max_table
    some, few = np.where(long, counts, 0), np.where(long, 0, counts)
    lots, sums, made = _sparse_sums(lengths, some, budget, max_table)
    total = int((lengths * few).sum())
    if total <= max_table:
        short_lots, short = _dense_sums(lengths, few, total)
        highest = np.maximum.accumulate(np.where(short >= 0, np.arange(total + 1), 0))
        at = int(sums[np.argmax(sums + highest[np.minimum(budget - sums, total)])])
        rest = _walked_back(lengths, short_lots, lambda s: short[s], int(highest[min(budget - at, total)]))
    else:
        # Of the sums that the short texts can make up for, one whose remainder they divide, near the even share.
        even = budget * (int((lengths * some).sum()) / int((lengths * counts).sum()))
        missing = np.maximum(budget - sums - total, 0)
        odd = (budget - sums) % int(np.gcd.reduce(lengths[few > 0]))
        at = int(sums[np.lexsort((np.abs(sums - even), odd, missing))[0]])
        rest = fill(lengths, few, budget - at, max_table)
    return rest + _walked_back(lengths, lots, lambda s: made[np.searchsorted(sums, s)], at)


def _lots(lengths: np.ndarray, counts: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """(place, size): each length's count split into powers of two."""
    lots: list[tuple[int, int]] = []
    for i in np.flatnonzero((lengths > 0) & (lengths <= budget) & (counts > 0)):
        rest, size = int(min(counts[i], budget // lengths[i])), 1
        while rest > 0:
            lots.append((int(i), min(size, rest)))
            rest -= size
            size *= 2
    return lots


def _sparse_sums(
    lengths: np.ndarray, counts: np.ndarray, budget: int, max_table: int
) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Lots, the sums up to `budget` that they reach in order, and the first lot that reached each.

    All sums as long as there are `max_table` at most; later ones where no sum is near, that is in
    the same of `max_table` even parts of the budget.
    """
    lots = _lots(lengths, counts, budget)
    sums, made = np.zeros(1, np.int64), np.full(1, len(lots), np.int64)
    width = budget // max_table + 1
    for number, (i, size) in enumerate(lots):
        fresh = sums + int(lengths[i]) * size
        fresh = np.setdiff1d(fresh[fresh <= budget], sums, assume_unique=True)
        if len(sums) + len(fresh) > max_table:
            part = fresh // width
            first = np.append(True, part[1:] != part[:-1])[: len(part)]
            fresh = fresh[(first & ~np.isin(part, sums // width)) | (fresh == budget)]
        sums, made = np.append(sums, fresh), np.append(made, np.full(len(fresh), number))
        order = np.argsort(sums, kind="stable")
        sums, made = sums[order], made[order]
        if sums[-1] == budget:
            break
    return lots, sums, made


def _dense_sums(lengths: np.ndarray, counts: np.ndarray, budget: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Lots, and for each sum up to `budget` the first lot whose addition reached it, or -1."""
    lots = _lots(lengths, counts, budget)
    made = np.full(budget + 1, -1, np.int64)
    made[0] = len(lots)
    for number, (i, size) in enumerate(lots):
        step = int(lengths[i]) * size
        if step > budget:
            continue
        fresh = np.flatnonzero((made[:-step] >= 0) & (made[step:] < 0)) + step
        made[fresh] = number
        if made[budget] >= 0:
            break
    return lots, made


def _walked_back(lengths: np.ndarray, lots: list[tuple[int, int]], made: Callable[[int], int], at: int) -> np.ndarray:
    """The counts of the lots that add up to `at`."""
    take = np.zeros(len(lengths), np.int64)
    while at > 0:
        i, size = lots[int(made(at))]
        take[i] += size
        at -= int(lengths[i]) * size
    return take


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts of the items whose lengths add up nearest to `budget` without exceeding it."""
    lots, made = _dense_sums(lengths, counts, budget)
    return _walked_back(lengths, lots, lambda s: made[s], int(np.flatnonzero(made >= 0)[-1]))


def _source_order(weights: Sequence[float]) -> Column:
    place = F.col("place") % len(weights)
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))


def source_targets(
    sizes: DataFrame, source: str, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Per source (column `source`): its size and its target. One row per source is ordered."""
    ordered = (
        sizes.groupBy(source)
        .agg(F.sum("size").cast("long").alias("source_size"))
        .orderBy(F.col(source).isNull(), F.col(source).cast("binary"))
    )
    rows = ordered.toPandas()
    total = share * float(rows["source_size"].sum())
    weight = [float(weights[i % len(weights)]) for i in range(len(rows))]
    rows["target"] = capped_targets([float(x) for x in rows["source_size"]], weight, total, most)
    schema = f"{source} string, source_size long, target double"
    names = [None if pd.isna(x) else x for x in rows[source]]
    data = list(zip(names, rows["source_size"].astype(int), rows["target"].astype(float)))
    return sizes.sparkSession.createDataFrame([tuple(map(_plain, r)) for r in data], schema)


def _plain(value):
    return value.item() if hasattr(value, "item") else value


def _counts_to_take(group: pd.DataFrame, most: int, max_table: int) -> pd.DataFrame:
    group = group.sort_values("size")
    lengths, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    whole, target = int((lengths * counts).sum()), float(group["target"].iloc[0])
    times = min(int(target // whole), most) if whole else 0
    budget = int(round(target - times * whole)) if times < most else 0
    return group.assign(times=times, picks=fill(lengths, counts, budget, max_table))


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = int(MOST),
    seed: int = SEED,
    max_table: int = MAX_TABLE,
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken.

    `taken` is the words that the mix takes of the document, repeats counted: a multiple of its
    size, at most `most` times.
    """
    spark = docs.sparkSession
    sizes = staging.stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            length(text).alias("size"),
            F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("draw"),
        ),
        batch=staging.TEXTS,
    )
    targets = source_targets(sizes, "source", weights, share, most)
    by_length = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    schema = (
        "source string, size long, n long, source_size long, target double, times long, picks long"
    )
    counted = by_length.join(
        targets.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))
    ).drop("named")
    plan = staging.stage(
        counted.groupBy("source").applyInPandas(
            lambda g: _counts_to_take(g, most, max_table)[
                ["source", "size", "n", "source_size", "target", "times", "picks"]
            ],
            schema,
        )
    )
    # Hash buckets of each length in order; whole buckets first, and ranks within the one cut.
    bucketed = sizes.withColumn("bucket", F.pmod("draw", F.lit(_BUCKETS)))
    key = ["source", "size", "bucket"]
    before = Window.partitionBy("source", "size").orderBy("bucket")
    buckets = (
        bucketed.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("held"))
        .withColumn("upto", F.sum("held").over(before))
    )
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("source", "size")]
    cuts = staging.stage(
        buckets.alias("b")
        .join(plan.alias("p"), same[0] & same[1])
        .select(
            *[F.col(f"b.{c}").alias(f"cut_{c}") for c in key],
            "source_size",
            "target",
            "times",
            F.greatest(
                F.lit(0), F.least(F.col("held"), F.col("picks") - F.col("upto") + F.col("held"))
            ).alias("picks"),
            "held",
        )
    )
    met = F.lit(True)
    for c in key:
        met = met & F.col(c).eqNullSafe(F.col(f"cut_{c}"))
    dealt = bucketed.join(cuts, met)
    partial = (F.col("picks") > 0) & (F.col("picks") < F.col("held"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("draw", "doc_id"))
    picked = dealt.where(partial).withColumn("extra", (rank <= F.col("picks")).cast("long"))
    sure = dealt.where(~partial).withColumn("extra", (F.col("picks") > 0).cast("long"))
    return picked.unionByName(sure).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("times") + F.col("extra"))).alias("taken"),
    )
