"""Audit of filters that run one after the other, from the ids that fail each of them.

Every filter has one stored table of the rows that fail it, in buckets by row id. A row that fails a
filter is removed by it after a prefix of other filters if none of them fails it too: left-anti joins
with their tables, for all prefixes of a filter at once. A left-semi join with the table of wanted (or
unwanted) rows leaves the losses. What an order of filters keeps, and what is redundant in it, follows
from these counts, as the rows that a set of filters removes do not depend on their order.

The joins read ids that fail something, bucket by bucket; texts are read once, when the tables are made.

Defined cases: a NULL text is empty; a NULL part is the empty string; rows that share a doc_id, and rows
without one, count each for itself; such rows are no copies of each other by the filter E, which needs a
smaller doc_id; a doc_id with several labels has all of them; an empty table gives no rows. Only the
named columns are read, so names of others do not matter.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm.buckets import bucketed

MOST_FILTERS = 6  # the report has a row for each step of every order
_WORD_BREAKS = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """When a text fails: too few words, too few different ones, too many capitals, a symbol of markup."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, _WORD_BREAKS), "")
    different = F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * different < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def copies(rows: DataFrame, same: str, order: str) -> DataFrame:
    """The rows that have an equal value of `same` as a row with a smaller `order`.

    Adaptive execution splits the join where one value holds a large share of the rows.
    """
    firsts = rows.groupBy(same).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    firsts = firsts.where("_first < _last").select(F.col(same).alias("_same"), "_first")
    return rows.join(firsts, (F.col(same) == F.col("_same")) & (F.col(order) > F.col("_first")), "left_semi")


def _removals(failing: Mapping[str, DataFrame], losses: Mapping[str, DataFrame]) -> DataFrame:
    """part, filter, prefix, n and the losses; `prefix` is a sum of the bits of other filters.

    A prefix without removals has no row.
    """
    names = list(failing)
    stored = {name: bucketed(failing[name].select("row", "part"), "row") for name in names}
    wanted = {name: bucketed(frame.select("row").distinct(), "row") for name, frame in losses.items()}
    counts = []
    for number, name in enumerate(names):
        for loss in ("n", *losses):
            alive = stored[name].withColumn("prefix", F.lit(0))
            if loss != "n":
                alive = alive.join(wanted[loss], "row", "left_semi")
            for bit, other in ((1 << i, o) for i, o in enumerate(names) if o != name):
                # Every prefix with and without the other filter; with it, only rows that it passes.
                both = F.array(F.col("prefix"), F.col("prefix").bitwiseOR(F.lit(bit)))
                earlier = stored[other].select(F.col("row").alias("_row"))
                gone = (F.col("row") == F.col("_row")) & (F.col("prefix").bitwiseAND(F.lit(bit)) != 0)
                alive = alive.withColumn("prefix", F.explode(both)).join(earlier, gone, "left_anti")
            counted = alive.groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("held"))
            counts.append(counted.select("part", F.lit(number).alias("filter"), "prefix", F.lit(loss).alias("of"), "held"))
    every = staging.stage(reduce(DataFrame.unionByName, counts))
    held = [F.sum(F.when(F.col("of") == c, F.col("held")).otherwise(0)).alias(c) for c in ("n", *losses)]
    return every.groupBy("part", "filter", "prefix").agg(*held)


def _steps(spark, names: list[str]) -> DataFrame:
    """One row per step of every order: the cells of the report that its numbers come from."""
    size = len(names)
    cell = {(f, prefix): f * (1 << size) + prefix for f in range(size) for prefix in range(1 << size)}
    every = (1 << size) - 1
    rows = []
    for order in permutations(range(size)):
        prefix, passed = 0, []
        for step, f in enumerate(order, 1):
            passed.append(cell[f, prefix])
            rest = [p for p in range(1 << size) if not p >> f & 1]
            turns = [factorial(p.bit_count()) * factorial(size - 1 - p.bit_count()) for p in rest]
            letters = "".join(names[i] for i in order)
            own, alone = cell[f, 0], cell[f, every & ~(1 << f)]
            rows.append((len(rows), letters, step, cell[f, prefix], list(passed), own, alone, [cell[f, p] for p in rest], turns))
            prefix |= 1 << f
    kind = """k int, filter_order string, step int, here int, passed array<int>, own int, alone int,
              cells array<int>, turns array<long>"""
    return spark.createDataFrame(rows, kind)


def audit(rows: DataFrame, failing: Mapping[str, DataFrame], losses: Mapping[str, DataFrame]) -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, one column per loss, and shapley (what the filter removes, summed over all orders).

    `rows` has a unique number `row`, and `part`; `failing` has, for each filter (named by a letter), the
    rows and parts that fail it; `losses` the rows to be counted among the removed ones.
    """
    names = list(failing)
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"an audit takes 1 to {MOST_FILTERS} filters")
    counts = _removals(failing, losses)
    cell = F.struct(
        (F.col("filter") * (1 << len(names)) + F.col("prefix")).cast("int").alias("key"),
        F.struct("n", *losses).alias("value"),
    )
    # At most filters x prefixes cells a part.
    cells = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("total")).join(cells.toDF("part", "held"), "part", "left")
    steps = _steps(rows.sparkSession, names)
    each = F.explode(F.sequence(F.lit(0), F.lit(factorial(len(names)) * len(names) - 1))).alias("k")
    # The steps are bounded by MOST_FILTERS.
    report = parts.select("*", each).join(F.broadcast(steps), "k")

    def at(key: Column, field: str = "n") -> Column:
        return F.coalesce(F.element_at("held", key)[field], F.lit(0)).cast("long")

    nothing = F.lit(0).cast("long")
    gone = F.aggregate("passed", nothing, lambda total, key: total + at(key))
    shares = F.zip_with("cells", "turns", lambda key, times: at(key) * times)
    return report.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - gone).alias("kept"),
        at(F.col("here")).alias("removed"),
        (at(F.col("own")) - at(F.col("here"))).alias("redundant"),
        at(F.col("alone")).alias("unique_fails"),
        *[at(F.col("here"), loss).alias(loss) for loss in losses],
        F.aggregate(shares, nothing, lambda total, share: total + share).alias("shapley"),
    )


def audit_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """The audit of `text_filters` and of E (a copy of a text with a smaller doc_id), with the losses
    good_lost (quality 1) and toxic_lost (toxic 1) by `labels` (doc_id, quality, toxic)."""
    flags = text_filters(F.col(text))
    rows = staging.stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            F.coalesce(F.col(part), F.lit("")).alias("part"),
            F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("same"),
            *[failed.alias(name) for name, failed in flags.items()],
        )
    )
    failing = {name: rows.where(name) for name in flags}
    failing["E"] = copies(rows.select("row", "part", "doc_id", "same"), "same", "doc_id")
    marks = {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"}
    losses = {name: rows.join(labels.where(mark).select("doc_id"), "doc_id", "left_semi") for name, mark in marks.items()}
    return audit(rows, failing, losses)
