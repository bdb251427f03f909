"""Near duplicates by MinHash: bottom-k sketches from one hash function, and exact Jaccard.

Each distinct set of word shingles keeps its k lowest hashes. Inverted lists over runs of consecutive
kept hashes name the sets that overlap; a run, rather than a single hash, keeps a passage that many
documents share from putting them all on one list. Candidate pairs pass an estimate from the sketch of
their union, and then a comparison of the full sets.

Two sets of at most `SMALL` shingles over the threshold always share a run (pigeonhole). Of larger
ones at Jaccard 0.8 a pair escapes all lists with a chance below one in a million.

No list is expanded into all its pairs unless it is short. A list is first compared with its lead, the
smallest member; what is linked then counts as one component, and only lists that still hold several
are gone through again: short ones in full, long ones by what their members differ in from a common centre.
Equal sets are one set throughout.

Defined cases: a text without words (or NULL) has an empty set and is linked with nothing; a text with
fewer words than a shingle has its whole sequence as one shingle; rows that share a doc_id count as one
document with several texts; rows without a doc_id are linked with nothing, are their own component
(NULL) and are kept; repeated rows give repeated results. Names of other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake import staging
from sensorlake.llm import texts as tx
from sensorlake.llm.components import components

KEPT = 96  # lowest hashes kept of a set
RUN = 5
SMALL = 48  # sets up to this size are also listed by shorter runs
SHORT_RUN = 3
TINY = 8
TINY_RUN = 2
SHORT_LIST = 32  # lists up to this length are compared in full
SLACK = 0.2  # by how much the estimate may fall below the threshold
COUNTERS = 1 << 18  # at most, for the elements of one group of long lists


def _sets(t: tx.Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, text by text: values, first index, count of each text."""
    t = t.lower()
    w = tx.words(t)
    text = w.text_of()
    hashes = tx.span_hashes(t.data, w.starts, w.ends)
    at = tx.window_starts(w.first, size)
    values = [tx.window_hashes(hashes, size)[at]] if len(at) else [np.zeros(0, np.uint64)]
    owner = [text[at]]
    counts = np.diff(w.first)
    for short in range(1, size):
        which = np.flatnonzero(counts == short)
        if len(which):
            values.append(tx.mix(tx.window_hashes(hashes, short)[w.first[which]] ^ np.uint64(short)))
            owner.append(which)
    value, owner = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    count = np.bincount(owner, minlength=len(t))
    return value, np.cumsum(count) - count, count


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def sketch(text: Column | str, size: int, kept: int = KEPT) -> Column:
    """Of a text: n_shingles, two fingerprints of its set, and its `kept` lowest hashes in order."""

    def run(column: pa.Array) -> pa.Array:
        n, one, two, low, low_n = [], [], [], [], []
        for _, t in tx.slices(tx.flat(column)):
            value, first, count = _sets(t, size)
            total = np.concatenate((np.zeros((2, 1), np.uint64), np.cumsum(
                [tx.mix(value ^ np.uint64(0x5851F42D4C957F2D)), tx.mix(value + np.uint64(0x14057B7EF767814F))],
                axis=1, dtype=np.uint64)), axis=1)
            prints = total[:, first + count] - total[:, first]
            few = np.minimum(count, kept)
            n.append(count)
            one.append(_signed(prints[0]))
            two.append(_signed(prints[1]))
            low.append(_signed(value[tx.ragged(first, few)]))
            low_n.append(few)

        def whole(parts):
            return np.concatenate(parts) if parts else np.zeros(0, np.int64)

        return pa.StructArray.from_arrays(
            [
                pa.array(whole(n), pa.int64()),
                pa.array(whole(one), pa.int64()),
                pa.array(whole(two), pa.int64()),
                tx.lists(whole(low), whole(low_n), pa.int64()),
            ],
            ["n", "print_1", "print_2", "low"],
        )

    kind = "n long, print_1 long, print_2 long, low array<long>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)


def shingles(text: Column | str, size: int) -> Column:
    """The full set of a text: the hashes of its distinct shingles."""

    def run(column: pa.Array) -> pa.Array:
        values, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, t in tx.slices(tx.flat(column)):
            value, _, count = _sets(t, size)
            values.append(_signed(value))
            counts.append(count)
        return tx.lists(np.concatenate(values), np.concatenate(counts), pa.int64())

    return F.arrow_udf(run, "array<long>").asNondeterministic()(text)


def _keys(low: Column, n: Column) -> Column:
    """The lists that a set stands on: hashes of its runs of consecutive kept values."""

    def runs(length: int) -> Column:
        places = F.sequence(F.lit(1), F.size(low) - (length - 1))
        each = F.transform(places, lambda i: F.xxhash64(F.lit(length), F.slice(low, i, length)))
        return F.when(F.size(low) >= length, each).otherwise(F.array().cast("array<long>"))

    nothing = F.array().cast("array<long>")
    return F.concat(
        runs(RUN),
        F.when(n <= SMALL, runs(SHORT_RUN)).otherwise(nothing),
        F.when(n <= TINY, runs(TINY_RUN)).otherwise(nothing),
    )


def _near_in_size(n: str, m: str, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _linked(pairs: DataFrame, sets: DataFrame, full: DataFrame, percent: int, kept: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets reach the threshold."""
    side = sets.select("node", "n", "low")
    both = pairs.join(side.toDF("a", "n_a", "low_a"), "a").join(side.toDF("b", "n_b", "low_b"), "b")
    union = F.slice(F.array_sort(F.array_union("low_a", "low_b")), 1, kept)
    in_both = F.array_intersect(F.array_intersect(F.col("low_a"), F.col("low_b")), union)
    estimate = F.size(in_both) / F.size(union)
    whole = F.greatest("n_a", "n_b") <= kept  # the sketches are the sets
    common = F.size(F.array_intersect("low_a", "low_b"))
    reached = 100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)
    judged = staging.stage(
        both.select(
            "a",
            "b",
            "n_a",
            "n_b",
            F.when(whole, reached).otherwise(estimate >= percent / 100 - SLACK).alias("likely"),
            whole.alias("whole"),
        ).where("likely")
    )
    sure = judged.where("whole").select("a", "b")
    open_ = judged.where("NOT whole")
    sets_of = (
        open_.join(full.toDF("a", "n_a", "all_a"), ["a", "n_a"])
        .join(full.toDF("b", "n_b", "all_b"), ["b", "n_b"])
    )
    shared = F.size(F.array_intersect("all_a", "all_b"))
    met = 100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)
    return sure.unionByName(sets_of.where(met).select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    kept: int = KEPT,
    short_list: int = SHORT_LIST,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Documents are linked when `percent` of the union of their shingle sets is common to both.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    drawn = plain.select("doc_id", sketch("text", size, kept).alias("s")).select("doc_id", "s.*")
    drawn = staging.stage(drawn, batch=staging.TEXTS)
    prints = ["print_1", "print_2", "n"]
    sets = staging.stage(
        drawn.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy(*prints)
        .agg(F.min("doc_id").alias("node"), F.first("low").alias("low"))
    )
    listed = sets.select("node", "n", F.explode(_keys(F.col("low"), F.col("n"))).alias("key"))
    lists = listed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("node").alias("lead"))
    members = staging.stage(listed.join(lists.where("m > 1"), "key"))

    # Full sets, once, of the texts that stand on a list and are not whole in their sketch.
    wanted = members.where(F.col("n") > kept).select(F.col("node").alias("doc_id")).distinct()
    full = staging.stage(
        plain.join(wanted, "doc_id")
        .select("doc_id", shingles("text", size).alias("values"))
        .select(F.col("doc_id").alias("node"), F.size("values").cast("long").alias("n"), "values"),
        batch=staging.TEXTS,
    )
    in_sketch = sets.where(F.col("n") <= kept).select("node", "n", F.col("low").alias("values"))
    full = in_sketch.unionByName(full)

    # A set larger than the lead's is met from the side of the lead: sizes are compared at the set.
    sizes = sets.groupBy("node").agg(F.max("n").alias("n_lead"))
    pairs = members.where("node > lead").select(F.col("lead").alias("a"), F.col("node").alias("b"), "n")
    pairs = pairs.distinct().join(sizes.withColumnRenamed("node", "a"), "a")
    pairs = pairs.where(_near_in_size("n", "n_lead", percent)).select("a", "b").distinct()
    edges = staging.stage(_linked(pairs, sets, full, percent, kept))
    labels = components(edges)

    rest = _unsettled(members.where("node > lead").select("key", "node", "n"), labels)
    pairs = _on_short_lists(rest.where(F.col("m") <= short_list), percent)
    far = _by_difference(rest.where(F.col("m") > short_list), full, percent)
    more = _linked(pairs.unionByName(far).distinct(), sets, full, percent, kept)
    labels = components(edges.unionByName(more))

    of_set = sets.join(labels, "node", "left").select(
        *prints, F.coalesce("label", "node").alias("component")
    )
    # Texts of one doc_id may belong to several sets; then the smallest component counts.
    met = [F.col(f"d.{c}") == F.col(f"s.{c}") for c in prints]
    found = drawn.drop("low").alias("d").join(of_set.alias("s"), met, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id",
        F.col("d.n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def _unsettled(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of lists that still hold several components."""
    known = rest.join(labels, "node", "left")
    known = staging.stage(known.withColumn("component", F.coalesce("label", "node")).drop("label"))
    several = (
        known.groupBy("key")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("m"))
        .where("least < most")
    )
    return staging.stage(known.join(several.select("key", "m"), "key"))


def _on_short_lists(short: DataFrame, percent: int) -> DataFrame:
    """All pairs of one list that lie in different components and are near in size."""
    left = short.select("key", "node", "n", "component")
    right = left.toDF("key", "node_2", "n_2", "component_2")
    apart = (F.col("component") != F.col("component_2")) & _near_in_size("n", "n_2", percent)
    pairs = left.join(right, "key").where((F.col("node") < F.col("node_2")) & apart)
    return pairs.select(F.col("node").alias("a"), F.col("node_2").alias("b"))


def _counters(each: DataFrame) -> DataFrame:
    """Per lead: `levels`, how many differences `d` hold the elements of a bucket, on a logarithmic scale.

    An element's bucket is its lowest bits; there are as many buckets, a power of two, as keep them sparse, COUNTERS
    at most. Level 0 means one difference. Elements are counted within their tasks: what is shuffled is a row of counts for
    each batch and lead, and these are summed as they come.
    """
    lead = each.schema["lead"].dataType
    ints = T.ArrayType(T.IntegerType())
    counts = T.StructType([T.StructField("lead", lead), T.StructField("bucket", ints), T.StructField("held", ints)])
    levels = T.StructType([T.StructField("lead", lead), T.StructField("levels", T.ArrayType(T.ByteType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = batch.column("lead").dictionary_encode()
            d = batch.column("d")
            group = np.repeat(lead.indices.to_numpy().astype(np.int64), d.value_lengths().to_numpy())
            bucket = d.flatten().to_numpy() & (COUNTERS - 1)
            found, held = np.unique(group * COUNTERS + bucket, return_counts=True)
            n = np.bincount(found // COUNTERS, minlength=len(lead.dictionary))
            columns = [lead.dictionary, tx.lists(found % COUNTERS, n, pa.int32()), tx.lists(held, n, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["lead", "bucket", "held"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("bucket").flatten().to_numpy(), batch.column("held").flatten().to_numpy())
        size = min(COUNTERS, 1 << (4 * int(total.sum())).bit_length())
        level = (4 * np.log2(np.maximum(total.reshape(-1, size).sum(axis=0), 1))).astype(np.int8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], batch.schema.field("lead").type), tx.lists(level, np.array([size]), pa.int8())],
            ["lead", "levels"],
        )

    counted = each.select("lead", "d").where(F.size("d") > 0).mapInArrow(count, counts)
    return counted.groupBy("lead").applyInArrow(add, levels)


def _rare_elements(each: DataFrame, reach: Column) -> DataFrame:
    """The rarest elements of each difference, all but `reach - 1`, that another member may hold as well.

    Their `place` counts all elements of the difference. An element alone in its bucket is held by no other
    member and gets no row.
    """
    levels = staging.stage(_counters(each), batch=staging.TEXTS)
    # Levels are mostly zeros and small on disk, not in memory: they are merged at any size, never broadcast.
    with_levels = each.withColumn("reach", reach).join(levels.hint("merge"), "lead")
    bucket = lambda item: item.bitwiseAND(F.size("levels").cast("long") - 1).cast("int")
    by_level = F.sort_array(F.transform("d", lambda item: F.struct(F.get("levels", bucket(item)).alias("level"), item.alias("item"))))
    first = F.slice(by_level, F.lit(1), (F.col("a") - F.col("reach") + 1).cast("int"))
    placed = F.transform(first, lambda e, at: F.struct(e["item"].alias("item"), (at + 1).alias("place"), e["level"].alias("level")))
    kept = ["lead", "node", "n", "component", "apart", "a"]
    listed = with_levels.select(*kept, F.filter(placed, lambda e: e["level"] > 0).alias("elements"))
    return listed.select(*kept, F.explode("elements").alias("e")).select(*kept, "e.item", "e.place")


def _by_difference(long: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Candidates among the members of long lists: pairs that differ from a common set in the same way.

    Lists are put together by the component that most of their members belong to; its smallest document
    is the centre. With L the centre's set and a = |X ^ L|, b = |Y ^ L| (^ for symmetric difference, p percent),
    |X ^ Y| = a + b - 2c, where c counts what both differences hold; X and Y reach the threshold when
    |X ^ Y| <= r (|X| + |Y|) with r = (100 - p) / (100 + p). One of a pair in different components, X
    say, does not reach it with the centre, hence c > b (1 - r) / 2, and as c <= b,
    c >= a - r (|X| + |Y|). So the rarest elements of both differences, all but c - 1 of each, have one
    in common. Edits that only one copy has come first there, which keeps a large group of copies from
    meeting pairwise. Rarity is that of an element's bucket in `_counters`: any order that the members of a group
    share is exact, and rare elements alone become rows.
    """
    r = (100 - percent) / (100 + percent)
    held = long.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    most = held.groupBy("key").agg(F.min_by("component", F.struct(-F.col("held"), F.col("component"))).alias("lead"))
    group = long.drop("lead").join(most, "key").select("lead", "node", "n", "component").distinct()
    leads = full.groupBy(F.col("node").alias("lead")).agg(F.min("values").alias("core"))
    both = group.join(full, ["node", "n"]).join(leads, "lead")
    differing = F.concat(F.array_except("values", "core"), F.array_except("core", "values"))
    each = both.select("lead", "node", "n", "component", F.size("core").alias("p"), differing.alias("d"))
    each = each.withColumn("a", F.size("d")).withColumn("apart", F.col("a") > r * (F.col("n") + F.col("p")) + 1e-6)
    each = staging.stage(each)
    near = each.where("NOT apart AND component <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    least_x = F.greatest(F.lit(1), F.ceil(F.col("a") - r * F.col("n") * (1 + 100 / percent) - 1e-6))
    least_y = F.greatest(F.lit(1), F.ceil(F.col("a") * (1 - r) / 2 - 1e-6))
    reach = F.when(F.col("apart"), F.least(least_x, least_y)).otherwise(least_y)
    ranked = staging.stage(
        _rare_elements(each, reach)
        .withColumn("as_x", F.col("apart") & (F.col("place") <= F.col("a") - least_x + 1))
        .withColumn("as_y", F.col("place") <= F.col("a") - least_y + 1)
    )
    x = ranked.where("as_x").drop("as_x", "as_y", "apart")
    y = ranked.where("as_y").select(
        "lead", "item", *[F.col(c).alias(f"{c}_2") for c in ("node", "n", "component", "a", "place")]
    )
    most = 1 + F.least(F.col("a") - F.col("place"), F.col("a_2") - F.col("place_2"))
    enough = 2 * most >= F.col("a") + F.col("a_2") - r * (F.col("n") + F.col("n_2")) - 1e-6
    met = (F.col("component") != F.col("component_2")) & _near_in_size("n", "n_2", percent) & enough
    pairs = x.join(y, ["lead", "item"]).where(met)
    far = pairs.select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))
    return near.unionByName(far)
