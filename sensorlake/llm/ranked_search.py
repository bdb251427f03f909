"""The best documents for every item of a stated query set, over classes of equal bags.

Documents are restricted to the terms of the items. Those with the same counts of these terms and the
same length measure have the same score for every item: they are one class, found by the hash of both and
told apart by the vectors themselves. Each class is scored once, in blocks of classes against all items,
and the members of the best classes follow in order of doc_id.

No more than `top` members of a class can be among the best `top`, so a class keeps its first `top` by
doc_id: those are found in each partition before any row is moved, and a text that a third of the table
repeats is a few rows in its task. A task keeps the best `top` documents of each item.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), the length measure m of a document
100 - slope + (slope n N) div L, and the score the sum over the item's terms of
w ((10^9 tf) div (1000 tf + saturation m)). Sums are exact while they stay below 2^53.

Defined cases: terms are letters and digits of ASCII and all characters beyond it, only A-Z lower-cased;
a NULL or empty text has none, counts in no statistic and is never found; items that share an item_id are
one item with the terms of all; an item without terms finds nothing; rows without a doc_id count in the
statistics and are not found; rows that share a doc_id are found each for itself; equal scores go by
ascending doc_id; empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import texts as tx

ITEM_BYTES = 8 << 20  # text of the items that one block of them may hold
ITEMS = 4096
WORK = 1 << 22  # sums and shares of a score that are held at once
_SCALE = 1_000_000_000

_inside = np.zeros(256, bool)
_inside[0x30:0x3A] = _inside[0x41:0x5B] = _inside[0x61:0x7B] = _inside[0x80:] = True


def _terms(t: tx.Texts) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, lower-cased, and the text of each."""
    inside = _inside[t.data]
    if not inside.any():
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = t.offsets[1:-1]
    cuts = cuts[cuts < len(inside)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    # The bytes of all terms one after the other: a term ends where the next begins.
    before = np.cumsum(inside) - inside
    offsets = np.append(before[starts], inside.sum()).astype(np.int64)
    data = np.ascontiguousarray(t.lower().data[inside])
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )
    return column, np.searchsorted(t.offsets, starts, "right") - 1


def _bags(vocabulary: pa.Array, text: Column) -> Column:
    """Of a text: n (terms with repeats), and the counts of its terms in the vocabulary, by number."""

    def run(column: pa.Array) -> pa.Array:
        n, terms, counts, held = ([np.zeros(0, np.int64)] for _ in range(4))
        for _, t in tx.slices(tx.flat(column)):
            found, owner = _terms(t)
            n.append(np.bincount(owner, minlength=len(t)))
            number = pc.index_in(found, value_set=vocabulary)
            known = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
            number = number.fill_null(0).to_numpy()[known].astype(np.int64)
            key, times = np.unique(owner[known] * len(vocabulary) + number, return_counts=True)
            terms.append(key % len(vocabulary))
            counts.append(times)
            held.append(np.bincount(key // len(vocabulary), minlength=len(t)))
        held = np.concatenate(held)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(n), pa.int64()),
                tx.lists(np.concatenate(terms), held, pa.int32()),
                tx.lists(np.concatenate(counts), held, pa.int64()),
            ],
            ["n", "terms", "counts"],
        )

    return F.arrow_udf(run, "n long, terms array<int>, counts array<long>").asNondeterministic()(text)


class _Best:
    """The best documents of each item among those offered so far."""

    def __init__(self, items: int, top: int) -> None:
        self.items, self.top = items, top
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.zeros(items, np.int64)  # a lower score than this cannot be among the best

    def _first(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The places of the first `top` of each item, by falling score and rising doc."""
        order = np.lexsort((doc, -score, item))
        held = np.bincount(item, minlength=self.items)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(held) - held, held)
        return order[rank < self.top]

    def offer(self, scores: np.ndarray, members: np.ndarray, first: np.ndarray, held: np.ndarray) -> None:
        """`scores` of classes (rows) for items; class c has members[first[c]:first[c] + held[c]]."""
        cls, item = np.nonzero((scores > 0) & (scores >= self.least))
        score = scores[cls, item]
        chosen = self._first(item, score, members[first[cls]])
        cls, item, score = cls[chosen], item[chosen], score[chosen]
        each = held[cls]
        item = np.concatenate((self.item, np.repeat(item, each)))
        score = np.concatenate((self.score, np.repeat(score, each)))
        doc = np.concatenate((self.doc, members[tx.ragged(first[cls], each)]))
        chosen = self._first(item, score, doc)
        self.item, self.score, self.doc = item[chosen], score[chosen], doc[chosen]
        held = np.bincount(self.item, minlength=self.items)
        last = np.cumsum(held) - 1
        full = held == self.top
        self.least[full] = self.score[last[full]]


def _parts(batch: pa.RecordBatch, lengths: np.ndarray, items: int) -> Iterator[pa.RecordBatch]:
    """Classes of a batch, as many at a time as WORK allows, one at least."""
    terms = batch.column("terms")
    cls = np.repeat(np.arange(len(batch)), pc.list_value_length(terms).to_numpy())
    work = np.bincount(cls, lengths[terms.flatten().to_numpy()], minlength=len(batch)).astype(np.int64) + items
    work = np.concatenate((np.zeros(1, np.int64), np.cumsum(work)))
    at = 0
    while at < len(batch):
        end = max(at + 1, int(np.searchsorted(work, work[at] + WORK, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _scorer(weights: np.ndarray, lists: list[np.ndarray], items: int, top: int, saturation: int):
    """Scores classes (m, terms, counts, members) against all items: item, score, doc_id of the best."""
    lengths = np.array([len(x) for x in lists], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, top)
        for batch in batches:
            for part in _parts(batch, lengths, items):
                m = part.column("m").to_numpy()
                terms, counts, members = (part.column(c) for c in ("terms", "counts", "members"))
                cls = np.repeat(np.arange(len(part)), pc.list_value_length(terms).to_numpy())
                term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
                share = weights[term] * (_SCALE * tf // (1000 * tf + saturation * m[cls]))
                # Every term adds its share to the items that hold it.
                on = lengths[term]
                cell = np.repeat(cls * items, on) + flat[tx.ragged(starts[term], on)]
                scores = np.bincount(cell, np.repeat(share, on), minlength=len(part) * items)
                held = pc.list_value_length(members).to_numpy().astype(np.int64)
                scores = scores.astype(np.int64).reshape(len(part), items)
                best.offer(scores, members.flatten().to_numpy(), np.cumsum(held) - held, held)
        columns = [pa.array(c, pa.int64()) for c in (best.item, best.score, best.doc)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "doc_id"])

    return run


def _block(docs: DataFrame, held: list[tuple], top: int, slope: int, saturation: int) -> DataFrame | None:
    """item (its place in `held`), rank, doc_id, score of the best documents for some items (id, terms)."""
    vocabulary = pa.array(sorted({term for _, terms in held for term in terms}), pa.large_binary())
    counted = staging.stage(docs.select("doc_id", _bags(vocabulary, F.col("text")).alias("b")).select("doc_id", "b.*"))
    size, total = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not total:
        return None
    spread = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array(
        [math.floor(1000 * math.log((2 * size + 2) / (2 * spread.get(t, 0) + 1))) for t in range(len(vocabulary))],
        np.int64,
    )
    places = {term: number for number, term in enumerate(vocabulary.to_pylist())}
    lists: list[list[int]] = [[] for _ in places]
    for item, (_, terms) in enumerate(held):
        for term in terms:
            lists[places[term]].append(item)

    measure = F.expr(f"{100 - slope} + ({slope} * n * {size}L) div {total}L")
    bags = counted.where("doc_id IS NOT NULL AND size(terms) > 0").select("doc_id", measure.alias("m"), "terms", "counts")
    bag = ["hash", "m", "terms", "counts"]
    bags = bags.withColumn("hash", F.xxhash64("m", "terms", "counts"))
    order = F.row_number().over(Window.partitionBy(*bag).orderBy("doc_id"))
    first = bags.withColumn("place", order).where(F.col("place") <= top)
    classes = first.groupBy(*bag).agg(F.sort_array(F.collect_list("doc_id")).alias("members"))
    score = _scorer(weights, [np.array(x, np.int64) for x in lists], len(held), top, saturation)
    found = classes.select("m", "terms", "counts", "members").mapInArrow(score, "item long, score long, doc_id long")
    order = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    top: int = 50,
    slope: int = 50,
    saturation: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id, score of each item's `top` documents with a score above 0.

    Items are taken in blocks of about `item_bytes` of text, whose vocabulary every task holds; each block
    reads the documents once.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    number, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-number // ITEMS), -(-(size or 0) // item_bytes))
    spark, kind = docs.sparkSession, items.schema["item_id"].dataType.simpleString()
    found = []
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        terms: dict = {}
        for name, said in chosen.collect():  # bounded by item_bytes
            t = tx.flat(pa.array([said], pa.string()))
            terms.setdefault(name, set()).update(_terms(t)[0].to_pylist())
        held = [(name, own) for name, own in terms.items() if own]
        best = _block(docs, held, top, slope, saturation) if held else None
        if best is not None:
            names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(held)], f"item long, item_id {kind}")
            best = best.join(F.broadcast(names), "item")
            found.append(best.select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
