"""Substring dedup on bytes by suffix arrays.

Strings of `size` bytes that start earlier as well are removed; they are judged on the input. Equal
strings hold the same lowest-hashed `ANCHOR`-byte string, so runs of consecutive strings with one such
anchor are dealt to shards by anchor, and every shard can judge its strings by itself: it sorts the
suffixes of its runs (suffixes.py), and neighbours with a common prefix of `size` bytes are equal
strings. Anchors that occur once take no part; equal runs are sorted once, for their first place.

A common line or phrase makes an anchor frequent: its runs differ in what stands around it, and there are
more of them the larger the input. Runs of an anchor that would fill a good part of a shard are cut again, at
the lowest-hashed string nearly as long as `size`; what surrounds the phrase then tells most of them apart,
and the rest are runs like any others. An anchor that is frequent even so is dealt over several shards. Each
of these emits its distinct strings of that anchor with their first places; they are dealt by range, and the
sorted runs of the shards are merged, all at once.

Defined cases: a NULL text has no bytes; a text shorter than `size` bytes stays; rows without a doc_id
stay whole and are not compared; rows with equal doc_id and text have equal results, neither being
earlier; other columns do not matter. doc_id is an integer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import suffixes
from sensorlake.llm import texts as tx
from sensorlake.llm.buckets import bucketed
from sensorlake.llm.substring_dedup import _flat_spans, body_hashes, branching, paths_of

SIZE = 100
ANCHOR = 24
SHARD_BYTES = 1 << 20  # bytes of runs that a shard holds, about
SLICE_BYTES = 1 << 19  # bytes of texts handled at once


def _grams(eight: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` bytes (a multiple of 8) from each place, given the eight bytes from each."""
    if len(eight) < width:
        return np.zeros(0, np.uint64)
    count = len(eight) - width + 1
    value = np.zeros(count, np.uint64)
    for step in range(0, width, 8):
        value = tx.mix(value + eight[step : step + count])
    return value


def _runs_of(t: tx.Texts, size: int, width: int) -> tuple[np.ndarray, ...]:
    """The runs of some texts, with anchors of `width` bytes: text, anchor, body, start byte, number of strings."""
    eight = suffixes.packed(t.data)
    grams = _grams(eight, width)
    owner, start, n, low = paths_of(grams, t.offsets, size, width)
    # A run is known by the eight bytes from every eighth place, and the last eight.
    length = np.abs(n) + size - 1
    words = -(-length // 8)
    at = np.repeat(start, words) + 8 * tx.ragged(np.zeros(len(words), np.int64), words)
    at = np.minimum(at, np.repeat(start + length - 8, words))
    body = body_hashes(eight[at], np.cumsum(words) - words, words)
    body = tx.mix(body + length.astype(np.uint64))
    return owner, grams[low].view(np.int64), body.view(np.int64), start - t.offsets[owner], n


_RUNS = "array<struct<anchor: long, body: long, start: int, n: int>>"


def _run_lists(parts: list[tuple[np.ndarray, ...]], counts: list[np.ndarray]) -> pa.Array:
    """An Arrow column of `_RUNS` from (anchor, body, start, n), and the number of runs of each text."""
    anchor, body, start, n = (np.concatenate(p) for p in zip((np.zeros(0, np.int64),) * 4, *parts))
    fields = [
        pa.array(anchor, pa.int64()),
        pa.array(body, pa.int64()),
        pa.array(start.astype(np.int32), pa.int32()),
        pa.array(n.astype(np.int32), pa.int32()),
    ]
    struct = pa.StructArray.from_arrays(fields, ["anchor", "body", "start", "n"])
    offsets = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts])))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)


def runs(text: Column | str, size: int) -> Column:
    """The runs of a text: array of (anchor, body, start byte, number of strings)."""

    def run(column: pa.Array) -> pa.Array:
        parts, counts = [], []
        for _, t in tx.slices(tx.flat(column), SLICE_BYTES):
            owner, *found = _runs_of(t, size, ANCHOR)
            parts.append(tuple(found))
            counts.append(np.bincount(owner, minlength=len(t)))
        return _run_lists(parts, counts)

    return F.arrow_udf(run, _RUNS).asNondeterministic()(text)


def finer_runs(text: Column | str, spans: Column | str, size: int, width: int) -> Column:
    """The runs in `spans` (start, n) cut again, with anchors of `width` bytes: as `runs`."""

    def run(column: pa.Array, wanted: pa.Array) -> pa.Array:
        parts, counts = [], []
        owner, start, n = _flat_spans(wanted, len(column))
        for base, t in tx.slices(tx.flat(column), SLICE_BYTES):
            mine = (owner >= base) & (owner < base + len(t))
            own, begin, lengths = owner[mine] - base, start[mine], n[mine] + size - 1
            # Each span is a text of its own.
            data = t.data[tx.ragged(t.offsets[own] + begin, lengths)]
            of, anchor, body, at, count = _runs_of(tx.Texts(data, np.append(0, np.cumsum(lengths))), size, width)
            parts.append((anchor, body, begin[of] + at, count))
            counts.append(np.bincount(own[of], minlength=len(t)))
        return _run_lists(parts, counts)

    return F.arrow_udf(run, _RUNS).asNondeterministic()(text, spans)


def _bytes_of(text: Column | str, spans: Column | str, size: int) -> Column:
    """The bytes of each run in `spans` (start, n): array of binary."""

    def run(column: pa.Array, wanted: pa.Array) -> pa.Array:
        owner, start, n = _flat_spans(wanted, len(column))
        lengths = n + size - 1
        data = []
        for base, t in tx.slices(tx.flat(column), SLICE_BYTES):
            mine = (owner >= base) & (owner < base + len(t))
            begin = t.offsets[owner[mine] - base] + start[mine]
            data.append(t.data[tx.ragged(begin, lengths[mine])].tobytes())
        ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        values = pa.BinaryArray.from_buffers(
            pa.binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(data))]
        )
        counts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(column))))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)

    return F.arrow_udf(run, "array<binary>").asNondeterministic()(text, spans)


_JUDGED = "doc_id long, version long, start int, n int, anchor long, string binary, shard long"


def _judge_shard(shard: pd.DataFrame, size: int) -> pd.DataFrame:
    """Runs of strings that are not the first of their kind in the shard.

    For anchors that several shards share, also the first place of each distinct string (`string`).
    """
    shard = shard.sort_values(["doc_id", "start", "version"], kind="stable")
    n = shard["n"].to_numpy(np.int64)
    raw = shard["bytes"].tolist()
    lengths = np.array([len(b) for b in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    order, eight = suffixes.suffix_array(data, size)
    shared = suffixes.common_prefixes(order, eight, size)
    kind = np.cumsum(shared < size)
    offsets = np.cumsum(lengths) - lengths
    owner_of = np.repeat(np.arange(len(raw)), lengths)
    place_in = np.arange(len(data)) - offsets[owner_of]
    whole = place_in < n[owner_of]  # places where a whole string starts within its run
    keep = whole[order]
    order, kind = order[keep], kind[keep]
    # Runs are in source order, and a string belongs to one run, so places are in source order too.
    both = np.sort(kind * len(data) + order)
    order, kind = both % len(data), both // len(data)
    lead = np.ones(len(kind), bool)
    lead[1:] = kind[1:] != kind[:-1]
    first = order[np.flatnonzero(lead)][np.cumsum(lead) - 1] if len(order) else order
    docs = shard["doc_id"].to_numpy(np.int64)
    starts = shard["start"].to_numpy(np.int64)

    def source(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return docs[owner_of[at]], starts[owner_of[at]] + place_in[at]

    (doc, at), (first_doc, first_at) = source(order), source(first)
    later = np.sort(order[(doc != first_doc) | (at != first_at)])
    fresh = np.ones(len(later), bool)
    if len(later):
        fresh[1:] = (later[1:] != later[:-1] + 1) | (owner_of[later[1:]] != owner_of[later[:-1]])
    begin = np.flatnonzero(fresh)
    count = np.diff(np.append(begin, len(later)))
    at = later[begin]
    of = owner_of[at]
    versions = shard["version"].to_numpy(np.int64)
    anchors = shard["anchor"].to_numpy(np.int64)
    which = int(shard["shard"].iloc[0])
    found = {
        "doc_id": docs[of], "version": versions[of], "start": starts[of] + place_in[at], "n": count,
        "anchor": anchors[of], "string": [None] * len(of), "shard": which,
    }
    split = shard["split"].to_numpy(bool)[owner_of[order]] & lead
    at = order[split]
    of = owner_of[at]
    kept = {
        "doc_id": docs[of], "version": versions[of], "start": starts[of] + place_in[at], "n": 1,
        "anchor": anchors[of], "string": [data[i : i + size].tobytes() for i in at], "shard": which,
    }
    return pd.concat([pd.DataFrame(found), pd.DataFrame(kept)], ignore_index=True)


def _merge(batches, size: int):
    """Of the sorted strings of several shards, those that another shard holds earlier."""
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    column = rows["string"].cast(pa.large_binary()).combine_chunks()
    _, ends, data = column.buffers()
    begin = np.frombuffer(ends, np.int64)[column.offset]
    # numpy drops zero bytes at the end of strings; equal length makes that harmless, save for order.
    strings = np.frombuffer(data, f"S{size}", len(column), begin)
    # A stable sort of strings finds the sorted runs of the shards and merges them, with binary searches.
    order = np.argsort(strings, kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = strings[order[1:]] != strings[order[:-1]]
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(fresh) - 1
    doc, start = (rows[name].to_numpy().astype(np.int64) for name in ("doc_id", "start"))
    order = np.lexsort((start, doc, kind))
    lead = order[np.append(True, np.diff(kind[order]) > 0)]  # the first place of each string
    later = (doc != doc[lead][kind]) | (start != start[lead][kind])
    out = rows.select(["doc_id", "version", "start", "n"]).filter(pa.array(later))
    yield from out.to_batches()


def _compacted(every: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Of the runs staged at `path`, which go then: copies of earlier runs, and those whose strings are yet to
    be compared, once each (anchor, body, n, first)."""
    at = ["doc_id", "version"]
    twice = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    twice = twice.where("m > 1 OR least < 0").select("anchor")
    held = staging.stage(every.join(twice, "anchor"))
    staging.drop(every.sparkSession, path)
    place = F.struct("doc_id", "start", "version")
    bodies = staging.stage(held.groupBy("anchor", "body", "n").agg(F.min(place).alias("first")))
    again = held.join(bodies, ["anchor", "body", "n"]).where(
        F.struct("doc_id", "start") > F.struct("first.doc_id", "first.start")
    )
    copies = again.select(*at, "start", F.abs("n").alias("n"))
    open_ = bodies.join(branching(bodies).select("anchor"), "anchor").withColumn("n", F.abs("n"))
    return copies, open_


def _weights(open_: DataFrame, size: int) -> DataFrame:
    return open_.groupBy("anchor").agg(F.sum(F.col("n") + size - 1).alias("weight"))


def repeated_strings(docs: DataFrame, size: int, shard_bytes: int) -> DataFrame:
    """doc_id, version, start, n: runs of strings that also start earlier. `docs`: doc_id, version, text."""
    at = ["doc_id", "version"]
    # Texts are cut into runs once; these are read for the counts and for the join, and then dropped.
    spark = docs.sparkSession
    path = staging.new_path(spark)
    every = staging.stage(docs.select(*at, F.explode(runs("text", size)).alias("r")).select(*at, "r.*"), path)
    copies, open_ = _compacted(every, path)
    open_ = staging.stage(open_)

    # Shards of several anchors; an anchor with many runs is dealt over several shards.
    ways = F.ceil(F.col("weight") * 4 / shard_bytes)
    weights = staging.stage(_weights(open_, size))
    total, most = weights.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.max(ways)).first()
    width = (size - 8) // 8 * 8
    if (most or 0) > 1 and width > ANCHOR:
        often = weights.where(ways > 1).select("anchor")
        wanted = open_.join(often, "anchor").select("first.*", "n").groupBy(*at)
        wanted = wanted.agg(F.collect_list(F.struct("start", "n")).alias("spans"))
        finer = docs.join(wanted, at).select(*at, F.explode(finer_runs("text", "spans", size, width)).alias("r"))
        path = staging.new_path(spark)
        more, rest = _compacted(staging.stage(finer.select(*at, "r.*"), path), path)
        copies = copies.unionByName(more)
        open_ = staging.stage(open_.join(often, "anchor", "left_anti").unionByName(rest))
        weights = staging.stage(_weights(open_, size))
        (total,) = weights.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()
    shards = max(-(-int(total) // shard_bytes), 1)
    salt = F.when(ways > 1, F.pmod(F.xxhash64("body"), ways)).otherwise(0)
    dealt = open_.join(weights, "anchor").select(
        "first.*", "n", "anchor", (ways > 1).alias("split"), F.pmod(F.xxhash64("anchor", salt), F.lit(shards)).alias("shard")
    )
    wanted = dealt.groupBy(*at).agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "anchor", "split", "shard"))).alias("spans")
    )
    fetched = docs.join(wanted, at).select(*at, "spans", _bytes_of("text", "spans", size).alias("bytes"))
    each = fetched.select(*at, F.explode(F.arrays_zip("spans", "bytes")).alias("z"))
    members = each.select(*at, "z.spans.*", "z.bytes")
    judged = staging.stage(
        members.groupBy("shard").applyInPandas(lambda shard: _judge_shard(shard, size), _JUDGED)
    )
    own = judged.where("string IS NULL").select(*at, "start", "n")
    split = judged.where("string IS NOT NULL")
    merged = split.repartitionByRange("string").mapInArrow(
        lambda batches: _merge(batches, size), "doc_id long, version long, start int, n int"
    )
    return copies.unionByName(own).unionByName(merged)


def cut(text: Column | str, spans: Column | str, size: int) -> Column:
    """Of a text without the bytes that the strings in `spans` cover: n_bytes, n_removed, n_spans, kept."""

    def run(column: pa.Array, wanted: pa.Array) -> pa.Array:
        owner, start, n = _flat_spans(wanted, len(column))
        whole, removed, spans_in, kept = ([np.zeros(0, np.int64)] for _ in range(4))
        data = []
        for base, t in tx.slices(tx.flat(column), SLICE_BYTES):
            mine = (owner >= base) & (owner < base + len(t))
            change = np.zeros(len(t.data) + 1, np.int32)
            begin = t.offsets[owner[mine] - base] + start[mine]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + n[mine] + size - 1, -1)
            keep = np.cumsum(change[:-1]) == 0
            total = np.concatenate(([0], np.cumsum(keep, dtype=np.int64)))
            left = total[t.offsets[1:]] - total[t.offsets[:-1]]
            opens = ~keep
            opens[1:] &= keep[:-1]
            starts = t.offsets[:-1][np.diff(t.offsets) > 0]
            opens[starts] = ~keep[starts]
            opened = np.concatenate(([0], np.cumsum(opens, dtype=np.int64)))
            whole.append(np.diff(t.offsets))
            removed.append(np.diff(t.offsets) - left)
            spans_in.append(opened[t.offsets[1:]] - opened[t.offsets[:-1]])
            kept.append(left)
            data.append(t.data[keep].tobytes())
        ends = np.concatenate(([0], np.cumsum(np.concatenate(kept)))).astype(np.int32)
        left_over = pa.BinaryArray.from_buffers(
            pa.binary(), len(column), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(b"".join(data))]
        )
        counts = [pa.array(np.concatenate(x), pa.int64()) for x in (whole, removed, spans_in)]
        return pa.StructArray.from_arrays([*counts, left_over], ["n_bytes", "n_removed", "n_spans", "kept"])

    kind = "n_bytes long, n_removed long, n_spans long, kept binary"
    return F.arrow_udf(run, kind).asNondeterministic()(text, spans)


def dedup(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left)."""
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    )
    stored = bucketed(plain, "doc_id", "version")
    found = repeated_strings(stored.where("doc_id IS NOT NULL"), size, shard_bytes)
    per_doc = found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = stored.join(per_doc, ["doc_id", "version"], "left")
    return joined.select("doc_id", cut("text", "spans", size).alias("c")).select("doc_id", "c.*")
