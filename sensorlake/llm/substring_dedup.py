"""Substring dedup on words: repeated spans found on runs of windows that share a minimizer.

No graph is built. Consecutive windows of `size` words with the same lowest-hashed `ANCHOR`-word sequence
form one run ("path" below); equal windows always lie on runs with an equal anchor, so windows meet by
anchor. An anchor that occurs once in all texts holds no repeated window. Runs of the other anchors are
compacted: equal runs are one, known by its first source coordinate (doc_id, word). Where an anchor has a
single run, its windows first occur where the run does. Only the windows of anchors with several
("branching" below), once for each distinct run, are looked at one by one, and those of a run that
repeats itself. A window counts as repeated when its first coordinate lies before its own. Windows and
runs are told apart by two 64-bit hashes over one 64-bit hash of each word, so two words of equal hash
would be taken for one.

Defined cases: a NULL text has no words; a text shorter than a window keeps all its words; rows without
a doc_id keep all words and are not compared; rows with equal doc_id and text have equal results, neither
being earlier; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import texts as tx
from sensorlake.llm.buckets import bucketed

SIZE = 20
ANCHOR = 4


def sliding_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the lowest (leftmost of equal) of values[i : i + width]."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    # The place in the low bits: equal windows hold equal values in equal order, so they still agree.
    bits = np.uint64(max(len(values).bit_length(), 1))
    low = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    reach = 1
    while reach < width:  # doubling: the lowest of `reach` values, then of twice as many
        step = min(reach, width - reach)
        low = np.minimum(low[: len(low) - step], low[step:])
        reach += step
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def paths_of(grams: np.ndarray, first: np.ndarray, size: int, anchor: int):
    """Paths of all texts, given hashes of `anchor` items from each place: text, first window, number
    of windows, place of the (first) anchor.

    A path goes on while the lowest hash stays the same, so a text that repeats itself is one path. Its
    windows may be equal to each other: its number of windows is negative.
    """
    at = tx.window_starts(first, size)
    low = sliding_lowest(grams, size - anchor + 1)[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (grams[low[1:]] != grams[low[:-1]]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(fresh)
    ends = np.append(begin, len(at))[1:]
    start = at[begin]
    text = np.searchsorted(first, start, "right") - 1
    loops = low[ends - 1] != low[begin]
    return text, start, np.where(loops, -1, 1) * (ends - begin), low[begin]


def body_hashes(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of values[start : start + length] for each path; unlike span_hashes, spans overlap."""
    place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    parts = tx.mix(values[tx.ragged(start, length)] + tx.mix(place.astype(np.uint64)))
    before = np.cumsum(length) - length
    return tx.mix(np.add.reduceat(parts, before) + length.astype(np.uint64)) if len(start) else parts


def _word_hashes(t: tx.Texts) -> tuple[tx.Words, np.ndarray]:
    w = tx.words(t)
    return w, tx.span_hashes(t.data, w.starts, w.ends)


def paths(text: Column | str, size: int, anchor: int) -> Column:
    """The paths of a text: array of (anchor hash, body hash, start word, number of windows)."""

    def run(column: pa.Array) -> pa.Array:
        parts = [(np.zeros(0, np.int64),) * 4]
        counts = [np.zeros(0, np.int64)]
        for _, t in tx.slices(tx.flat(column)):
            w, values = _word_hashes(t)
            grams = tx.window_hashes(values, anchor)
            owner, start, windows, low = paths_of(grams, w.first, size, anchor)
            key = tx.mix(grams[low] + np.uint64(anchor)).view(np.int64)
            body = body_hashes(values, start, np.abs(windows) + size - 1).view(np.int64)
            parts.append((key, body, start - w.first[owner], windows))
            counts.append(np.bincount(owner, minlength=len(t)))
        key, body, start, windows = (np.concatenate(p) for p in zip(*parts))
        fields = [
            pa.array(key, pa.int64()),
            pa.array(body, pa.int64()),
            pa.array(start.astype(np.int32), pa.int32()),
            pa.array(windows.astype(np.int32), pa.int32()),
        ]
        struct = pa.StructArray.from_arrays(fields, ["anchor", "body", "start", "n"])
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)

    kind = "array<struct<anchor: long, body: long, start: int, n: int>>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)


def _flat_spans(spans: pa.Array, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and number of windows of array<struct<start, n>> values."""
    spans = spans.fill_null([]) if spans.null_count else spans
    counts = np.diff(spans.offsets.to_numpy())
    struct = spans.flatten()
    owner = np.repeat(np.arange(texts), counts)
    start, n = (struct.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    return owner, start, n


def windows(text: Column | str, spans: Column | str, size: int) -> Column:
    """Of each window in `spans`: two hashes, its start word, whether the text holds it in `spans` before."""

    def run(column: pa.Array, wanted: pa.Array) -> pa.Array:
        parts = [(np.zeros(0, np.int64),) * 4]
        counts = [np.zeros(0, np.int64)]
        owner, start, n = _flat_spans(wanted, len(column))
        for base, t in tx.slices(tx.flat(column)):
            w, values = _word_hashes(t)
            mine = (owner >= base) & (owner < base + len(t))
            own = owner[mine] - base
            at = tx.ragged(start[mine] + w.first[own], n[mine])
            of = np.repeat(own, n[mine])
            one, two = (tx.window_hashes(values, size, salt) for salt in (0, 1))
            one, two = one[at].view(np.int64), two[at].view(np.int64)
            order = np.lexsort((at, two, one, of))
            again = np.zeros(len(at), bool)
            same = [x[order[1:]] == x[order[:-1]] for x in (of, one, two)]
            again[order[1:]] = same[0] & same[1] & same[2]
            parts.append((one, two, at - w.first[of], again))
            counts.append(np.bincount(of, minlength=len(t)))
        one, two, at, again = (np.concatenate(p) for p in zip(*parts))
        fields = [pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(at.astype(np.int32), pa.int32())]
        struct = pa.StructArray.from_arrays([*fields, pa.array(again.astype(bool))], ["one", "two", "at", "again"])
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)

    kind = "array<struct<one: long, two: long, at: int, again: boolean>>"
    return F.arrow_udf(run, kind).asNondeterministic()(text, spans)


def cut(text: Column | str, spans: Column | str, size: int) -> Column:
    """Of a text without the words that the windows in `spans` cover: n_words, n_removed, kept."""

    def run(column: pa.Array, wanted: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        owner, start, n = _flat_spans(wanted, len(column))
        for base, t in tx.slices(tx.flat(column)):
            w = tx.words(t)
            mine = (owner >= base) & (owner < base + len(t))
            own = owner[mine] - base
            total = len(w.starts)
            change = np.zeros(total + 1, np.int64)
            begin = start[mine] + w.first[own]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + n[mine] + size - 1, -1)
            keep = np.cumsum(change[:-1]) == 0
            n_words.append(np.diff(w.first))
            of = w.text_of()
            n_removed.append(np.bincount(of[~keep], minlength=len(t)))
            # Kept words with one space after each, then without the last space of a text.
            lengths = w.ends[keep] - w.starts[keep] + 1
            data = np.append(t.data, 0x20).astype(np.uint8)[tx.ragged(w.starts[keep], lengths)]
            if len(lengths):
                data[np.cumsum(lengths) - 1] = 0x20
            sizes = np.bincount(of[keep], lengths, len(t)).astype(np.int64)
            ends = np.cumsum(sizes)
            raw = data.tobytes()
            kept += [raw[e - s : max(e - 1, e - s)].decode() for e, s in zip(ends.tolist(), sizes.tolist())]
        whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        fields = [pa.array(whole(n_words), pa.int64()), pa.array(whole(n_removed), pa.int64()), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(fields, ["n_words", "n_removed", "kept"])

    return F.arrow_udf(run, "n_words long, n_removed long, kept string").asNondeterministic()(text, spans)


def branching(bodies: DataFrame) -> DataFrame:
    """anchor, m (distinct paths): anchors of several paths, or of one that holds windows twice."""
    paths = bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    return paths.where("m > 1 OR least < 0").select("anchor", "m")


def repeated_windows(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """doc_id, version, start, n: runs of windows that also start earlier. `docs`: doc_id, version, text."""
    at = ["doc_id", "version"]
    every = docs.select(*at, F.explode(paths("text", size, anchor)).alias("p")).select(*at, "p.*")
    twice = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
    twice = twice.where("m > 1 OR least < 0").select("anchor")
    held = staging.stage(every.join(twice, "anchor"))

    # Compaction: equal paths are one, and it is known by where it occurs first.
    place = F.struct("doc_id", "start", "version")
    bodies = staging.stage(held.groupBy("anchor", "body", "n").agg(F.min(place).alias("first")))
    path = ["anchor", "body", "n"]
    again = held.join(bodies, path).where(
        F.struct("doc_id", "start") > F.struct("first.doc_id", "first.start")
    )
    copies = again.select(*at, "start", F.abs("n").alias("n"))

    # Branching anchors and loops: the windows of each distinct path, one by one.
    open_ = bodies.join(branching(bodies).select("anchor"), "anchor").select("first.*", F.abs("n").alias("n"))
    wanted = open_.groupBy(*at).agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    seen = docs.join(wanted, at).select(*at, F.explode(windows("text", "spans", size)).alias("w"))
    seen = staging.stage(seen.select(*at, "w.*"))
    # What a text holds before needs no comparison with others, however often it repeats itself.
    new = seen.where("NOT again")
    firsts = new.groupBy("one", "two").agg(
        F.min(F.struct("doc_id", "at")).alias("first"), F.count(F.lit(1)).alias("m")
    )
    later = new.join(firsts.where("m > 1"), ["one", "two"]).where(F.struct("doc_id", "at") > F.col("first"))
    singles = later.select(*at, "at").unionByName(seen.where("again").select(*at, "at"))
    singles = singles.select(*at, F.col("at").alias("start"), F.lit(1).alias("n"))
    return copies.unionByName(singles)


def dedup(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, anchor: int = ANCHOR
) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed, kept (the words left, joined by single spaces)."""
    plain = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("version"), F.col(text).alias("text")
    )
    stored = bucketed(plain, "doc_id", "version")
    found = repeated_windows(stored.where("doc_id IS NOT NULL"), size, anchor)
    per_doc = found.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = stored.join(per_doc, ["doc_id", "version"], "left")
    return joined.select("doc_id", cut("text", "spans", size).alias("c")).select("doc_id", "c.*")
