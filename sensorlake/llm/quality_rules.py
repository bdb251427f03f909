"""Quality rules: an ordered list of threshold conjunctions learned from labels.

`measure` counts features of every text. `fit` grows and prunes one conjunction after the other by
sequential covering: a rule grows on two thirds of the labelled rows by information gain, loses its
last conditions where that helps on the other third, and is taken while it is right often enough
there. `DecisionList.rule` turns the list into one Spark conditional expression.

Defined cases: a NULL text counts as empty; a row with a NULL or repeated doc_id is measured like any
other; labels with NULL quality are left out and of several labels for one doc_id the lowest counts;
without labels, or with labels of one kind only, the list is empty and no rule fails a text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import texts as tx

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct",
)
SYMBOLS = "#*$%&|<>"
MAX_LABELLED = 50_000  # labelled rows that a list is learned from, at most about


def _count_slice(t: tx.Texts) -> dict[str, np.ndarray]:
    w = tx.words(t)
    text = w.text_of()
    size = len(t)
    data, offsets = t.data, t.offsets

    def per_text(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(hit, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    continuing = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80, dtype=np.int64)))
    chars = (w.ends - w.starts) - (continuing[w.ends] - continuing[w.starts])
    hashes = tx.span_hashes(data, w.starts, w.ends)
    salt = tx.mix(np.arange(1, size + 1, dtype=np.uint64))

    # Words in three-word windows that the text holds more than once.
    at = tx.window_starts(w.first, 3)
    keys = tx.window_hashes(hashes, 3)[at] ^ salt[text[at]] if len(at) else np.zeros(0, np.uint64)
    _, same, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = tx.covered(at[times[same] > 1], 3, len(hashes))

    # Lines with a word; a line also ends where its text does.
    newline = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate((offsets[:-1], newline + 1)))
    begin = begin[begin < len(data)]
    stop = np.append(newline, len(data))
    end = np.minimum(
        stop[np.searchsorted(newline, begin)], offsets[np.searchsorted(offsets, begin, "right")]
    )
    with_word = np.searchsorted(w.starts, end) > np.searchsorted(w.starts, begin)
    begin, end = begin[with_word], end[with_word]
    line_text = np.searchsorted(offsets, begin, "right") - 1
    line_keys = tx.span_hashes(data, begin, end) ^ salt[line_text]
    _, first_line = np.unique(line_keys, return_index=True)

    _, first_word = np.unique(hashes ^ salt[text], return_index=True)
    return {
        "n_words": np.diff(w.first),
        "word_chars": np.bincount(text, chars, size).astype(np.int64),
        "n_symbols": per_text(np.isin(data, np.frombuffer(SYMBOLS.encode(), np.uint8))),
        "n_dup_lines": np.bincount(line_text, minlength=size)
        - np.bincount(line_text[first_line], minlength=size),
        "n_repeat_words": np.bincount(text[repeated], minlength=size),
        "n_lines": np.bincount(line_text, minlength=size),
        "n_upper": per_text((data >= 65) & (data <= 90)),
        "n_digits": per_text((data >= 48) & (data <= 57)),
        "n_marks": per_text((data == 0x21) | (data == 0x3F)),
        "n_distinct": np.bincount(text[first_word], minlength=size),
    }


def _count(column: pa.Array) -> pa.Array:
    parts = [_count_slice(t) for _, t in tx.slices(tx.flat(column))]
    fields = [
        pa.array(np.concatenate([p[name] for p in parts]) if parts else [], pa.int64())
        for name in COUNTS
    ]
    return pa.StructArray.from_arrays(fields, list(COUNTS))


def measure(text: Column | str) -> Column:
    """The counts of a text as one struct column."""
    schema = ", ".join(f"{name} long" for name in COUNTS)
    # Marked so that a filter on the counts does not have them counted a second time.
    return F.arrow_udf(_count, schema).asNondeterministic()(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def features(count=F.col) -> dict[str, Column]:
    """Shares that do not depend on the length of a text; `count` gives the column of a count."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(count(part) / F.nullif(count(whole), F.lit(0)), F.lit(0.0))

    return {
        "mean_word": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "upper": share("n_upper", "word_chars"),
        "digits": share("n_digits", "word_chars"),
        "marks": share("n_marks", "n_words"),
        "distinct": share("n_distinct", "n_words"),
        "line_words": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature >= threshold, else feature <= threshold
    threshold: float

    def column(self, columns: dict[str, Column]) -> Column:
        value, limit = columns[self.feature], F.lit(self.threshold)
        return value >= limit if self.above else value <= limit

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values <= self.threshold


@dataclass(frozen=True)
class DecisionList:
    rules: list[list[Condition]] = field(default_factory=list)

    def rule(self, columns: dict[str, Column]) -> Column:
        """The number of the first rule that fails the text, from 1; NULL where none does."""
        chosen = None
        for number, conditions in enumerate(self.rules, 1):
            every = conditions[0].column(columns)
            for condition in conditions[1:]:
                every = every & condition.column(columns)
            chosen = F.when(every, number) if chosen is None else chosen.when(every, number)
        return F.lit(None).cast("int") if chosen is None else chosen


def labelled_sample(
    measured: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """Counts of labelled texts with `bad`: all of them, or those with the lowest hashes of doc_id."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).alias("bad"))
    )
    total = known.count()
    if total > max_labelled:
        place = F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1 << 40))
        known = known.where(place < int((1 << 40) * (max_labelled / total)))
    return measured.select("doc_id", *COUNTS).join(known, "doc_id")


def fit(
    measured: DataFrame,
    labels: DataFrame,
    *,
    max_labelled: int = MAX_LABELLED,
    min_precision: float = 0.97,
    min_rows: int = 3,
    max_conditions: int = 4,
) -> DecisionList:
    """Learn the list of rules for bad texts; `measured` has doc_id and COUNTS.

    Learning runs on the driver over at most about `max_labelled` rows of a few numbers each. A rule
    must cover `min_rows` held-out rows and be right for `min_precision` of them.
    """
    sample = labelled_sample(measured, labels, max_labelled)
    rows = sample.select("doc_id", "bad", *[c.alias(n) for n, c in features().items()]).toPandas()
    rows = rows.sort_values(["doc_id", *features()], kind="stable")
    place = tx.mix(rows["doc_id"].to_numpy().astype(np.int64).astype(np.uint64))
    held = place % np.uint64(3) == 0
    values = {name: rows[name].to_numpy(float) for name in features()}
    bad = rows["bad"].to_numpy(bool)
    limits = {n: np.unique(np.quantile(v, np.linspace(0, 1, 129))) for n, v in values.items() if len(v)}
    left = np.ones(len(bad), bool)
    rules: list[list[Condition]] = []
    while (left & bad & ~held).any():
        rule = _grow(values, limits, bad, left & ~held, max_conditions)
        rule = _prune(rule, values, bad, left & held)
        if not rule:
            break
        hit = _covers(rule, values, left)
        checked = hit & held
        if checked.sum() < min_rows or bad[checked].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~hit
    return DecisionList(rules)


def _covers(rule: list[Condition], values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    hit = among.copy()
    for condition in rule:
        hit &= condition.holds(values[condition.feature])
    return hit


def _grow(values, limits, bad, among, max_conditions) -> list[Condition]:
    rule: list[Condition] = []
    hit = among
    while len(rule) < max_conditions and (hit & ~bad).any():
        before = np.log2(bad[hit].mean())
        best, best_gain = None, 1e-9
        for name, v in values.items():
            edge = limits[name]
            for above in (True, False):
                # Rows on the near side of each threshold, by kind.
                order = np.searchsorted(edge, v[hit], "right" if above else "left")
                each = [np.bincount(order[kind], minlength=len(edge) + 1) for kind in (bad[hit], ~bad[hit])]
                if above:
                    right, wrong = (np.cumsum(c[::-1])[::-1][1:] for c in each)
                else:
                    right, wrong = (np.cumsum(c)[:-1] for c in each)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(right > 0, right * (np.log2(right / (right + wrong)) - before), 0)
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Condition(name, above, float(edge[k])), gain[k]
        if best is None:
            break
        rule.append(best)
        hit = _covers([best], values, hit)
    return rule


def _prune(rule, values, bad, among) -> list[Condition]:
    def worth(part: list[Condition]) -> float:
        hit = _covers(part, values, among)
        return (bad[hit].sum() - (~bad[hit]).sum()) / hit.sum() if hit.any() else -1.0

    return max((rule[:size] for size in range(len(rule), 0, -1)), key=worth, default=[])


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """`docs` with a struct `_quality`: the counts, `base_failed`, `rule` and `kept`.

    A column of `docs` that has this name is replaced; other names do not matter.
    """
    counts = "_counts"
    while counts in docs.columns:
        counts += "_"
    counted = docs.withColumn(counts, measure(text))
    columns = features(lambda name: F.col(f"{counts}.{name}"))
    failed = base_failed(F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words"))
    rule = rules.rule(columns)
    return counted.withColumn(
        "_quality",
        F.struct(
            f"{counts}.*",
            failed.alias("base_failed"),
            rule.alias("rule"),
            (~failed & rule.isNull()).alias("kept"),
        ),
    ).drop(counts)
