"""Personal data by patterns and by context, on built-in functions alone.

Base patterns give e-mail addresses, IP addresses, card and phone numbers: leftmost matches of each kind
that do not overlap, of which those that fail a check are dropped. They are the seeds of a bootstrap. An
instance is a base match or any other word with an @ or four digits in it; a pattern is what stands around
it (the word before, the two words before, the words before and after, the key before a `:`, `=` or `#`),
the form of what stands in the slot (digits as 9, runs of letters as a), or the word before with that form.
Words of a context are lower-cased letters, so `Phone:`, `(phone)` and `PHONE =` are one.

Patterns and instances form a graph that is scored in rounds. For a kind, a seed counts 1, a seed of
another kind and a base match that failed its check count 0, and an instance found in an earlier round counts
as much as its surest pattern. The confidence of a pattern is the sum of these over the number of its
different instances, of which those that nothing is known of count `UNKNOWN` each, and one more. Patterns
that reach `min_confidence` with `min_seeds` different instances from as many documents accept the other
instances in their slots, which support the patterns of the next round, until no pattern is added. The slots
of all accepted patterns give further spans, each of the kind of its surest pattern.

The regular expressions below accept what the plain ones do, but never try a start that must fail and
never go back, so long runs of digits or letters take linear time and no deep stack.

Defined cases: a NULL text is empty and has no spans; rows without a doc_id are treated like others, but
do not count as documents of a pattern; rows with equal doc_id and text have equal results; the columns of
`docs` other than the two named do not matter, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIDENCE = 0.8
MIN_SEEDS = 5  # different known instances in the slot of a pattern, and documents that they stand in
UNKNOWN = 0.5  # weight of an instance that nothing is known of
FAILED = "none"  # label of a base match that failed its check

_LOCAL = r"[A-Za-z0-9._%+-]"
_WORD = r"[^\x20\x09-\x0D]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Phone-like and card-like runs as a whole, and words with a digit or @.
_CANDIDATE = (
    rf"\+[0-9][\x20().0-9-]+[0-9]|(?<!{_WORD})[0-9](?:[\x20-]?[0-9]){{9,18}}+|(?<!{_WORD}){_WORD}*[0-9@]{_WORD}*"
)
_SPAN = "struct<start: int, end: int, token: string, before: string, after: string>"


def _found(text: Column, pattern: str) -> Column:
    """Matches with code point positions, and the pieces of text before and after each."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    parts = F.struct(matches.alias("m"), pieces.alias("p"))

    def step(state: Column, i: Column, both: Column) -> Column:
        token = F.get(both["m"], i)
        start = state["at"] + F.length(F.get(both["p"], i))
        end = start + F.length(token)
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            token.alias("token"),
            F.get(both["p"], i).alias("before"),
            F.get(both["p"], i + 1).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def walk(both: Column) -> Column:
        empty = F.array().cast(f"array<{_SPAN}>")
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        places = F.sequence(F.lit(0), F.size(both["m"]) - 1)
        walked = F.aggregate(places, start, lambda state, i: step(state, i, both), lambda state: state["out"])
        return F.when(F.size(both["m"]) > 0, walked).otherwise(empty)

    # One pass of the regular expressions: the pair is bound to a lambda variable.
    return F.get(F.transform(F.array(parts), walk), 0)


def _digits(token: Column) -> Column:
    return F.regexp_replace(token, "[^0-9]", "")


def _luhn(token: Column) -> Column:
    """Digits from the right, every second one doubled and its digits added: a multiple of ten."""
    digits = F.reverse(_digits(token))

    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _matches(text: Column) -> dict[str, Column]:
    """Per kind an array of (start, end, fine) of all matches, fine being whether one passes its check."""
    n_digits = lambda s: F.length(_digits(s["token"]))
    has_digit = text.rlike("[0-9]")
    ip = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
    tests = {
        "email": (F.contains(text, F.lit("@")), _EMAIL, lambda s: F.lit(True)),
        "ip": (has_digit & F.contains(text, F.lit(".")), _IP, lambda s: s["token"].rlike(ip)),
        "card": (has_digit, _CARD, lambda s: _luhn(s["token"])),
        "phone": (F.contains(text, F.lit("+")), _PHONE, lambda s: n_digits(s).between(8, 15)),
    }

    def judged(fine) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), fine(s).alias("fine"))

    none = F.array().cast("array<struct<start: int, end: int, fine: boolean>>")
    return {
        kind: F.when(possible, F.transform(_found(text, pattern), judged(fine))).otherwise(none)
        for kind, (possible, pattern, fine) in tests.items()
    }


def _flat(piece: Column) -> Column:
    return F.lower(F.translate(piece, "\t\n\x0b\f\r", "     "))


def _letters(words: Column) -> Column:
    return F.trim(F.regexp_replace(words, r"[^\p{L}]++", " "))


def _instances(text: Column) -> Column:
    """Array of (start, end, token, one, two, after, key): words that could be identifiers, and their context."""
    found = F.when(text.rlike("[0-9@]"), _found(text, _CANDIDATE))
    found = F.filter(found, lambda s: s["token"].contains("@") | (F.length(_digits(s["token"])) >= 4))

    def context(s: Column) -> Column:
        before, after = F.rtrim(_flat(s["before"])), F.ltrim(_flat(s["after"]))
        last = F.substring_index(before, " ", -3)
        words = _letters(last)
        core = F.regexp_extract(s["token"], r"[A-Za-z0-9+](?:.*[A-Za-z0-9])?", 0)
        start = s["start"] + F.instr(s["token"], core) - 1
        return F.struct(
            start.alias("start"),
            (start + F.length(core)).alias("end"),
            core.alias("token"),
            F.substring_index(words, " ", -1).alias("one"),
            F.substring_index(words, " ", -2).alias("two"),
            F.substring_index(_letters(F.substring_index(after, " ", 2)), " ", 1).alias("after"),
            last.rlike(r"[:=#][\x20\x22\x27(\[]*$").alias("key"),
        )

    kind = "array<struct<start: int, end: int, token: string, one: string, two: string, after: string, key: boolean>>"
    return F.coalesce(F.transform(found, context), F.array().cast(kind))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, version, an array of base spans for each kind, failed matches, and the instances with their contexts."""
    value = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(value).alias("version"),
        *[matches.alias(kind) for kind, matches in _matches(value).items()],
        _instances(value).alias("instances"),
    )
    found = staging.stage(found)

    def bare(kind: str, fine: bool) -> Column:
        of_kind = F.filter(kind, lambda m: m["fine"] == fine)
        return F.transform(of_kind, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))

    failed = F.concat(*[bare(kind, False) for kind in KINDS]).alias("failed")
    return found.select("doc_id", "version", *[bare(kind, True).alias(kind) for kind in KINDS], failed, "instances")


def _labelled(scanned: DataFrame) -> DataFrame:
    """One row per instance: its place and context, and its label (the kind of a seed, FAILED, or NULL)."""
    each = scanned.select("doc_id", "version", *KINDS, "failed", F.explode("instances").alias("i"))

    def meets(spans: str) -> Column:
        return F.exists(spans, lambda b: (b["start"] < F.col("i.end")) & (b["end"] > F.col("i.start")))

    label = F.coalesce(*[F.when(meets(kind), F.lit(kind)) for kind in KINDS], F.when(meets("failed"), F.lit(FAILED)))
    return each.select("doc_id", "version", "i.*", label.alias("label"))


def _in_slots(labelled: DataFrame, patterns: list[Column]) -> DataFrame:
    rows = labelled.select("doc_id", "version", "start", "end", "token", "label", F.array(*patterns).alias("ps"))
    return rows.withColumn("pattern", F.explode(F.array_compact("ps"))).drop("ps")


def _contexts(labelled: DataFrame) -> DataFrame:
    """One row per instance and pattern of the words around it."""
    before, after = F.col("one") != "", F.col("after") != ""
    return _in_slots(
        labelled,
        [
            F.when(before, F.concat(F.lit("one "), "one")),
            F.when(F.col("two").contains(" "), F.concat(F.lit("two "), "two")),
            F.when(before & after, F.concat(F.lit("around "), "one", F.lit(" "), "after")),
            F.when(before & F.col("key"), F.concat(F.lit("key "), "one")),
        ],
    )


def _forms(labelled: DataFrame) -> DataFrame:
    """One row per instance and pattern of its form, alone or after a word.

    A form keeps the number of digits; runs of digits count as one where two separators or more say enough,
    so that any number after a word that cards stand after is not taken for one.
    """
    plain = F.regexp_replace("token", r"\p{L}++", "a")
    form, shape = F.regexp_replace(plain, "[0-9]", "9"), F.regexp_replace(plain, "[0-9]++", "9")
    separators = F.length(F.regexp_replace(plain, "[a0-9]", ""))
    short = lambda c: F.when(F.length(c) > 64, F.md5(c)).otherwise(c)
    return _in_slots(
        labelled,
        [
            F.concat(F.lit("form "), short(form)),
            F.when(separators >= 2, F.concat(F.lit("shape "), short(shape))),
            F.when(
                F.col("one") != "",
                F.concat(F.lit("after "), "one", F.lit(" "), short(F.when(separators >= 2, shape).otherwise(form))),
            ),
        ],
    )


def _occurrences(scanned: DataFrame) -> DataFrame:
    """One row per instance and pattern of the words around it: the label of the instance, its place."""
    return _contexts(_labelled(scanned))


def patterns(
    occurrences: DataFrame,
    *,
    rounds: int | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    min_seeds: int = MIN_SEEDS,
) -> DataFrame:
    """kind, pattern, confidence: the patterns accepted, with their confidence when they were.

    `occurrences`: pattern, token, label, doc_id. An instance counts once in a pattern, however often it
    stands there, and for one document, its smallest. Rounds end when no pattern is added, or after `rounds`.
    """
    edges = occurrences.groupBy("pattern", "token", "label").agg(F.min("doc_id").alias("doc"))
    edges = staging.stage(edges)
    accepted = edges.select("token", F.col("label").alias("kind"), F.lit(0.0).alias("belief")).where("false")
    good = edges.select(F.col("label").alias("kind"), "pattern", F.lit(0.0).alias("confidence")).where("false")
    done = 0
    while rounds is None or done < rounds:
        done += 1
        state = edges.join(accepted, "token", "left").select(
            "pattern",
            "doc",
            F.coalesce("label", "kind").alias("kind"),
            F.when(F.col("label") == FAILED, 0.0).when(F.col("label").isNotNull(), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))).alias("r"),
            F.when(F.coalesce("label", "kind").isNotNull(), 1.0).otherwise(UNKNOWN).alias("weight"),
        )
        sums = state.groupBy("pattern", "kind").agg(
            F.sum("r").alias("r"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("m"), F.count_distinct("doc").alias("docs")
        )
        # A handful of rows for each pattern: one for each label.
        by_pattern = sums.groupBy("pattern").agg(
            F.sum("weight").alias("all"), F.max_by(F.struct("kind", "r", "m", "docs"), F.struct("r", "kind")).alias("most")
        )
        confident = by_pattern.select("pattern", "most.*", (F.col("most.r") / (F.col("all") + 1)).alias("confidence"))
        confident = confident.where(F.col("kind").isin(*KINDS) & (F.col("confidence") >= min_confidence))
        confident = confident.where((F.col("m") >= min_seeds) & (F.col("docs") >= min_seeds))
        confident = confident.select("kind", "pattern", "confidence")
        confident = staging.stage(confident.join(good, "pattern", "left_anti"))
        if confident.isEmpty():
            break
        good = good.unionByName(confident)
        slots = edges.where("label IS NULL").select("pattern", "token").join(good, "pattern")
        surest = F.max(F.struct(F.col("confidence").alias("belief"), "kind")).alias("s")
        accepted = staging.stage(slots.groupBy("token").agg(surest).select("token", "s.kind", "s.belief"))
    return good


def _added(
    labelled: DataFrame, rounds: int | None, min_confidence: float, min_seeds: int
) -> DataFrame:
    """doc_id, version, start, end, kind of the instances without a label in slots of accepted patterns."""
    occurrences = staging.stage(_contexts(labelled).unionByName(_forms(labelled)))
    good = patterns(occurrences, rounds=rounds, min_confidence=min_confidence, min_seeds=min_seeds)
    unseen = occurrences.where("label IS NULL").join(good, "pattern")
    # One place may stand in the slots of patterns of several kinds: the surest counts.
    best = F.max_by("kind", F.struct("confidence", "kind"))
    return unseen.groupBy("doc_id", "version", "start", "end").agg(best.alias("kind"))


def held_out(
    docs: DataFrame,
    *,
    percent: int = 30,
    doc_id: str = "doc_id",
    text: str = "text",
    rounds: int | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    min_seeds: int = MIN_SEEDS,
) -> DataFrame:
    """How much of what is hidden comes back: one row per kind, hidden or added.

    `percent` of the seeds, by the hash of their text, are hidden from the bootstrap: kind, hidden (places of such
    instances), added (spans of the kind that the bootstrap adds), right (those of them that are hidden ones).
    """
    labelled = _labelled(scan(docs, doc_id=doc_id, text=text))
    hide = F.col("label").isin(*KINDS) & (F.pmod(F.xxhash64("token"), F.lit(100)) < percent)
    labelled = labelled.withColumn("secret", F.when(hide, F.col("label")))
    labelled = staging.stage(labelled.withColumn("label", F.when(F.col("secret").isNull(), F.col("label"))))
    added = _added(labelled, rounds, min_confidence, min_seeds)
    at = ["doc_id", "version", "start", "end"]
    hidden = labelled.where("secret IS NOT NULL").select(*at, "secret").distinct().alias("h")
    met = [F.col(f"a.{c}").eqNullSafe(F.col(f"h.{c}")) for c in at]
    both = added.alias("a").join(hidden, met, "full")
    counted = both.select(
        F.explode(F.array_compact(F.array_distinct(F.array("secret", "kind")))).alias("of"), "secret", "kind"
    )

    def times(condition: Column, name: str) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)

    mine = F.col("kind") == F.col("of")
    theirs = F.col("secret") == F.col("of")
    return counted.groupBy(F.col("of").alias("kind")).agg(
        times(theirs, "hidden"), times(mine, "added"), times(mine & theirs, "right")
    )


def spans(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    rounds: int | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    min_seeds: int = MIN_SEEDS,
) -> DataFrame:
    """Per row of `docs`: doc_id, base and all spans as arrays of (kind, start, end).

    Kinds stand in the order of KINDS, spans of a kind by start.
    """
    scanned = scan(docs, doc_id=doc_id, text=text)
    added = _added(_labelled(scanned), rounds, min_confidence, min_seeds)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    per_doc = added.groupBy("doc_id", "version").agg(
        F.collect_set(F.struct(place.alias("place"), "start", "end")).alias("added")
    )

    def placed(number: int, kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(F.lit(number).alias("place"), s["start"].alias("start"), s["end"].alias("end"))
        )

    held = F.concat(*[placed(number, kind) for number, kind in enumerate(KINDS, 1)])

    def named(array: Column) -> Column:
        names = F.array(*map(F.lit, KINDS))
        return F.transform(
            F.sort_array(array), lambda s: F.struct(F.get(names, s["place"] - 1).alias("kind"), s["start"], s["end"])
        )

    rows = scanned.select("doc_id", "version", held.alias("held")).join(
        per_doc.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")) & (scanned["version"] == per_doc["version"]), "left"
    )
    every = F.concat("held", F.coalesce("added", F.filter("held", lambda s: F.lit(False))))
    return rows.select("doc_id", named(F.col("held")).alias("base"), named(every).alias("spans"))
