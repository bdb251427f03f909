"""Line dedup by an exact set-similarity join, on built-in functions alone.

A line is a part of a text between line feeds that holds a word; its tokens are its distinct words. A
line is removed when an earlier line (smaller doc_id, or the same document, further up) has a token set
with Jaccard similarity of at least `percent` to its own; earlier lines count whether they stay or not.

Equal lines form one class. Tokens are ordered by rarity: by how often the bucket of their hash occurs
in all texts (a table of fixed size), then by hash. Classes that match share one of their rarest tokens
(prefix filter); candidates pass the length and positional filters, and one by the parity of 64 bits, of 128
or 256 for longer lines, which would pass by chance otherwise. The token sets of classes with a candidate are made from their first lines. Among these, each class is compared
with the earliest of each of its tokens, which settles most variants of a line that many documents repeat;
what is left is compared with all candidates before it. Pairs pass a filter by 512 parity bits, which few
long lines pass by chance, before Jaccard similarity is verified on whole sets.

Defined cases: a NULL text has no lines; a row without a doc_id keeps all its lines and is not compared;
rows with equal doc_id and text have equal results, neither being earlier; of rows that share a doc_id but
not a text, a line of either counts as earlier than one further down; lines without a word stay; names of
other columns do not matter.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm.buckets import bucketed, whole_row

BREAKS = "\t\x0B\f\r"  # besides the space
RARITY_BUCKETS = 1 << 16
SIGNATURE = 8  # words of 64 parity bits, a power of two
PARITY = ("parity", "odd", "odd_high", "even_high")
HALVES, QUARTERS = 48, 120  # from so many tokens on, a set has 128 and 256 parity bits
_HASH_BITS = 54


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, version (of the text), line_no from 0, line, cls (hash of the line)."""
    split = F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), split)
    return lines.where(F.ltrim("line", F.lit(" " + BREAKS)) != "").withColumn("cls", F.xxhash64("line"))


def _spaced(text: str, breaks: str) -> Column:
    """`text` with a space for each of `breaks`: splitting at one character is cheaper than at a class."""
    held = [F.contains(F.col(text), F.lit(c)) for c in breaks]
    return F.when(reduce(or_, held), F.translate(text, breaks, " " * len(breaks))).otherwise(F.col(text))


def _bucket(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 48).cast("int")  # the upper 16 bits


def _rarity(docs: DataFrame) -> Column:
    """An array by hash bucket: how common its tokens are, on a logarithmic scale.

    Every plan with ranked tokens holds it as text, so its numbers are kept short.
    """
    flat = F.replace(_spaced("text", BREAKS), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode(F.split(flat, " ")).alias("word"))
    counted = words.groupBy(_bucket(F.xxhash64("word")).alias("bucket")).count()
    common = [0] * RARITY_BUCKETS
    for row in counted.collect():  # one small row per bucket
        common[row["bucket"]] = int(8 * math.log2(1 + row["count"]))
    return F.split(F.lit(",".join(map(str, common))), ",").cast("array<int>")


def _ranked(line: str, rarity: Column) -> Column:
    """The token set of a line as numbers, rarest first: bucket frequency above, hash below.

    Words are told apart by their hash, which is taken once, and only distinct ones are ranked.
    """
    low = F.lit((1 << _HASH_BITS) - 1)
    parts = F.split(_spaced(line, BREAKS), " ")
    hashes = F.array_distinct(F.transform(parts, lambda word: F.xxhash64(word)))
    hashes = F.array_remove(hashes, F.xxhash64(F.lit("")))  # between two spaces there is no word

    def rank(hashed: Column) -> Column:
        # Numbers that may not be NULL are sorted as plain ones, in less time.
        level = F.coalesce(F.get(rarity, _bucket(hashed)), F.lit(0)).cast("long")
        return F.shiftleft(level, _HASH_BITS).bitwiseOR(hashed.bitwiseAND(low))

    return F.sort_array(F.transform(hashes, rank))


def _common(n: Column, m: Column, percent: int) -> Column:
    """How many tokens two sets of these sizes share at least, at the threshold."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def _fold(tokens: Column) -> Column:
    """64 bits, each telling whether an odd number of tokens falls on it."""
    one = F.lit(1).cast("long")
    flip = lambda bits, t: bits.bitwiseXOR(F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int")))
    return F.aggregate(tokens, F.lit(0).cast("long"), flip)


def _parity(tokens: str) -> list[Column]:
    """The columns PARITY: 64 parity bits, and what halves and quarters them, NULL for sets too small for it.

    A pair of bits that `odd` holds for some of its tokens, `parity ^ odd` holds for the others: 128 bits in all;
    `odd_high` and `even_high` split these again. Where the bits of two sets differ, their tokens differ: so
    many of them at least.
    """
    at = lambda mask, value: F.filter(tokens, lambda t: t.bitwiseAND(F.lit(mask)) == value)
    n = F.size(tokens)
    columns = [
        _fold(F.col(tokens)),
        F.when(n >= HALVES, _fold(at(64, 64))),
        F.when(n >= QUARTERS, _fold(at(192, 192))),
        F.when(n >= QUARTERS, _fold(at(192, 128))),
    ]
    return [column.alias(name) for column, name in zip(columns, PARITY)]


def _differing(x: str, y: str) -> Column:
    """In how many parity bits two sets differ, of as many as both have."""
    whole, odd, odd_high, even_high = (F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}")) for c in PARITY)
    even = whole.bitwiseXOR(odd)
    halves = F.bit_count(odd) + F.bit_count(even)
    quarters = [odd_high, odd.bitwiseXOR(odd_high), even_high, even.bitwiseXOR(even_high)]
    return F.coalesce(sum(map(F.bit_count, quarters[1:]), F.bit_count(quarters[0])), halves, F.bit_count(whole))


def _prefix(tokens: Column, percent: int) -> Column:
    """The rarest tokens of a set: as many as it may lack against a match, and one more."""
    n = F.size(tokens)
    return F.slice(tokens, F.lit(1), (n - F.ceil(n * percent / 100) + 1).cast("int"))


def _may_match(x: str, y: str, percent: int) -> Column:
    """Filters on a token that two sets share: by length, by its places, by the parity of the sets.

    They are tried on every two rows of a token, so the first ones are plain products of whole numbers: `least`,
    `greatest` and `_common` say the same at some times the cost.
    """
    n, m = F.col(f"{x}.size").cast("long"), F.col(f"{y}.size").cast("long")
    near = (100 * n >= percent * m) & (100 * m >= percent * n)
    least = percent * (n + m)  # what two sets share at least, times 100 + percent
    enough = [(100 + percent) * (1 + size - F.col(f"{s}.place")) >= least for s, size in ((x, n), (y, m))]
    same = F.col(f"{x}.token") == F.col(f"{y}.token")
    return same & near & enough[0] & enough[1] & (_differing(x, y) <= n + m - 2 * _common(n, m, percent))


def _with_candidates(docs: DataFrame, rarity: Column, percent: int) -> DataFrame:
    """Classes (cls) that have a candidate: one that shares one of their rarest tokens and may match.

    Equal lines are put together first, so that a line of many documents is one row for each token. They are ranked
    before that: prefixes are less to shuffle than texts.
    """
    ranked = _lines(docs).select("cls", _ranked("line", rarity).alias("tokens"))
    ranked = ranked.select(
        "cls", F.size("tokens").alias("size"), *_parity("tokens"), _prefix(F.col("tokens"), percent).alias("prefix")
    )
    classes = ranked.groupBy("cls").agg(*[F.first(c).alias(c) for c in ("size", *PARITY, "prefix")])
    listed = classes.select("cls", "size", *PARITY, F.posexplode("prefix").alias("at", "token"))
    listed = listed.select("token", "cls", "size", *PARITY, (F.col("at") + 1).alias("place"))
    # Both sides are the same frame, so its rows are dealt out by token once. No pairs are made here.
    met = _may_match("x", "y", percent) & (F.col("x.cls") != F.col("y.cls"))
    return listed.alias("x").join(listed.alias("y"), met, "left_semi").select("cls").distinct()


def _signatures(sets: DataFrame) -> DataFrame:
    """ord, n, and SIGNATURE columns of 64 parity bits each: the longest sets need more bits than `_parity` has."""
    each = sets.select("ord", F.explode("tokens").alias("t"))
    word = F.shiftright("t", 6).bitwiseAND(F.lit(SIGNATURE - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t").bitwiseAND(F.lit(63)).cast("int"))
    bits = [F.coalesce(F.bit_xor(F.when(word == w, bit)), F.lit(0)).alias(f"s{w}") for w in range(SIGNATURE)]
    return bucketed(each.groupBy("ord").agg(F.count(F.lit(1)).alias("n"), *bits), "ord", dealt=True)


def _alike(pairs: DataFrame, sets: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The classes (by number) of `pairs` whose token set matches that of their earlier partner.

    Token sets are brought to the pairs that their signatures leave.
    """
    other = signatures.toDF(*[f"{c}_2" for c in signatures.columns])
    signed = pairs.join(signatures, "ord").join(other, "ord_2")
    differ = sum((F.bit_count(F.col(f"s{w}").bitwiseXOR(F.col(f"s{w}_2"))) for w in range(SIGNATURE)), F.lit(0))
    n, m = F.col("n"), F.col("n_2")
    likely = staging.stage(signed.where(differ <= n + m - 2 * _common(n, m, percent)).select("ord", "ord_2"))
    tokens = sets.select("ord", "tokens")
    both = likely.join(tokens, "ord").join(tokens.toDF("ord_2", "tokens_2"), "ord_2")
    shared = F.size(F.array_intersect("tokens", "tokens_2"))
    union = F.size("tokens") + F.size("tokens_2") - shared
    return both.where(100 * shared >= percent * union).select("ord").distinct()


def _listed(sets: DataFrame, percent: int) -> DataFrame:
    """The sets under each token of their prefix."""
    # Beside an explode, a column is computed for each of its rows: the bits are made below it.
    prefix = _prefix(F.col("tokens"), percent).alias("prefix")
    signed = sets.select("ord", F.size("tokens").alias("size"), *_parity("tokens"), prefix)
    each = signed.select("ord", "size", *PARITY, F.posexplode("prefix").alias("at", "token"))
    return each.select("token", "ord", "size", (F.col("at") + 1).alias("place"), *PARITY)


def _repeated_classes(sets: DataFrame, percent: int) -> DataFrame:
    """Numbers of the classes that match an earlier one. `sets`: ord (in order of first lines), tokens."""
    listed = _listed(sets, percent)
    # First against the earliest class of each token, which settles most variants of a line. The rows
    # of a token are brought together once, for all that follows; tokens of one class are left out.
    of_token = Window.partitionBy("token")
    listed = listed.withColumn("m", F.count(F.lit(1)).over(of_token)).withColumn("earliest", F.min("ord").over(of_token))
    listed = bucketed(listed.where("m > 1").drop("m"), "token", dealt=True)
    leads = listed.where(F.col("ord") == F.col("earliest"))
    met = _may_match("x", "y", percent) & (F.col("x.ord") > F.col("y.ord"))
    chosen = [F.col("x.ord").alias("ord"), F.col("y.ord").alias("ord_2")]
    first = listed.alias("x").join(leads.alias("y"), met).select(*chosen).distinct()
    signatures = _signatures(sets)
    settled = staging.stage(_alike(first, sets, signatures, percent))
    # What is left, against all classes before it.
    open_ = listed.join(settled, "ord", "left_anti")
    rest = open_.alias("x").join(listed.alias("y"), met).select(*chosen).distinct()
    return settled.union(_alike(rest, sets, signatures, percent))


def _token_sets(docs: DataFrame, numbered: DataFrame, rarity: Column) -> DataFrame:
    """ord, tokens, of the classes in `numbered` (ord, first), made from their first lines."""
    spots = numbered.groupBy("first.doc_id", "first.version").agg(
        F.collect_list(F.struct("ord", "first.line_no")).alias("spots")
    )
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    held = texts.join(spots, ["doc_id", "version"]).select(F.split("text", "\n").alias("lines"), "spots")
    line = lambda s: F.struct(s["ord"], F.get("lines", s["line_no"]).alias("line"))
    each = held.select(F.explode(F.transform("spots", line)).alias("s")).select("s.*")
    # Rows with equal doc_id and text give the same sets.
    return each.select("ord", _ranked("line", rarity).alias("tokens")).dropDuplicates(["ord"])


def repeated_lines(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = 80
) -> DataFrame:
    """Per distinct (doc_id, text): doc_id, version, n_lines, n_removed, removed (line numbers from 0).

    `version` is the hash of the text, to tell rows apart that share a doc_id.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    lines = staging.stage(_lines(docs).drop("line"))
    place = F.struct("doc_id", "line_no", "version")
    firsts = lines.groupBy("cls").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("held"))
    firsts = staging.stage(firsts)

    rarity = _rarity(docs)
    needed = firsts.join(_with_candidates(docs, rarity, percent), "cls").select("cls", "first")
    # Numbered in the order of their first lines.
    numbered = staging.stage(staging.stage(needed).orderBy("first", "cls").withColumn("ord", F.monotonically_increasing_id()))
    sets = bucketed(_token_sets(docs, numbered, rarity), "ord", dealt=True)
    dropped = numbered.join(_repeated_classes(sets, percent), "ord").select("cls", "first", F.lit(True).alias("dropped"))
    held = firsts.where("held > 1").select("cls", "first", F.lit(False).alias("dropped"))
    decided = held.union(dropped).groupBy("cls").agg(F.min("first").alias("first"), F.max("dropped").alias("dropped"))

    judged = lines.join(staging.stage(decided), "cls", "left")
    after = F.struct("doc_id", "line_no") > F.struct("first.doc_id", "first.line_no")
    gone = F.col("first").isNotNull() & (after | F.coalesce("dropped", F.lit(False)))
    judged = judged.withColumn("gone", F.coalesce(gone, F.lit(False)))
    per_doc = judged.groupBy("doc_id", "version").agg(
        F.size(F.collect_set("line_no")).cast("long").alias("n_lines"),
        F.sort_array(F.collect_set(F.when(F.col("gone"), F.col("line_no")))).alias("removed"),
    )
    return per_doc.select("doc_id", "version", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def remove_lines(docs: DataFrame, repeated: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the lines that `repeated_lines` named taken out of the text, whatever its columns are called."""
    rows = docs.select(whole_row(docs).alias("row"))
    named = repeated.where("n_removed > 0").select(F.struct("doc_id", "version", "removed").alias("found"))
    row, found = F.col("row"), F.col("found")
    met = (row[doc_id] == found["doc_id"]) & (F.xxhash64(row[text]) == found["version"])
    kept = F.filter(F.split(row[text], "\n"), lambda line, at: ~F.array_contains(found["removed"], at))
    cut = F.when(found.isNotNull(), F.array_join(kept, "\n")).otherwise(row[text])
    # The named lines follow the documents: they are merged with them at any size, never broadcast.
    return rows.join(named.hint("merge"), met, "left").select(*[(cut if c == text else row[c]).alias(c) for c in docs.columns])
