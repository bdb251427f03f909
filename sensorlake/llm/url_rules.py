"""Verdicts on URLs by rules that are found through their rarest literal token.

A rule is a site (a host, with all its subdomains, and the start of a path) or a pattern with wild cards.
Both become a regular expression and the literal tokens that every URL which it fits must hold. A rule is
listed under the one of its tokens that the fewest URLs hold; the tokens of a URL fetch the rules listed
under them, and only those are run. A rule without a whole literal token is listed under the empty token,
which every URL has.

Patterns: `*` is any text, `^` a separator (none of a-z 0-9 _ . % -) or the end, a leading `||` the start of
a host or of a label in it, a leading `|` the start and a trailing `|` the end of the URL; all else stands
for itself. They see the URL with A-Z lower-cased; sites see its path as it is.

A site decides before a pattern, the longest one (host and path) first, and of equal ones the block. Among
patterns an allow is an exception from all blocks. What nothing fits has the default verdict.

Defined cases: a URL that is NULL or has no `://` has an empty host and path; rules with a NULL or an empty
host or pattern, or a NULL path or verdict, are left out; every row has a result, also one without an id
and repeated ones; empty tables give no rows, or the default. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake import staging

INDEX_BYTES = 64 * 1024 * 1024  # a larger index is not broadcast
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PUNCTUATION = r"([\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])"
_SEPARATOR = r"(?:[^a-z0-9_.%-]|\z)"
_HOST_START = r"^[^:/?#]*://(?:[^/?#]*\.)?"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between the first `://` and any of `/?#`, A-Z lower-cased; and from there up to `?` or `#`."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return _lower(host), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_tokens(text: Column) -> Column:
    """The different maximal runs of a-z and 0-9, and the empty token."""
    return F.array_distinct(F.split(F.concat(F.lit(" "), text), "[^a-z0-9]+"))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, _PUNCTUATION, r"\\$1")


def _site_rules(sites: DataFrame) -> DataFrame:
    """A site's tokens are whole in a URL but for a last one that goes on."""
    text = F.concat(_lower(F.col("host")), F.col("path"))
    known = sites.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
    return known.select(
        F.lit(True).alias("site"),
        text.alias("rule"),
        "verdict",
        F.concat(F.lit(r"^([^/]*\.)?"), _quoted(text)).alias("regex"),
        F.regexp_extract_all(_lower(text), F.lit("[a-z0-9]+(?=[^a-z0-9])"), 0).alias("tokens"),
    )


def _pattern_rules(patterns: DataFrame) -> DataFrame:
    """A pattern's tokens are those with neither a wild card nor an open end beside them."""
    text = _lower(F.col("pattern"))
    inner = F.regexp_replace(text, r"^\|{1,2}", "")
    closed = F.col("pattern").endswith("|") & (F.length(inner) > 0)
    body = _quoted(F.when(closed, F.regexp_replace(inner, r"\|\z", "")).otherwise(inner))
    # Escaped like all punctuation; the two wild cards are then given their meaning.
    body = F.replace(body, F.lit(r"\*"), F.lit(".*"))
    body = F.replace(body, F.lit(r"\^"), F.lit(_SEPARATOR))
    start = F.when(text.startswith("||"), F.lit(_HOST_START)).when(text.startswith("|"), F.lit("^")).otherwise(F.lit(""))
    end = F.when(closed, F.lit(r"\z")).otherwise(F.lit(""))
    return patterns.where("pattern <> '' AND verdict IS NOT NULL").select(
        F.lit(False).alias("site"),
        F.col("pattern").alias("rule"),
        "verdict",
        F.concat(F.lit("(?s)"), start, body, end).alias("regex"),
        F.regexp_extract_all(text, F.lit("(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), 0).alias("tokens"),
    )


def _bounded(df: DataFrame, text: list[str], most: int) -> DataFrame:
    """A staged frame, to be broadcast if its rows take no more than `most` bytes."""
    size = sum((F.octet_length(c) for c in text), F.lit(64))
    held = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if held <= most else df


def indexed(rules: DataFrame, tokens: DataFrame, most: int = INDEX_BYTES) -> DataFrame:
    """`rules` (with number and tokens) under the rarest of their tokens in `tokens` (column token, one
    row per URL and token): token, site, rule, verdict, regex. Ties go to the first token in order."""
    listed = staging.stage(rules.select("number", F.explode_outer("tokens").alias("token")).fillna("", ["token"]))
    literal = _bounded(staging.stage(listed.select("token").distinct()), ["token"], most)
    counts = tokens.join(literal, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = staging.stage(counts)
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")
    rarest = listed.join(counts, "token", "left").groupBy("number").agg(F.min(rarity)["token"].alias("token"))
    return staging.stage(rules.join(rarest, "number").select("token", "site", "rule", "verdict", "regex"))


def judge(
    pages: DataFrame,
    sites: DataFrame,
    patterns: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    most: int = INDEX_BYTES,
) -> DataFrame:
    """Per row of `pages`: its id, host, path, rule (the site that decides, as host and path), verdict
    and pattern (the one that decides).

    `sites` has verdict (allow or block), host and path, `patterns` verdict and pattern. An index of up to
    `most` bytes is broadcast; the tokens of URLs are joined with a larger one by shuffle, where
    adaptive execution splits a token that many URLs hold.
    """
    host, path = host_and_path(F.col(url))
    urls = staging.stage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(page_id).alias("page_id"),
            host.alias("host"),
            path.alias("path"),
            _lower(F.coalesce(F.col(url), F.lit(""))).alias("low"),
        )
    )
    rules = _site_rules(sites).unionByName(_pattern_rules(patterns))
    rules = staging.stage(rules.withColumn("number", F.monotonically_increasing_id()))
    tokens = urls.select(F.explode(url_tokens(F.col("low"))).alias("token"))
    index = _bounded(indexed(rules, tokens, most), ["token", "rule", "regex"], most)

    held = urls.select("row", "low", F.concat("host", "path").alias("place"), F.explode(url_tokens(F.col("low"))).alias("token"))
    seen = F.when(F.col("site"), F.col("place")).otherwise(F.col("low"))
    # Only rules fetched by a token come to their regular expression.
    fits = held.join(index, "token").where(F.rlike(seen, F.col("regex")))
    exception = ~F.col("site") & (F.col("verdict") == "allow")
    strength = F.struct("site", exception.alias("exception"), F.length("rule").alias("length"), "verdict", "rule")
    best = fits.groupBy("row").agg(F.max(strength).alias("best"))
    return urls.join(best, "row", "left").select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.site"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.when(~F.col("best.site"), F.col("best.rule")).alias("pattern"),
    )
