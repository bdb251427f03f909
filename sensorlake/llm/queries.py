"""One query per operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import (
    bpe,
    filter_audit,
    line_dedup,
    mixing,
    near_dups,
    neighbours,
    oracle,
    pii,
    quality_rules,
    ranked_search,
    substring_dedup,
    suffix_dedup,
    url_rules,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.repeated_lines(docs)
    version = F.xxhash64("text").alias("version")
    every = docs.select("doc_id", version).join(found, ["doc_id", "version"], "left")
    return every.select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"),
    )


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or vocabulary_path()
    docs = table(spark, sf_dir, "documents")
    made = docs.select("doc_id", bpe.round_trip("text", path).alias("made")).select("doc_id", "made.*")
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))

    def joined(spans: str) -> Column:
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def held(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[held(kind) for kind in pii.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = docs.select("doc_id", quality_rules.measure("text").alias("counts"))
    measured = staging.stage(counts.select("doc_id", "counts.*"))
    rules = quality_rules.fit(measured, table(spark, sf_dir, "labels"))
    failed = quality_rules.base_failed(F.col("n_words"), F.col("n_repeat_words"))
    rule = rules.rule(quality_rules.features())
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.alias("rule"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging.new_path(spark)
    warc.write(table(spark, sf_dir, "pages"), folder)
    records = warc.read(spark, folder).withColumnRenamed("id", "page_id")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


# The rules of the query, and patterns for hosts that sell, bet or track.
SITES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
PATTERNS = [
    ("block", "||casino-"),
    ("block", "||cheap-pills."),
    ("block", "||adult-"),
    ("block", "||ads-*."),
    ("block", "||spam-"),
    ("block", "||free-bets."),
    ("allow", "||spam-*/es/"),
]


def _literal(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """A small table of texts, as an expression."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _literal(spark, SITES, "verdict", "host", "path")
    patterns = _literal(spark, PATTERNS, "verdict", "pattern")
    judged = url_rules.judge(table(spark, sf_dir, "pages"), sites, patterns)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bpe": op2_bpe,
    "op3_near_dups": op3_near_dups,
    "op4_pii": op4_pii,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_neighbours": op6_neighbours,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_url_rules": op11_url_rules,
    "op12_ranked_search": op12_ranked_search,
    "op13_filter_audit": op13_filter_audit,
}

SQL: dict[str, str] = oracle.SQL
