"""A corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of documents. What a stage decides is
written as a small table of its own, on which its result stands; all else that it stages is deleted before
it returns, so that results of several stages can be read side by side, in any order.

Defined cases: a document whose lines are all removed stays with an empty text, counts nothing in the
mix, and is not returned by it; NULL texts fail the base rule of the first stage; further columns go
through all stages but the last, whatever they are called; an empty table gives an empty result.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake import staging
from sensorlake.llm import bpe, line_dedup, mixing, near_dups, quality_rules
from sensorlake.llm.buckets import whole_row
from sensorlake.llm.queries import table, vocabulary_path


def _decided(spark: SparkSession, decide: Callable[[], DataFrame]) -> DataFrame:
    """What `decide` returns, stored; the other tables that it stages are deleted."""
    path = staging.new_path(spark)
    with staging.scope(spark):
        found = decide()
        with staging.freeing(spark):
            found.write.parquet(path)
        schema = found.schema
    return spark.read.schema(schema).parquet(path)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    # All texts are counted for the labelled ones: a few numbers each are joined, not the texts.
    counts = docs.select("doc_id", quality_rules.measure("text").alias("counts"))
    with staging.scope(spark):
        measured = staging.stage(counts.select("doc_id", "counts.*"), batch=staging.TEXTS)
        rules = quality_rules.fit(measured, table(spark, sf_dir, "labels"))
    rows = docs.select(whole_row(docs).alias("row"), "text")
    return quality_rules.judge(rows, rules).where("_quality.kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line resembles."""
    found = _decided(spark, lambda: line_dedup.repeated_lines(docs).where("n_removed > 0"))
    cut = line_dedup.remove_lines(docs, found)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    gone = _decided(spark, lambda: near_dups.near_duplicates(docs).where("NOT kept").select("doc_id").distinct())
    gone = gone.withColumnRenamed("doc_id", "_of")
    return docs.join(gone, docs["doc_id"] == gone["_of"], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    times = (F.col("taken") / F.col("size")).cast("int")

    def choose() -> DataFrame:
        chosen = mixing.mix(docs).where("taken > 0").select("doc_id", times.alias("times"))
        # Rows that share a doc_id are all taken as often as the one of them taken most.
        return chosen.groupBy("doc_id").agg(F.max("times").alias("times"))

    chosen = _decided(spark, choose)
    rows = docs.select(whole_row(docs).alias("row"))
    # As many rows as documents are chosen: they are merged with them at any size, never broadcast.
    repeated = rows.join(chosen.hint("merge"), F.col("row")["doc_id"].eqNullSafe(F.col("doc_id")))
    return repeated.select("row", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and what they decode to."""
    path = vocabulary_path()
    made = docs.select("doc_id", "source", bpe.round_trip("text", path).alias("made"))
    return made.select("doc_id", "source", "made.*").select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]

#: The learned rules, the mix and the tokens have no SQL form; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staging.stage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
