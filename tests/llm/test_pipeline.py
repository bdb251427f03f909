"""The pipeline, stage by stage, over a small table."""

import os
import random

import pyarrow as pa
import pytest
from llm import brute
from pyspark.sql import functions as F

from sensorlake import staging

corpus_pipeline = pytest.importorskip("corpus_pipeline")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(5)
    common = "subscribe to our letter today and never miss a word of it"
    data, labels = [], []
    for i in range(240):
        w = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(60, 140))]
        text = " ".join(w[:40]) + "\n" + common + "\n" + " ".join(w[40:])
        if i % 5 == 0:
            text = " ".join(f"{x}$$#" for x in w)
        elif i % 7 == 0:
            text = (data[-1][1] or "") + " tail"
        data.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, 0 if i % 5 == 0 else 1, 0))
    data += [(900, None, None, None, None), (901, "", "en", "src1", 0), (902, "short one", "en", None, 9)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(data, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    # Further columns, named like what the stages use themselves.
    names = "row found made times taken size cls version removed n_words kept _of _version _removed _times _copy _quality _counts a.b"
    docs = docs.withColumns({name: F.lit(len(name)) for name in names.split()})
    results = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert dict(out.dtypes) == dict(docs.dtypes), name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        results.append(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "bpe"]

    kept = {r.doc_id for r in results[0].collect()}
    assert kept == {i for i, t in texts.items() if t and i % 5 and brute.counts(t)[0] >= 50}

    gone = brute.removed_lines([(i, texts[i]) for i in kept])
    cut = {r.doc_id: r.text for r in results[1].collect()}
    assert cut == {
        i: "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in gone[i][1]) for i in kept
    }
    assert results[1].where(F.col("n_chars") != F.length("text")).isEmpty()

    groups = brute.near_groups(list(cut.items()))
    alone = {r.doc_id for r in results[2].collect()}
    assert alone == {i for i, (_, component) in groups.items() if i == component}

    mixed = results[3].groupBy("doc_id").count().collect()
    assert {r.doc_id for r in mixed} <= alone and all(r["count"] <= 2 for r in mixed)
    words = sum(len(brute.words(cut[i])) for i in alone)
    total = sum(r["count"] * len(brute.words(cut[r.doc_id])) for r in mixed)
    assert abs(total - 1.5 * words) <= 0.02 * words
    assert results[4].count() == results[3].count()


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0, name
    assert out.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_results_of_stages_side_by_side(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    staged: list[str] = []
    with staging.collecting(staged):
        made = [stage(spark, docs, sf_dir) for _, stage in [*corpus_pipeline.STAGES, *corpus_pipeline.STAGES]]
    half = len(made) // 2
    for one, other in zip(made[:half], made[half:]):
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    # Three stages keep one table of decisions each; all else is gone.
    left = [path for path in staged if os.path.exists(path.removeprefix("file:"))]
    assert len(left) == 6


def test_run_gives_the_rows_of_the_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    again = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(str, rows.collect())) == sorted(map(str, again.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_mix_is_merged_with_its_texts_at_any_size(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = corpus_pipeline.mix(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_staged_texts_go_to_functions_in_small_batches(spark):
    texts = spark.range(5_000).repartition(1).select(F.col("id").cast("string").alias("text"))
    sizes = F.arrow_udf(lambda column: pa.array([len(column)] * len(column)), "int")
    assert staging.stage(texts.select(sizes("text").alias("n")), batch=700).agg(F.max("n")).first()[0] == 700
    assert texts.select(sizes("text").alias("n")).agg(F.max("n")).first()[0] == 5_000
