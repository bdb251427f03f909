"""The registered queries over the smallest tables, against the plain versions."""

import os

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA
from llm import brute

import __spark_entry__ as registered
from sensorlake.llm import queries

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def result(spark, name):
    return registered.queries()[name](spark, SF_DIR)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_every_operator_has_one_query():
    names = [n for n in registered.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in registered.queries() and set(queries.QUERIES) == {n for n in names if n[2].isdigit()}


def test_line_dedup(spark, texts):
    made = by_id(result(spark, "op1_line_dedup"), "n_lines", "removed")
    expected = brute.removed_lines(texts)
    assert made == {i: (n, ",".join(map(str, gone))) for i, (n, gone) in expected.items()}


def test_near_dups(spark, texts):
    made = by_id(result(spark, "op3_near_dups"), "n_shingles", "component_id")
    assert made == brute.near_groups(texts, 3, 85)


def test_pii(spark, texts):
    made = by_id(result(spark, "op4_pii"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for i, text in texts:
        found = brute.personal(text)
        counts = tuple(sum(f[0] == kind for f in found) for kind in brute.PATTERNS)
        assert made[i] == (*counts, brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in found)))


def test_substrings(spark, texts):
    made = by_id(result(spark, "op5_substring_dedup"), "n_words", "n_removed", "kept_sha256")
    left = brute.without_repeats([(i, brute.words(t)) for i, t in texts], 20)
    for i, t in texts:
        n = len(brute.words(t))
        assert made[i] == (n, n - len(left[i]), brute.sha(" ".join(left[i])))


def test_quality_rules(spark, texts):
    rows = {r.doc_id: r for r in result(spark, "op7_quality_rules").collect()}
    for i, t in texts:
        r, c = rows[i], brute.counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)


def test_bpe_equals_the_library(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(str(queries.vocabulary_path()))
    library.no_truncation()
    library.no_padding()
    made = by_id(result(spark, "op2_bpe"), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert made[i] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(back))


def test_neighbours_against_all_products(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    column = next(c for c in rows[0].asDict() if c != "vec_id" and isinstance(rows[0][c], list))
    held = [(r.vec_id, r[column]) for r in rows if r[column] and all(v is not None and np.isfinite(v) for v in r[column]) and any(r[column])]
    ids, vectors = np.array([i for i, _ in held]), np.array([v for _, v in held], float)
    made = {}
    for r in result(spark, "op6_neighbours").collect():
        made.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    met = wanted = 0
    for at, query in enumerate(ids):
        if query % 20:
            assert query not in made
            continue
        scores = vectors @ vectors[at]
        order = [k for k in np.lexsort((ids, -scores)) if k != at][:20]
        found = sorted(made[query])
        assert [rank for rank, _, _ in found] == list(range(1, len(order) + 1))
        assert found == [(k, i, s) for k, (s, i) in enumerate(sorted(((s, i) for _, i, s in found), key=lambda x: (-x[0], x[1])), 1)]
        place = {i: k for k, i in enumerate(ids)}
        np.testing.assert_allclose([s for _, _, s in found], [scores[place[i]] for _, i, _ in found], rtol=1e-12, atol=1e-12)
        met += len({i for _, i, _ in found} & {ids[k] for k in order})
        wanted += len(order)
    assert met >= 0.9 * wanted > 0


def test_mixing_comes_near_its_targets(spark, texts):
    rows = result(spark, "op9_mixing").collect()
    words = {i: len(brute.words(t)) for i, t in texts}
    held, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == words[r.doc_id] and 0 <= r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        held[r.source] = held.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert target.setdefault(r.source, r.target) == r.target
    assert all(r.source_size == held[r.source] for r in rows)
    # 150 % of all sizes by weights 5, 2, 1, up to twice a source; what is beyond goes to the others.
    order = sorted(held, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, expected = 1.5 * sum(held.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * held[s]}
        if not full:
            expected.update(share)
            break
        for s in full:
            expected[s] = 2.0 * held[s]
            left -= expected[s]
        open_ -= full
    for s in order:
        assert abs(target[s] - expected[s]) <= 1e-6 * max(1, expected[s])
        # Every text k times or once more: the largest such sum up to the target.
        rounds, sums = int(target[s] // held[s]) if held[s] else 0, 1
        for r in rows:
            sums |= sums << r["size"] if r.source == s else 0
        assert taken[s] == max(k for k in range(int(target[s] - rounds * held[s]) + 1) if sums >> k & 1) + rounds * held[s]


@pytest.mark.parametrize("name, columns", [
    ("op2_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    ("op6_neighbours", ["query_id", "rank", "vec_id", "score"]),
    ("op8_warc", ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]),
    ("op9_mixing", ["doc_id", "size", "source_size", "target", "taken"]),
    ("op10_suffix_dedup", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
])
def test_contract_columns(spark, name, columns):
    df = result(spark, name)
    assert df.columns[: len(columns)] == columns and df.count() > 0


@pytest.mark.parametrize("name", queries.SQL)
def test_sql_gives_the_same_rows(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    answer = duck.execute(f"SELECT * FROM ({queries.SQL[name]})")
    names = [d[0] for d in answer.description]
    df = result(spark, name)
    assert sorted(names) == sorted(df.columns)
    expected = sorted(tuple(map(str, row)) for row in answer.fetchall())
    assert sorted(tuple(map(str, row)) for row in df.select(*names).collect()) == expected
