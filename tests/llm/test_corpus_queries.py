"""Registered corpus queries: SQL where there is some, else plain versions; and the pipeline, stage by stage."""
import hashlib
import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
import corpus_pipeline  # noqa: E402
import plain  # noqa: E402
from compare import same  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from strata.llm import catalog, secret_scan  # noqa: E402
from strata.llm.common import load  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    ok, why = same(catalog.QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(catalog.ORACLE[name]).df())
    assert ok, why


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in catalog.QUERIES


def test_language_id_on_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in load(spark, SF_SMALL, "documents").collect()}
    rows = [r for r in catalog.QUERIES["op5_language_id"](spark, SF_SMALL).collect()]
    assert len(rows) == len(truth) and all(r.held_out == plain.held_out(r.doc_id) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_secret_scan_base_columns(spark):
    text = {r.doc_id: r.text for r in load(spark, SF_SMALL, "documents").collect()}
    rows = catalog.QUERIES["op9_secret_scan"](spark, SF_SMALL).collect()
    assert len(rows) == len(text)
    for r in rows:
        t = text[r.doc_id] or ""
        spans = [(m.start(), 0, m.end()) for m in re.finditer(secret_scan.ASSIGN, t, re.A) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        written = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()


def test_shards_of_the_table(spark):
    rows = catalog.QUERIES["op8_shards"](spark, SF_SMALL).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in rows} == {"rows"}
    text = {r.doc_id: r.text for r in load(spark, SF_SMALL, "documents").collect()}
    where = {}
    for r in rows:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_mix_of_the_table(spark):
    rows = catalog.QUERIES["op1_source_mix"](spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in load(spark, SF_SMALL, "documents").collect()}
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_pipeline_stages_against_plain_versions(spark):
    docs = load(spark, SF_SMALL, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["language_id"](spark, docs, SF_SMALL).cache()
    assert kept.columns == columns and kept.count() == docs.where("text rlike '\\\\p{L}'").count()

    near = steps["near_duplicates"](spark, kept, SF_SMALL).cache()
    groups = {c for _, _, c in plain.jaccard([(r.doc_id, r.text) for r in kept.collect()])}
    assert near.columns == columns and sorted(r.doc_id for r in near.collect()) == sorted(groups)

    clean = steps["decontaminate"](spark, near, SF_SMALL).cache()
    items = [(r.item_id, r.text) for r in load(spark, SF_SMALL, "benchmark").collect()]
    want = [i for i, n, hit, _ in plain.overlaps([(r.doc_id, r.text) for r in near.collect()], items) if not (hit and 20 * hit >= n)]
    assert clean.columns == columns and sorted(r.doc_id for r in clean.collect()) == sorted(want)

    mixed = steps["mix_sources"](spark, clean, SF_SMALL).cache()
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} == set(want)
    shards = steps["shard"](spark, mixed, SF_SMALL).collect()
    assert sorted(r.doc_id for r in shards) == sorted(r.doc_id for r in mixed.collect())
    sizes = [sum(r.shard == s for r in shards) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_pipeline_runs_and_keeps_to_its_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and out.count() > 0


def test_stages_take_odd_rows_and_clashing_columns(spark):
    """Nulls in any column, empty and repeated rows, and extra columns that the operators use themselves."""
    text = "the quick brown fox jumps over the lazy dog and runs away from the old hunter"
    rows = [(1, text, "en", "a"), (2, text.upper(), "en", None), (None, text + " x", None, "a"), (4, None, "en", "a"), (5, "", "en", "b"), (6, "12 34", None, None),
            (7, "eine ganz andere geschichte von einem alten mann und seinem hund im wald", "de", "b"), (7, "eine ganz andere geschichte von einem alten mann und seinem hund im wald", "de", "b"),
            (8, "kurz", "de", None), (9, "Released under a license", "en", "b"), (None, None, None, None), (None, "solo words here", "en", "b")]
    extra = ["mix", "kept", "score", "lang_pred", "component", "hits", "slot", "shard", "row_hash", "id", "label", "nid"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in extra)
    docs = spark.createDataFrame([(*r, len(r[1] or ""), *range(len(extra))) for r in rows], schema)
    for frame in (docs, docs.limit(0)):
        current = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            current = corpus_pipeline.settle(stage(spark, current, SF_SMALL), f"odd-{name}")
            assert current.columns == docs.columns, name
        out = corpus_pipeline.STAGES[-1][1](spark, current, SF_SMALL)
        kept = {(r.doc_id, r.text) for r in current.collect()}
        assert kept == ({(1, text), (7, rows[6][1]), (8, "kurz"), (9, rows[9][1]), (None, "solo words here")} if frame is docs else set())
        assert out.count() == current.count()
