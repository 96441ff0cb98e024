from __future__ import annotations

import pytest

import corpus_pipeline as p
from subscope.llm import decontaminate, ngram_join, quality, secret_scan
from subscope.llm.queries import QUERIES


def test_stages_keep_columns_and_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "encoding"]
    for i, (name, stage) in enumerate(p.STAGES):
        out = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(out)
        after = spark.read.parquet(out)
        if i < 4:
            assert after.columns == columns and after.dtypes == docs.dtypes
        ids, kept = {r.doc_id for r in docs.collect()}, {r.doc_id for r in after.collect()}
        assert kept <= ids
        if name == "quality":
            bad = {r.doc_id for r in quality.classify(docs, labels).where("not kept").collect()}
            assert kept == ids - bad and bad
        if name == "near_duplicates":
            part = {r.doc_id: r.component_id for r in ngram_join.similarity_components(docs).collect()}
            assert kept == set(part.values())
        if name == "decontamination":
            assert kept == {r.doc_id for r in decontaminate.contamination(docs, benchmark).where("not contaminated").collect()}
        if name == "secrets":
            left = secret_scan.scan_secrets(after, cuts={}).collect()
            assert kept == ids and not any(r.n_assign + r.n_access + r.n_hex for r in left)
            assert all(len(r.text) == r.n_chars for r in after.collect())
        if name == "encoding":
            assert kept == ids and after.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        docs = after
    assert {tuple(r) for r in p.run(spark, sf_dir).collect()} == {tuple(r) for r in docs.collect()}


CLASHING = ("k", "fp", "h", "a", "b", "part", "set_fp", "maybe_grouped", "row_place", "kind", "label", "score", "kept", "item_id")


def test_odd_tables_go_through_all_stages(spark, odd, sf_dir, tmp_path):
    """Null and repeated ids, odd texts, clashing columns, an empty table: nothing crashes, and only copies go."""
    docs = odd.selectExpr("*", *(f"{i} as `{c}`" for i, c in enumerate(CLASHING)))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    for rows, want in ((docs, [3, 4, 5, 6, 7, 8, 10, 11, None]), (docs.limit(0), [])):  # 1 and 2 have no text, 9 repeats 8
        after = rows
        for i, (name, stage) in enumerate(p.STAGES):
            out = f"{tmp_path}/{rows is docs}-{name}"
            stage(spark, after, str(tmp_path)).write.parquet(out)
            after = spark.read.parquet(out)
            if i < 4:
                assert after.columns == docs.columns, name
                assert {tuple(r)[-len(CLASHING):] for r in after.collect()} <= {tuple(range(len(CLASHING)))}, name
        assert sorted((r.doc_id for r in after.collect()), key=str) == sorted(want, key=str)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_their_columns(spark, sf_dir, name):
    need = {
        "op1": "doc_id n_bytes n_removed n_spans kept_sha256", "op2": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op3": "doc_id n_tokens ids_sha256 decoded_sha256", "op4": "doc_id kept", "op5": "page_id url text n_chars",
        "op6": "doc_id start n_tokens ids_crc32", "op7": "doc_id contaminated", "op8": "doc_id n_shingles component_id",
        "op9": "page_id host path rule verdict", "op10": "vec_id n_links component_id kept",
        "op11": "doc_id size source_size target taken", "op12": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
        "op13": "lang rank phrase a l r n score",
    }[name.split("_")[0]].split()
    assert set(need) <= set(QUERIES[name](spark, sf_dir).columns)
