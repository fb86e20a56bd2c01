"""The registered queries and the pipeline on the small tables."""

from __future__ import annotations

import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from frostline.llm import decontaminate, toxicity
from frostline.llm.common import Stages, table
from frostline.llm.queries import ORACLES, QUERIES
from test_documents import AWKWARD, SCHEMA, classes_by_brute_force, lines_by_brute_force, repeats_by_brute_force

COLUMNS = {
    "op1_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op6_cover_tree": ["vec_id", "n_links", "component_id", "kept"],
    "op8_html_template": ["page_id", "url", "text", "n_chars"],
    "op9_run_index": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op10_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op11_merkle": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_pair_counts": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_has_its_columns(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.columns[: len(COLUMNS.get(name, []))] == COLUMNS.get(name, [])
    source = {"op6_cover_tree": "embeddings", "op8_html_template": "pages", "op13_warc": "pages"}.get(name, "documents")
    rows, whole = frame.count(), table(spark, sf_dir, source).count()
    assert rows == whole or (name == "op4_packing" and rows > whole) or (name == "op2_decontaminate" and rows > 0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    import oracle_check

    problem, _ = oracle_check.compare(spark, oracle_check.duck(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None, problem


def test_all_are_registered():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_held_out_fold(spark, sf_dir):
    got = QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_queries_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").orderBy("doc_id").collect()]
    classes = classes_by_brute_force(rows)
    assert {r.doc_id: r.class_id for r in QUERIES["op5_dart_minhash"](spark, sf_dir).collect()} == {d: rows[classes[n]][0] for n, (d, _) in enumerate(rows)}
    repeats = dict(zip((d for d, _ in rows), repeats_by_brute_force([t.encode() for _, t in rows])))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_run_index"](spark, sf_dir).collect()} == repeats


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir):
    """Each stage's rows from the rows before it, by plain loops."""
    docs = table(spark, sf_dir, "documents")
    stages, before = Stages(spark), docs
    for name, stage in corpus_pipeline.STAGES:
        after = stages.write(stage(spark, before, sf_dir), "test")
        rows = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
        if name != "packing":
            assert after.dtypes == docs.dtypes
            kept = {r.doc_id: r.text for r in after.collect()}
        if name == "toxicity":
            lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), Stages(spark))
            finder = lexicon.automaton()
            clean = {d: t for d, t in rows for w, _, n in [toxicity.measures(finder, t)] if toxicity.score(lexicon, *(toxicity.np.array([float(v)]) for v in (w, n)))[0] < 0.5}
            assert kept == clean and len(kept) < len(rows)
        elif name == "line dedup":
            gone = lines_by_brute_force(rows)
            for n, (d, text) in enumerate(rows):
                lines = [x for k, x in enumerate(text.split("\n")) if (n, k) not in gone]
                if d in kept:
                    assert kept[d] == "\n".join(lines)
                else:
                    assert any((n, k) in gone for k in range(len(text.split("\n"))))
        elif name == "MinHash near-dedup":
            classes = classes_by_brute_force(rows)
            assert set(kept) == {rows[c][0] for c in classes}
        elif name == "benchmark decontamination":
            items = decontaminate.Items([(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()])
            hit = {d for d, t in rows for w in [decontaminate.item_words(t).tolist()] for i in items.words
                   if w and decontaminate.fit_distance(i.tolist(), w)[0] <= decontaminate.allowed(len(i))}
            assert set(kept) == {d for d, _ in rows} - hit
        else:
            assert {r.doc_id for r in after.collect()} == {d for d, _ in rows}
        before = after


def test_pipeline_takes_awkward_rows(spark, sf_dir):
    for rows in (AWKWARD, []):
        docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("mine") for n in ("score", "row", "class_id", "keeper", "n_lines")})
        for name, stage in corpus_pipeline.STAGES:
            after = Stages(spark).write(stage(spark, docs, sf_dir), "test")
            assert name == "packing" or after.columns == docs.columns
            docs = after
        # three near-equal texts are one, two NULL ids stay apart, equal empty texts are one
        assert docs.select("doc_id").distinct().count() == (7 if rows else 0)
