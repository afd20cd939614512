"""The registered text queries on the small tables, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_documents import edits_to, fingerprint, normal, plain_components
from ticktide.llm import mixing
from ticktide.llm.queries import CHECKS, QUERIES


def test_mixing_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    expected = duck.execute(CHECKS["op4_mixing"])
    names = [c[0] for c in expected.description]
    found = QUERIES["op4_mixing"](spark, SMALL)
    assert sorted(names) == sorted(found.columns)
    assert sorted(repr(tuple(r[n] for n in names)) for r in found.collect()) == sorted(repr(tuple(r)) for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SMALL)
    rows = found.count()
    whole = {"op6_html_paths": "pages", **dict.fromkeys(
            ["op2_token_order", "op8_cgk_decontamination", "op12_hard_negatives", "op13_collocations"])}.get(name, "documents")
    assert rows == spark.read.parquet(f"{SMALL}/{whole}.parquet").count() if whole else rows > 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        kept[at] = docs.collect()
        if at < 4:
            assert docs.columns == columns
        ids = {r.doc_id for r in kept[at]} if at < 4 else None
        if at == 0:
            assert ids == {i for i, r in before.items() if re.search(r"[^\W\d_]", r.text or "")}
        if at == 1:
            root = plain_components({fingerprint(r.text) for r in before.values()})
            least = {}
            for i, r in before.items():
                least[root[fingerprint(r.text)]] = min(i, least.get(root[fingerprint(r.text)], i))
            assert ids == set(least.values()) and len(ids) == len(kept[at])
        if at == 2:
            items = [normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            dirty = {i for i, r in before.items() if any(
                set(item) & set(normal(r.text)) and edits_to(item, normal(r.text)) <= len(item) // 5 for item in items)}
            assert ids == set(before) - dirty
        if at == 3:
            rate = Counter({r.doc_id: r.copies for r in mixing.plan(spark.read.parquet(f"{tmp_path}/2")).collect()})
            assert Counter(r.doc_id for r in kept[at]) == +rate
    slots = [r.slot for r in kept[4]]
    assert sorted(slots) == list(range(len(slots)))
    assert {i for r in kept[4] for i in r.doc_ids} == {r.doc_id for r in kept[3]}
