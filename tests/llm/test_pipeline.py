import inspect
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearback.llm import components, queries
from hearback.llm.common import workspace

from .conftest import EXTRA


def test_components_against_search(spark):
    import random

    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 560)]
    links += [(900, i) for i in range(901, 960)] + [(None, 3), (4, 4)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = components.components(spark.createDataFrame(links, "a long, b long"), workspace(spark)).collect()
    assert {r["node"]: r["root"] for r in got} == {n: find(n) for n in root if find(n) != n}
    assert components.components(spark.createDataFrame([], "a long, b long"), workspace(spark)).collect() == []


def test_every_stage_on_rough_rows(spark, rough, nothing, small, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (rough, nothing):
            out = stage(spark, docs, small)
            rows = out.collect()
            if stage is not corpus_pipeline.encode_stage:
                assert out.columns == docs.columns, name
                for c in EXTRA:
                    assert {r[c] for r in rows} <= {"clash"}
            if docs is nothing:
                assert rows == []


def test_the_run_is_its_stages_by_hand(spark, small):
    """Each stage's result against its query's rows and plain Python over the stage's own input."""
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    score = {r["doc_id"]: r["score"] for r in queries.QUERIES["op9_toxicity"](spark, small).collect()}
    stage1 = corpus_pipeline.toxicity_stage(spark, docs, small)
    assert sorted(r["doc_id"] for r in stage1.collect()) == sorted(i for i, s in score.items() if s < 0.5)
    path = workspace(spark).path("stage")
    stage1.write.parquet(path)
    stage1 = spark.read.parquet(path)
    from .test_simhash import grouped, plain

    prints = {r["doc_id"]: plain(r["text"]) for r in stage1.collect()}
    group = grouped(sorted(set(prints.values())))
    least = {}
    for i, p in prints.items():
        least[group[p]] = min(least.get(group[p], i), i)
    stage2 = corpus_pipeline.near_dedup_stage(spark, stage1, small)
    assert sorted(r["doc_id"] for r in stage2.collect()) == sorted(least.values())
    masked = corpus_pipeline.secrets_stage(spark, stage2, small)
    assert masked.count() == stage2.count()
    from .test_secrets import base

    kept = {r["doc_id"] for r in masked.collect()}
    assert all(not base(r["text"]) for r in masked.collect()) and kept == set(least.values())
    assert {r["doc_id"] for r in rows} <= kept


def test_stages_are_in_order():
    assert [s.__name__ for _, s in corpus_pipeline.STAGES] == ["toxicity_stage", "near_dedup_stage", "secrets_stage", "mix_stage", "encode_stage"]
    assert all(list(inspect.signature(s).parameters) == ["spark", "docs", "sf_dir"] for _, s in corpus_pipeline.STAGES)


def test_native_operators_run_no_python(spark, small):
    for name in ("chat", "secrets"):
        source = (Path(queries.__file__).parent / f"{name}.py").read_text()
        assert not any(word in source for word in ("mapIn", "pandas", "udf", ".rdd", "pyarrow"))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_queries_without_sql_return_every_document(spark, small, name):
    found = queries.QUERIES[name](spark, small)
    assert found.agg(F.count_distinct("doc_id")).first()[0] == spark.read.parquet(f"{small}/documents.parquet").count()
