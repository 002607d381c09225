"""The pipeline stage by stage against brute force, on the smallest tables."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strikelake.llm import mixing, quality, secrets

from . import brute

SF = os.environ.get("TEST_PIPELINE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents and the written output of every stage."""
    if not os.path.exists(f"{SF}/documents.parquet"):
        pytest.skip("no test tables")
    frames, folder = [spark.read.parquet(f"{SF}/documents.parquet")], tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{folder}/{i}")
        frames.append(spark.read.parquet(f"{folder}/{i}"))
    return frames


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(sorted(f.dtypes) == sorted(stages[0].dtypes) for f in stages[1:-1])


def test_every_stage_equals_brute_force(spark, stages):
    rows = [{r["doc_id"]: r for r in f.collect()} for f in stages]
    texts = [{i: r["text"] for i, r in x.items()} for x in rows[:5]]
    model = quality.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality.scored(stages[0], model).collect()}
    assert set(rows[1]) == {i for i, s in scores.items() if s >= 0.3}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert {i for i, q in labels.items() if q == 1} - set(rows[1]) == set()

    component = brute.near_duplicates(texts[1])
    assert set(rows[2]) == set(component.values())

    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = sorted(texts[2])
    hit = brute.contamination([texts[2][i] for i in ids], bench)
    assert set(rows[3]) == {i for i, h in zip(ids, hit) if not h[1]}

    assert set(rows[4]) == set(rows[3])
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(stages[3]).collect()}
    for i, text in texts[3].items():
        spans = sorted((s, e) for s, _, e in brute.base_spans(text))
        spans += [tuple(map(int, x.split(":")[1:])) for x in found[i].split(",") if x.startswith("random")]
        covered = {p for s, e in spans for p in range(s, e)}
        kept = "".join("\0" if p in covered else c for p, c in enumerate(text or ""))
        assert re.sub("\0+", secrets.MASK, kept) == re.sub(f"({re.escape(secrets.MASK)})+", secrets.MASK, rows[4][i]["text"])
        assert not brute.base_spans(rows[4][i]["text"])

    mix = {i: r for i, r in rows[5].items()}
    assert set(mix) == set(rows[4])
    assert all(mix[i]["size"] == len(brute.SPACED.findall(texts[4][i])) for i in mix)
    by_source = {}
    for i, r in mix.items():
        by_source.setdefault(rows[4][i]["source"], []).append(r)
    for own in by_source.values():
        slack = mixing.BLOCK_WORDS * (1 + len({r["shard"] for r in own}))
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= slack


def test_stages_on_empty_documents(spark, stages):
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, stages[i].limit(0), SF).count() == 0


def test_extra_columns_and_nulls_pass(spark, stages):
    docs = stages[0].withColumns({c: F.lit("x") for c in ("n_words", "id", "score", "_stay", "held", "band")})
    odd = docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")})
    docs = docs.unionByName(odd).unionByName(docs.limit(5))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert sorted(out.dtypes) == sorted(docs.dtypes) and out.count() > 0
