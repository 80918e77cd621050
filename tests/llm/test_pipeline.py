"""The pipeline's stages against brute force, each on its own input."""

import hashlib

import pytest

import corpus_pipeline as P
from assetweave.llm import queries

from . import brute as B

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage but the last, and the result."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.collect())
    for _, stage in P.STAGES[:-1]:
        rows = stage(spark, docs, SF).collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    return out, {r["doc_id"]: r for r in P.STAGES[-1][1](spark, docs, SF).collect()}


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_stages(spark, stages):
    (all_docs, clean, lines, single, decontaminated), result = stages
    scores = {r["doc_id"]: r["score"] for r in queries.op3_toxicity(spark, SF).collect()}
    assert {r["doc_id"] for r in clean} == {i for i, x in scores.items() if x < 0.7}
    want = B.line_dedup(texts(clean))
    assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in lines} == {i: x[2] for i, x in want.items()}
    groups = B.jaccard(texts(lines), 5, 80)
    assert {r["doc_id"] for r in single} == {i for i, (_, c) in groups.items() if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = B.contamination(texts(single), items)
    assert {r["doc_id"] for r in decontaminated} == {i for i, x in bad.items() if not x[-1]}
    assert len(all_docs) > len(clean) and len(lines) >= len(single) > 0
    codes = B.sentencepiece(texts(decontaminated), queries.tokenizer_file("piece_bpe_32k.model"))
    assert {i: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for i, r in result.items()} == codes


def test_run_equals_its_stages(spark, stages):
    assert {r["doc_id"]: r["ids_sha256"] for r in P.run(spark, SF).collect()} == {i: r["ids_sha256"] for i, r in stages[1].items()}
