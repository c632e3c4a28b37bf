from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry
from tidemark.llm import mixing, neardup, paragraphs, queries


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The output of each stage as a table read again."""
    from tidemark.session import work_dir

    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = work_dir(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_names_and_columns(stages, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near duplicates", "substring dedup", "source mixing", "best-fit packing"]
    for docs in stages[:4]:
        assert docs.dtypes == documents.dtypes


def test_each_stage_follows_its_operator(stages, documents, spark, sf):
    rejected = {r["doc_id"] for r in queries.op1_string_kernel_toxicity(spark, sf).filter("score >= 0.3").collect()}
    ids = lambda docs: Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    assert ids(stages[0]) == Counter(d for d in ids(documents).elements() if d not in rejected)
    kept = {r["doc_id"] for r in neardup.near_duplicates(stages[0], 5, 80).filter("kept").collect()}
    assert set(ids(stages[1])) == kept
    assert ids(stages[2]) == ids(stages[1])
    assert paragraphs.repeated_passages(stages[1]).count() > 0 or stages[1].exceptAll(stages[2]).isEmpty()
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(stages[2]).collect()}
    copies = ids(stages[3])
    assert all(copies[d] * size == words for d, (size, words) in taken.items() if size)


def test_packed_tokens_are_those_of_the_mix(stages):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    want = Counter()
    for r in stages[3].collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            want[r["doc_id"], k, zlib.crc32(np.asarray(ids[at: at + 2048], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[4].collect()) == want


def test_registered(spark, sf):
    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


def test_an_empty_corpus(spark, documents, sf):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
