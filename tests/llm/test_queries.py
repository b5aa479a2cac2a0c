"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from conftest import TESTDATA

import corpus_pipeline
from tidemark.llm import token_files
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

from .test_small import lowered, plain_components, texts_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(TESTDATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", ORACLES)
def test_query_like_its_sql(spark, duck, name):
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    found = QUERIES[name](spark, TESTDATA)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(*columns).collect())) == Counter(answer.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, TESTDATA).count() > 0


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for file in (root / "tidemark").rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "llm" not in file.read_text()
    assert "corpus_pipeline" in sys.modules


def test_pipeline_stages(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    first = docs.columns
    names, results = [n for n, _ in corpus_pipeline.STAGES], [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(corpus_pipeline.settle(stage(spark, results[-1], TESTDATA)))
    assert names == ["language", "near duplicates", "decontamination", "mixing", "token files"]
    assert all(r.columns == first for r in results[:-1])
    started, spoken, single, clean, mixed, last = results
    assert spoken.count() >= 0.98 * started.count()
    components = plain_components(texts_of(spoken))
    assert sorted(i for i, _ in texts_of(single)) == sorted({c for _, c in components.values()})
    items = [b" " + b" ".join(lowered(r["text"])) + b" " for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    held = {i for i, t in texts_of(single) if any(item in b" " + b" ".join(lowered(t)) + b" " for item in items)}
    assert held and not held & {i for i, _ in texts_of(clean)}
    assert set(texts_of(mixed)) <= set(texts_of(clean)) and max(Counter(texts_of(mixed)).values()) <= 3
    plain, expected = Tokenizer.from_file(token_files.tokenizer_path()), Counter()
    for i, text in texts_of(mixed):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        expected[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in last.collect()) == expected
    whole = corpus_pipeline.run(spark, TESTDATA)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, last.collect()))
