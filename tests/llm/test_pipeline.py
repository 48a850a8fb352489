"""Each stage of the pipeline against a brute-force version on its own input."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm.test_near import brute_classes
from tokenloom.llm import pii, rules
from tokenloom.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Rows before and after every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs.collect())
    return out


def test_columns_are_those_of_documents(tables):
    for rows in tables[1:-1]:
        assert rows[0].__fields__ == tables[0][0].__fields__
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality(tables):
    want = {r.doc_id: judged[-1] for r in tables[0] if (judged := rules.judge(r.text))[6]}
    assert {r.doc_id: r.text for r in tables[1]} == want


def test_near_dedup(tables):
    kept = set(brute_classes([(r.doc_id, r.text) for r in tables[1]]).values())
    assert sorted(r.doc_id for r in tables[2]) == sorted(kept)


def test_personal_data(tables):
    assert {r.doc_id: r.text for r in tables[3]} == {r.doc_id: pii.redacted(r.text) for r in tables[2]}
    assert any("[EMAIL]" in r.text for r in tables[3])


def test_mix_repeats_or_cuts(tables):
    text = {r.doc_id: r.text for r in tables[3]}
    assert all(text[r.doc_id].startswith(r.text) for r in tables[4])


def test_encode(tables):
    library = Tokenizer.from_file(TOKENIZER)
    assert len(tables[5]) == len(tables[4])
    for r in tables[5]:
        assert r.input_ids == library.encode(r.text, add_special_tokens=False).ids


def test_run_gives_the_last_stage(spark, tables):
    digest = lambda rows: sorted(hashlib.md5(repr((r.doc_id, r.input_ids)).encode()).hexdigest() for r in rows)
    assert digest(pipeline.run(spark, SF).collect()) == digest(tables[-1])
