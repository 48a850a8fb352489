import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tokenloom.llm import bpe
from tokenloom.llm.queries import TOKENIZER

LIBRARY = Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def agree(library, texts):
    own = bpe.load(TOKENIZER)
    for ids, text in zip(own.encode(texts), texts, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids).decode() == library.decode(want, skip_special_tokens=False) == text





@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    agree(LIBRARY, texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" aab\n\tb'stéÖ1!.<|>×÷_ll日　", max_size=80))
def test_words_white_space_and_marks(text):
    agree(LIBRARY, [text])


def test_added_tokens_and_runs(library):
    agree(library, ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "a" * 5000, "ab" * 3000, "", " \n "])


def test_a_full_store_is_forgotten(library):
    own = bpe.Bpe(TOKENIZER, most_words=3)
    for text in ("one two three four", "five six seven", "one two"):
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_tables(spark, library):
    rows = [(1, "Hello there", "x"), (1, "Hello there", "x"), (None, None, "y"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    ids = bpe.encode(docs, TOKENIZER).collect()
    want = library.encode("Hello there", add_special_tokens=False).ids
    assert sorted(len(r.input_ids) for r in ids) == [0, 0, len(want), len(want)]
    assert [r.input_ids for r in ids if r.doc_id == 1] == [want] * 2
    back = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).collect()
    assert sorted(r.text for r in back) == ["", "", "Hello there", "Hello there"]
    trip = {r.doc_id: r for r in bpe.round_trip(docs, TOKENIZER).collect()}
    assert trip[1].n_tokens == len(want)
    assert trip[1].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
    assert trip[None].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip(docs.limit(0), TOKENIZER).count() == 0
