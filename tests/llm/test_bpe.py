"""BPE against the reference tokenizer of the vocabulary, both forms of the fold, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from starloom.llm import bpe, queries
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", "a", "Hello  world!\n\n", "don't we'll 'S 's", "naïve café — ça va?", "中文字符混合 text", "\u0000\u001c\u0085   x", "🙂🙂 ok",
    "a" * 3000, "-" * 2500, "<|endoftext|>", " \t\n" * 40, "١٢٣ ½ x²", "word " * 50,
]


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH).ranks, special_tokens={})


def fuzz(n, seed=0):
    rng = random.Random(seed)
    chars = [chr(c) for c in (9, 10, 13, 28, 32, 32, 32, 33, 39, 45, 48, 65, 97, 101, 115, 116, 0x85, 0xA0, 0xE9, 0x301, 0x660, 0x1680, 0x200B, 0x3000, 0x4E2D, 0x1F600)]
    return ["".join(rng.choices(chars, k=rng.randint(0, 60))) for _ in range(n)]


def test_encoder_equals_the_tokenizer(oracle, monkeypatch):
    rng = random.Random(5)
    texts = TEXTS + fuzz(1000) + ["".join(rng.choices([chr(c) for c in (*range(128), 32, 32, 39, 39, 115, 116)], k=rng.randint(0, 60))) for _ in range(1000)]
    want = [np.array(x, "<u4").tobytes() for x in oracle.encode_ordinary_batch(texts)]
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN, cache_words=50)
    assert encoder.encode(texts) == want
    monkeypatch.setattr(bpe, "TEXT_WORDS", 7)  # texts in pieces
    assert bpe.Encoder(PATH, public_tokenizers.PATTERN, cache_words=5).encode(texts) == want
    ranks = bpe.load_ranks(PATH)
    words = [w.encode() for t in TEXTS[:9] for w in encoder.find(t)]
    assert [ranks.encode_long(w) for w in words] == ranks.encode_many(words)


def test_ascii_form():
    assert bpe.ascii_form(r"'s| ?\p{L}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)") == r"'s| ?[A-Za-z]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)"
    assert bpe.ascii_form(r"\p{Lu}+") is None and bpe.ascii_form(r"[\]\p{N}]\p{N}") == r"[\]0-9][0-9]"


def test_documents_round_trip(spark, oracle):
    rows = [(i, t, 9) for i, t in enumerate(TEXTS)] + [(None, None, 9), (3, TEXTS[3], 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN).withColumn("back", bpe.decode(F.col("ids"), PATH)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.back).decode() == (r.text or "")
        ids = oracle.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids) and bytes(r.ids) == np.array(ids, "<u4").tobytes()
    assert bpe.encode_documents(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_higher_order_fold_equals_the_batch_form(spark, oracle):
    texts = [t[:200] for t in TEXTS] + fuzz(20, 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.encode_documents_by_join(spark, docs, PATH, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.ids for r in got} == {i: oracle.encode_ordinary(t) for i, t in enumerate(texts) if t}


def test_query(spark, oracle):
    import hashlib

    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id").text
    for r in queries.op8_byte_bpe(spark, SF_SMALL).collect():
        ids = oracle.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
