"""The pipeline: each stage against brute force on what its predecessor left."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from starloom.llm import bpe, quality_rules
from tests.conftest import SF_SMALL
from tests.llm.test_dedup_ops import brute_lines
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_fingerprint, brute_roots

PROSE = " ".join(f"word{i} of some plain text" for i in range(60))


@pytest.fixture(scope="module")
def stages(spark):
    """[input, after stage 1, ...] on sf0.001 plus edge rows and a clashing column."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = [(9001, None, "en", "s", 0), (9002, "", None, None, 0), (9003, PROSE, "en", None, 1), (9003, PROSE, "en", None, 1), (None, PROSE + " end", "en", "src1", 2)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"n_words": F.lit("kept"), "row": F.lit(1)})
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF_SMALL).cache())
    return frames


def test_columns(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns and after.dtypes == before.dtypes
    assert stages[-1].columns[: len(stages[0].columns)] == stages[0].columns
    assert stages[-1].filter("n_words <> 'kept' OR row <> 1").isEmpty()


def test_rules(stages):
    kept = quality_rules.quality_rules(stages[0]).filter("kept")
    key = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    assert key(stages[1]) == key(kept)


def test_lines(stages):
    got = sorted((str(r.doc_id), r.text) for r in stages[2].collect())
    assert got == sorted((i, t) for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in stages[1].collect()]))
    assert stages[2].filter("n_chars <> char_length(text)").isEmpty()


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    roots = brute_roots(sorted({brute_fingerprint(t) for _, t in rows}), 2)
    first = {}
    for i, t in rows:
        group = roots[brute_fingerprint(t)]
        first[group] = min(first.get(group, (True, 0)), (i is None, i or 0))
    got = Counter((r.doc_id is None, r.doc_id or 0) for r in stages[3].collect())
    assert got == Counter(first.values())


def test_mix(stages):
    before, after = stages[3].collect(), stages[4].collect()
    words = {r.doc_id: r.text.encode().split() for r in before}
    source = {r.doc_id: r.source for r in before}
    sizes, taken, by_doc = Counter(), Counter(), Counter()
    for i, w in words.items():
        sizes[source[i]] += len(w)
    for r in after:
        got = r.text.encode().split()
        assert not Counter(got) - Counter(words[r.doc_id])  # one epoch takes no word twice
        taken[r.source] += len(got)
        by_doc[r.doc_id] += len(got)
        assert r.n_chars == len(r.text)
    assert all(n <= 3 * len(words[i]) for i, n in by_doc.items())
    for s, want in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= 2 * corpus_pipeline.MIX_BLOCK_WORDS


def test_encoding(stages):
    ranks = bpe.load_ranks(public_tokenizers.path(corpus_pipeline.TOKENIZER)).ranks
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = Counter(r.text for r in stages[4].collect())
    for r in stages[5].collect():
        assert bytes(r.ids) == np.array(own.encode_ordinary(r.text), "<u4").tobytes() and r.n_tokens == len(r.ids) // 4
        texts[r.text] -= 1
    assert not any(texts.values())


def test_run_is_repeatable(spark):
    run = __spark_entry__.queries()["pipeline"]
    digests = [sorted(hashlib.sha256(bytes(r.ids)).hexdigest() + str(r.doc_id) for r in run(spark, SF_SMALL).collect()) for _ in range(2)]
    assert digests[0] == digests[1] and digests[0]


def test_rows_equal_in_id_and_text(spark):
    """Rows that differ in source and language only are not mixed up, in any stage."""
    long_text = PROSE + " and more" * 20_000
    rows = [(1, PROSE, "de", "b", 9), (1, PROSE, "en", "a", 9), (1, PROSE, "en", "a", 9), (2, long_text, "en", "c", 9), (2, long_text, "fr", "c", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plain = sorted((r.doc_id, r.lang, r.source) for r in docs.collect())
    key = lambda df: sorted((r.doc_id, r.lang, r.source) for r in df.collect())
    assert set(key(corpus_pipeline.keep_good(spark, docs, SF_SMALL))) <= set(plain)
    assert key(corpus_pipeline.drop_lines(spark, docs, SF_SMALL)) == plain
    kept = {tuple(key(corpus_pipeline.drop_near_copies(spark, docs.repartition(n), SF_SMALL))) for n in (1, 3, 7)}
    assert len(kept) == 1 and [k[0] for k in kept.pop()] == [1, 2]
    mixed = corpus_pipeline.mix_sources(spark, docs, SF_SMALL).collect()
    assert {(r.doc_id, r.lang, r.source) for r in mixed} <= set(plain)
    words = Counter()
    for r in mixed:
        words[r.source] += len(r.text.split())
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(text.split())
    for s, want in brute_targets(dict(sizes)).items():
        assert abs(words[s] - want) <= 4 * corpus_pipeline.MIX_BLOCK_WORDS


def test_empty_table(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0
