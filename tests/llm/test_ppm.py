"""PPM: the trie against a plain implementation, counts and base scores against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ppm, queries
from tests.conftest import SF_SMALL

TRAIN = ["abracadabra abra", "Abra cadabra\nabba", "", None, "été à la plage", "aaaa aaaa aaaa b"]
TEXTS = TRAIN + ["brac abba zebra", "\x00\x7f", " ", "été", "AAAA"]


def plain_tables(texts, order):
    """context -> symbol -> count, for contexts of 0..order bytes."""
    tables = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        data = bytes([ppm.PAD]) * order + (t or "").encode().lower() + bytes([ppm.END])
        for i in range(order, len(data)):
            for j in range(order + 1):
                tables[j][data[i - j : i]][data[i]] += 1
    return tables


def plain_log(tables, share, context, symbol):
    """log10 probability of one symbol, by the rules of the module's docstring."""
    total = sum(tables[0][b""].values())
    logs, excluded, order = 0.0, set(), len(tables) - 1
    for j in range(order, -1, -1):
        counts = tables[j].get(context[order - j :], Counter())
        stored = {s: c for s, c in counts.items() if c >= share * total}
        if not stored:
            continue
        pruned = sum(counts.values()) - sum(stored.values())
        fresh = {s: c for s, c in stored.items() if s not in excluded}
        if fresh:
            whole = sum(fresh.values()) + pruned
            if symbol in fresh:
                return logs + math.log10((fresh[symbol] - 0.5) / whole)
            logs += math.log10((len(fresh) / 2 + pruned) / whole)
        excluded |= set(stored)
    return logs - math.log10(ppm.SYMBOLS - len(excluded))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)], "doc_id long, text string, row int, word int, n int")


@pytest.mark.parametrize("order,share", [(3, 2.0**-22), (2, 0.03), (0, 0.01)])
def test_scores_equal_the_plain_model(spark, order, share):
    model = ppm.train(frame(spark, TRAIN), order=order, share=share)
    tables = plain_tables(TRAIN, order)
    got = {r.doc_id: r for r in ppm.score(frame(spark, TEXTS), model).collect()}
    for i, t in enumerate(TEXTS):
        data = bytes([ppm.PAD]) * order + (t or "").encode().lower() + bytes([ppm.END])
        want = sum(plain_log(tables, share, data[k - order : k], data[k]) for k in range(order, len(data)))
        assert got[i].score == pytest.approx(want, rel=1e-5), t


@pytest.mark.parametrize("order,share,common_share", [(6, 0.0, 2.0), (4, 0.0, 0.02), (2, 0.03, 2.0), (0, 0.0, 2.0)])
def test_joined_grams_score_as_those_in_memory(spark, order, share, common_share):
    model = ppm.train(frame(spark, TRAIN), order=order, share=share, common_share=common_share)
    tables = plain_tables(TRAIN, order)
    got = {r.doc_id: r.score for r in ppm.score(frame(spark, TEXTS), model).collect()}
    for i, t in enumerate(TEXTS):
        data = bytes([ppm.PAD]) * order + (t or "").encode().lower() + bytes([ppm.END])
        assert got[i] == pytest.approx(sum(plain_log(tables, share, data[k - order : k], data[k]) for k in range(order, len(data))), rel=1e-5), t


def test_rare_grams_are_kept_among_much_other_text(spark):
    """With 20 MB of one character beside it, each gram of the other texts is below 2^-22 of all positions."""
    order, size = 6, 20_000_000
    filler = spark.range(1).select(F.lit(-1).alias("doc_id"), F.expr(f"repeat('~', {size})").alias("text"))
    model = ppm.train(frame(spark, TRAIN).select("doc_id", "text").union(filler))
    tables = plain_tables([*TRAIN, "~" * order], order)
    for j in range(order + 1):  # each further character is one more of the same gram
        tables[j][b"~" * j][ord("~")] += size - order
    for r in ppm.score(frame(spark, TEXTS), model).collect():
        data = bytes([ppm.PAD]) * order + (TEXTS[r.doc_id] or "").encode().lower() + bytes([ppm.END])
        assert r.score == pytest.approx(sum(plain_log(tables, 0, data[k - order : k], data[k]) for k in range(order, len(data))), rel=1e-5)


def test_probabilities_sum_to_one(spark):
    model = ppm.train(frame(spark, TRAIN), order=3, share=0.004)
    scorer = ppm.Scorer(model.levels)
    for context in (b"\xff\xff\xff", b"abr", b"zzz", b"a a", b"\xc3\xa9t"):
        code = (int.from_bytes(context, "big") << 8) | np.arange(ppm.SYMBOLS)
        assert np.exp(scorer.log_probability(code)).sum() == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("head_share", [2.0**-20, 0.2, 2.0])
def test_base_score_equals_brute_force(spark, head_share):
    model = ppm.train(frame(spark, TRAIN), head_share=head_share)
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for t in TRAIN for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    assert (model.tokens, model.distinct) == (n, v)
    for r in ppm.score(frame(spark, TEXTS), model).collect():
        words = tokens(TEXTS[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(words), sum(counts[w] > 0 for w in words))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))


def test_long_texts_in_pieces(monkeypatch):
    datas = [b"abc " * 50, b"", b"x" * 500, b"end"]
    whole = [(n.tolist(), c.tolist()) for n, c in ppm.coded(datas, 3)]
    monkeypatch.setattr(ppm, "_CHUNK", 64)
    cut = list(ppm.coded(datas, 3))
    both = lambda parts: sorted((a, b) for n, c in parts for a, b in zip(n, c))
    assert both([(n.tolist(), c.tolist()) for n, c in cut]) == both(whole) and len(cut) > 4
    assert [w for part in ppm.word_lists(b"ab cd\n" * 300) for w in part] == (b"ab cd\n" * 300).split()


def test_index_finds_all_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 56, 5000))
    index = ppm._Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all() and (index.find(keys[:-1] + 1) == np.where(np.isin(keys[:-1] + 1, keys), np.arange(1, len(keys)), -1)).all()
    assert (ppm._Index(np.zeros(0, np.int64)).find(np.arange(5)) == -1).all()


def test_without_training_rows_and_without_rows(spark):
    model = ppm.train(frame(spark, TRAIN).limit(0))
    got = {r.doc_id: r for r in ppm.score(frame(spark, ["ab", None]), model).collect()}
    assert got[0].score == pytest.approx(-3 * math.log10(ppm.SYMBOLS)) and got[0].n_known == 0 and got[1].n_tokens == 1
    assert ppm.score(frame(spark, TRAIN).limit(0), model).count() == 0


def test_query(spark):
    got = queries.op2_ppm_scoring(spark, SF_SMALL).toPandas().set_index("doc_id")
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id").text
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in text.index}
    assert got.held_out.to_dict() == held and len(got) == len(text) and (got.score < 0).all()
    size = text.str.encode("utf-8").str.len()
    known, new = (sum(got.score[i] for i in held if held[i] == h) / sum(size[i] for i in held if held[i] == h) for h in (False, True))
    assert known > new > -math.log10(20)  # far better than uniform bytes on unseen texts, better still on seen ones
    again = queries.op2_ppm_scoring(spark, SF_SMALL).toPandas().set_index("doc_id")
    assert again.score.sort_index().values == pytest.approx(got.score.sort_index().values)


def test_held_out_texts_are_not_learnt(spark):
    docs = spark.createDataFrame([(0, "seen words"), (1, "qqqq qqqq")], "doc_id long, text string")
    model = ppm.train(docs.filter(F.col("doc_id") == 0))
    assert b"qqqq" not in model.head and ord("q") not in model.levels[0].grams
