"""Periodic runs: against a search of every period, whole texts, the query's rewriting and digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import queries, runs
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(w, min_words=12):
    first = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            start = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i > start and i + p - start >= 2 * p:
                first.setdefault((start, i + p), p)  # the smallest period of a stretch comes first
            i += i == start
    return sorted((s, e - s, p) for (s, e), p in first.items() if e - s >= max(min_words, 2 * p))


def brute_collapsed(w, found):
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in dropped)


def analysed(sample, min_words=12):
    parts = runs._analysed(pa.array(sample, pa.string()), min_words)
    return [dict(zip(("n_words", "runs", "collapsed"), row)) for row in zip(*(p.to_pylist() for p in parts))]


def texts(seed, count=300):
    rng = random.Random(seed)
    out = [None, "", " \n\t", "a", "a a", " a" * 40, "a b " * 30 + "c", ("x y z " * 5 + "q ") * 4, "É\x1cÉ \xa0 " * 20, "a\x0bb\x0ca\x0db " * 9]
    fib = ["a", "a b"]
    for _ in range(9):
        fib.append(fib[-1] + " " + fib[-2])
    out += fib
    for _ in range(count):
        letters = "abcdefghijklmnopqrst"[: rng.choice([1, 2, 3, 5, 20])]
        w = [rng.choice(letters) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(w))
            p = rng.randint(1, max(1, (len(w) - a) // 2))
            for i in range(a + p, min(len(w), a + p + rng.randint(0, len(w)))):
                w[i] = w[i - p]
        out.append(rng.choice([" ", "\n", "\t "]).join(w))
    return out


@pytest.mark.parametrize("min_words", [9, 10, 12, 30])
def test_all_runs_of_any_text(min_words):
    sample = texts(min_words)
    found = analysed(sample, min_words)
    for text, got in zip(sample, found):
        w = WORD.findall(text or "")
        want = brute_runs(w, min_words)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want
        assert got["collapsed"] == brute_collapsed(w, want) and got["n_words"] == len(w)


def test_each_text_has_its_own_grammar():
    """Neighbouring texts of a chunk, and any chunk size, give the same runs."""
    sample = texts(99, 60)
    whole = analysed(sample)
    alone = [analysed([t])[0] for t in sample]
    assert whole == alone


def test_grammar_is_re_pair():
    """No pair is left twice, the rules' places spell the same words, and the nodes nest."""
    rng = random.Random(5)
    ids = np.array([rng.randrange(3) for _ in range(400)])
    grammar = runs.Grammar(ids, np.zeros(len(ids), np.int64))
    bounds = np.array([0, len(ids)])
    ends = np.append(np.flatnonzero(grammar.heads), len(ids))
    symbols = [tuple(ids[a:b]) for a, b in zip(ends, ends[1:])]
    pairs = [*zip(symbols, symbols[1:])]
    for pair in set(pairs):
        at = [i for i, p in enumerate(pairs) if p == pair]
        assert all(b == a + 1 for a, b in zip(at, at[1:])) and len(at) <= 2  # overlapping only
    low, middle, high = grammar.nodes(bounds)
    assert (low < middle).all() and (middle < high).all()
    rule, place = (np.concatenate(c) for c in zip(*grammar.places))
    for r, p in zip(rule, place):
        assert list(ids[low[r] : high[r]]) == list(ids[p : p + high[r] - low[r]])
    spans = sorted(zip(low[grammar.count :], high[grammar.count :]))
    assert all(b[0] >= a[1] or b[1] <= a[1] or b[0] == a[0] for i, a in enumerate(spans) for b in spans[i + 1 :])


def test_very_long_texts():
    n = 200_000
    long = [" ".join(["a"] * n), " ".join(str(i) for i in range(n // 4)) + " " + " ".join(str(i) for i in range(n // 4))]
    found = analysed(long)
    assert found[0]["runs"] == [{"start": 0, "length": n, "period": 1}] and found[0]["collapsed"] == "a"
    assert found[1]["runs"] == [{"start": 0, "length": n // 2, "period": n // 4}]


def test_a_block_of_pairs_may_be_small(monkeypatch):
    sample = texts(3, 40)
    want = analysed(sample)
    monkeypatch.setattr(runs, "_PAIRS", 7)
    assert analysed(sample) == want


def test_on_frames(spark):
    rows = [(1, "a b " * 10, "x"), (1, "a b " * 10, "x"), (None, None, None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = sorted(runs.detect_runs(docs).collect(), key=str)
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (1, 20, [(0, 20, 2)], "a b"), (1, 20, [(0, 20, 2)], "a b"), (2, 0, [], ""), (None, 0, [], ""),
    ]
    assert runs.detect_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="min_words"):
        runs.detect_runs(docs, min_words=8)


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    rewritten = 0
    for d in docs:
        w = WORD.findall(d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            rewritten += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue  # every period of a long text takes too long here
        found = brute_runs(w)
        r = got[d.doc_id]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, found).encode()).hexdigest()
    assert rewritten > 5
