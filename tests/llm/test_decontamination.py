"""Benchmark decontamination against a scan of every window at every word."""

import random
import re

import duckdb
import pytest

from starloom.llm import decontamination as dc
from starloom.llm import queries
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(doc, items, size=10):
    w, hit, seen = words(doc), set(), set()
    for item_id, text in items:
        v = words(text)
        for at in range(max(1, len(v) - size + 1) if v else 0):
            window = v[at : at + size]
            for i in range(len(w) - len(window) + 1):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    seen.add("" if item_id is None else str(item_id))
    return len(w), hit, sorted(seen)


def check(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string, items string, k1 string")
    b = spark.createDataFrame(items, "item_id long, text string, words string")
    got = sorted(dc.decontaminate(d, b, **options).collect(), key=str)
    want = []
    for doc_id, text, *_ in docs:
        n, hit, seen = brute(text, [i[:2] for i in items])
        want.append((doc_id, n, sorted(hit), seen))
    found = [(r.doc_id, r.n_words, [s.start + i for s in r.spans for i in range(s.length)], r["items"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert all(r.n_hit == sum(s.length for s in r.spans) for r in got)
    return got


def corpus(seed, vocabulary, n_docs=60):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([1, 2, 3, 4, 9, 10, 11, 25]))), "x") for i in range(15)]
    docs = []
    for d in range(n_docs):
        w = some(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            v = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(v) - 10))
            at = rng.randint(0, len(w))
            w[at:at] = v[a : a + rng.randint(5, 12)]
        docs.append((d, rng.choice([" ", ", ", "\n- "]).join(x.upper() if rng.random() < 0.2 else x for x in w), "x", "y"))
    return docs, items


@pytest.mark.parametrize("seed,vocabulary", [(1, ["a", "b"]), (2, ["a", "b", "é", "d1", "e"]), (3, [f"w{i}" for i in range(300)])])
def test_against_brute_force(spark, seed, vocabulary):
    check(spark, *corpus(seed, vocabulary))


def test_small_segments_and_blocks(spark, monkeypatch):
    """Windows across segments, and shingles and windows in many broadcast blocks."""
    monkeypatch.setattr(dc, "SEGMENT", 8)
    docs, items = corpus(4, ["a", "b", "c"], 25)
    check(spark, docs, items, block_rows=20)


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    items = [
        (1, passage, "x"), (2, passage, "x"), (2, "other words entirely", "x"), (3, None, "x"), (4, "...", "x"), (5, "Solo", "x"),
        (None, "two words", "x"), (6, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 new", "x"),
    ]
    docs = [
        (1, None, "a", "b"), (2, "", "a", "b"), (3, "!?", "a", "b"), (4, passage, "a", "b"), (4, passage, "a", "b"), (4, passage + " x", "a", "b"),
        (None, "so " + passage.upper(), "a", "b"), (5, " ".join(f"p{i}" for i in range(9)), "a", "b"), (6, "solo; two-words\x00two words", "a", "b"),
        (7, "É é " * 3000 + passage + " solo" * 4000, "a", "b"), (8, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12 NEW", "a", "b"),
    ]
    got = check(spark, docs, items)
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].n_hit == 14 and by_id[4]["items"] == ["1", "2", "6"]
    assert by_id[7].n_hit == 4014 and by_id[6]["items"] == ["", "5"]


def test_words_differ_as_they_should(spark):
    """Only A-Z are folded: all other characters of one to four bytes stay apart."""
    chars = [chr(c) for c in {*range(0x80, 0x250), *range(0x2C00, 0x2C60), *range(0x3000, 0x3100), 0xD7, 0xDF, 0x1F600, 0x1F620, 0x10400, 0x10428, 0xFF21, 0xFF41}]
    frame = spark.createDataFrame([(i, f"-A{c}b{c}{c}z;Q") for i, c in enumerate(chars)], "i long, t string")
    got = [tuple(r.w) for r in dc.split_words(frame, "t").collect()]
    assert len(set(got)) == len(chars) and all(len(w) == 2 and w[1] == "q" for w in got)
    assert [r.w for r in dc.split_words(spark.createDataFrame([("ÀB ab\x7fÀb",)], "t string"), "t").collect()][0][0] == dc.split_words(
        spark.createDataFrame([("Àb",)], "t string"), "t").first().w[0]


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a b c", "x")]) == []
    got = check(spark, [(1, "a b c", "x", "y"), (None, None, None, None)], [])
    assert [(r.n_hit, r["items"], r.spans) for r in got] == [(0, [], [])] * 2


def test_prefix_is_the_rarest_shingle(spark):
    """A window joins by one shingle, the one that the fewest document words start."""
    common, rare = "a b c", "q r s"
    items = spark.createDataFrame([(1, f"{common} {rare}")], "item_id long, text string")
    windows = dc.item_windows(items).selectExpr("item_id", "words", "transform(sequence(1, size(words) - 2), i -> slice(words, i, 3)) as cut")
    shingles = windows.selectExpr("explode(cut) as shingle").distinct().selectExpr("shingle", "xxhash64(shingle) as sid")
    docs = spark.createDataFrame([(i, f"{common} x" + (f" {common} {rare}" if i == 3 else "")) for i in range(9)], "doc_id long, text string")
    matches = dc.shingle_matches(docs, shingles, [3]).filter("sid is not null")
    got = dc.prefixes(windows, shingles, matches.groupBy("sid").agg({"*": "count"}).withColumnRenamed("count(1)", "n")).collect()
    assert len(got) == 1 and got[0].size == 6 and got[0].place > 0
    counts = {r.sid: r["count"] for r in matches.groupBy("sid").count().collect()}
    assert counts[got[0].prefix] == 1 and max(counts.values()) == 10


def test_no_python_in_the_plan(spark):
    plan = queries.op12_decontamination(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_query_equals_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE_SQL["op12_decontamination"]).df()
    got = queries.op12_decontamination(spark, SF_SMALL).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert got["contaminated"].sum() > 0
