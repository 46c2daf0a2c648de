"""Exact dedup and line dedup against brute force, with the edge cases of their docstrings."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import exact_dedup, line_dedup, queries
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, name string, digest long, block int, n_lines int, d int, pos int"
LINES = ["  Shared Line Of Text ", "shared line of text", "short", "", "Only here, not elsewhere", "ÉTÉ À LA MER", "été à la mer", "x" * 12]
TEXTS = [
    (1, None), (2, ""), (3, "a"), (4, "a"), (5, "é" * 3000 + "x" * 2000), (6, "é" * 3000 + "x" * 2000), (7, "é" * 3000 + "x" * 1999 + "y"),
    (8, "y" * 4096), (9, "y" * 8192), (10, "y" * 8192), (11, "\n".join(LINES)), (12, "\n".join(reversed(LINES))), (12, "\n".join(reversed(LINES))),
    (13, "Shared line of text\r\nX" + "x" * 11), (None, "a"), (None, "shared line of text\nnull holds this one"), (14, "null holds this one\n"),
    (15, "x" * 12 + "\n" + "x" * 12), (16, "\n\n"), (17, "abc\n" * 70 + "shared line of text\n" + "def\n" * 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "n", 1, 2, 3, 4, 5) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_exact(rows, normalise=lambda t: t):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalise(t or "")].append(-1 if i is None else i)
    found = [
        (str(i), None if max(groups[key]) < 0 else max(groups[key]), len(groups[key]), hashlib.sha256(key.encode()).hexdigest())
        for i, t in rows for key in [normalise(t or "")]
    ]
    return sorted(found, key=str)


def as_exact(df):
    return sorted(((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [4096, 7])
def test_exact_dedup_equals_brute_force(docs, block_bytes):
    got = exact_dedup.exact_dedup(docs, block_bytes=block_bytes)
    assert as_exact(got) == brute_exact(TEXTS)
    kept = got.filter("kept").groupBy("text_sha256").count()
    assert kept.count() == len({t or "" for _, t in TEXTS}) and kept.filter("count <> 1").isEmpty()


def test_exact_dedup_survives_digest_collisions(docs):
    def weak(block, seed):  # the first round gives blocks of equal length one digest
        return F.octet_length(block).cast("long") if seed == 0 else exact_dedup.seeded_digest(block, seed)

    assert as_exact(exact_dedup.exact_dedup(docs, digest=weak, block_bytes=16)) == brute_exact(TEXTS)


def test_exact_dedup_normalises(docs):
    got = exact_dedup.exact_dedup(docs, normalise=lambda t: F.upper(t))
    assert as_exact(got) == brute_exact(TEXTS, lambda t: t.upper())


def brute_lines(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == order(i)]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("tasks", [None, 1, 50])
def test_line_dedup_equals_brute_force(docs, tasks):
    got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, tasks=tasks))
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got.collect()) == brute_lines(TEXTS)
    assert set(got.columns) == set(docs.columns) | {"n_dropped"}


def test_many_hot_lines_span_tasks(spark):
    """2,000 lines, each in more documents than a task has rows for: every document but the first loses all."""
    lines = "concat_ws('\\n', transform(sequence(0, 1999), i -> concat('a line that is everywhere ', i)))"
    docs = spark.range(40).selectExpr("id as doc_id", f"{lines} as text")
    marks = {r.doc_id: r for r in line_dedup.keep_bitmaps(docs, tasks=3000).select("doc_id", "n_lines", "n_dropped").collect()}
    assert {i: (r.n_lines, r.n_dropped) for i, r in marks.items()} == {i: (2000, 2000 if i else 0) for i in range(40)}


def test_bitmaps_are_sparse(docs):
    marks = {r.doc_id: r for r in line_dedup.keep_bitmaps(docs).collect()}
    assert marks[3].dropped_words == [] and marks[3].n_lines == 1
    assert [(w.word, w.mask) for w in marks[17].dropped_words] == [(2, 1 << 6)]  # line 70


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


def test_range_partitioned_stream(docs):
    plan = line_dedup.keep_bitmaps(docs)._jdf.queryExecution().executedPlan().toString()
    # the range-partitioned rows are checkpointed; what is left streams within a partition and line
    assert "hashpartitioning(__pid" in plan and "Window" in plan and "hashpartitioning(h1" not in plan


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    from tools.check_oracle import _rows

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    assert _rows(got) == _rows(want)
