"""Mixing: targets, permutations, packing and the drawn mix."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing, queries
from tests.conftest import SF_SMALL


def brute_targets(sizes, weights=(5, 2, 1), limit=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(limit * sizes[s] for s in stopped)
        open_ = [s for s in order if s not in stopped]
        if not open_:
            break
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if share * w[s] > limit * sizes[s]}
        if not over:
            break
        stopped |= over
    return {s: float(limit * sizes[s]) if s in stopped else share * w[s] for s in order}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 257, 5000])
def test_permutations(spark, n):
    frame = spark.range(n).select(*[mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(k)).alias(f"p{k}") for k in (1, 2)]).toPandas()
    assert sorted(frame.p1) == sorted(frame.p2) == list(range(n))
    if n > 60:
        assert (frame.p1 != frame.p2).any() and (frame.p1 != frame.index).any()


def test_targets(spark):
    sizes = {"é": 10, "a": 1000, "b": 3, None: 50, "Z": 0, "c": 7, "ab": 400, "\U0001f600": 5}
    got = mixing.mix_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), block_words=4).collect()
    want = brute_targets(sizes)
    assert {r.source: r.target for r in got} == pytest.approx(want)
    assert all(r.slots <= 3 * r.blocks for r in got)
    assert [r.source for r in sorted(got, key=lambda r: r.sid)] == ["Z", "a", "ab", "b", "c", "é", "\U0001f600", None]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(1 + i * 37 % 150)), ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(200)]
    rows += [(500, None, "a"), (501, "", "b"), (502, " \n ", "z"), (503, "  lead  and\ttrail \n", "b"), (7, rows[7][1], rows[7][2]), (None, "null id here", "a")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, row int")


def test_mix_reaches_its_targets(spark, docs):
    sized = mixing.measured(docs, block_words=16)
    mixed = mixing.mix(sized, block_words=16, shard_slots=32).toPandas()
    table = sized.toPandas().astype({"source": object})
    table["source"] = table["source"].where(table["source"].notna(), None)
    assert len(table) == docs.count()
    # every slot of every shard is filled once, with one whole block of one source
    slots = mixed.groupby(["shard", "slot"])
    assert (slots[["epoch", "block"]].nunique() == 1).all().all()
    assert all(sorted(s.unique()) == list(range(len(s.unique()))) for _, s in mixed.groupby("shard").slot)
    assert slots.n_words.sum().max() == 16
    sizes, targets = Counter(), {}
    for r in table.itertuples():
        sizes[r.source] += r.size_ if hasattr(r, "size_") else table.at[r.Index, "size"]
        targets[r.source] = r.target
    assert targets == pytest.approx(brute_targets(dict(sizes)))
    taken = mixed.groupby("row").n_words.sum()
    by_source = defaultdict(int)
    for r in table.itertuples():
        words = int(taken.get(r.row, 0))
        by_source[r.source] += words
        assert words <= 3 * table.at[r.Index, "size"]
    for s, want in targets.items():
        assert abs(by_source[s] - want) <= 32, (s, by_source[s], want)
    again = mixing.mix(mixing.measured(docs, block_words=16), block_words=16, shard_slots=32).toPandas()
    key = ["shard", "slot", "block", "doc_id", "first_word", "n_words"]
    assert again.sort_values(key)[key].reset_index(drop=True).equals(mixed.sort_values(key)[key].reset_index(drop=True))


def test_pieces_rebuild_texts(spark, docs):
    cases = [("  lead  and\ttrail \n", [(0, 1), (1, 2)]), ("a b c", [(0, 3)]), ("a b c", [(0, 1), (2, 1)]), (" x y", [(0, 2)])]
    frame = spark.createDataFrame(cases, "text string, pieces array<struct<first_word:long,n_words:long>>")
    got = [r[0] for r in frame.select(mixing.pieces_text(F.col("text"), F.col("pieces"))).collect()]
    assert got == ["  lead  and\ttrail \n", "a b c", "a c", " x y"]


def test_packing_covers_every_word_once(spark, docs):
    sized = mixing.measured(docs, block_words=16)
    pieces = mixing.pack_blocks(sized.select("row", "doc_id", "tie", "source", "sid", "size"), 16, bucket_docs=10).toPandas()
    full = pieces.groupby(["sid", "block"]).n_words.sum()
    for sid, part in full.groupby("sid"):
        assert (part.iloc[:-1] == 16).all() and part.iloc[-1] <= 16
        assert list(part.index.get_level_values("block")) == list(range(len(part)))
    assert pieces.n_words.sum() == sized.agg(F.sum("size")).first()[0]


def test_empty_table(spark, docs):
    sized = mixing.measured(docs.limit(0))
    assert sized.count() == 0 and mixing.mix(sized).count() == 0
    blank = mixing.measured(docs.filter("doc_id IN (500, 501)"))
    assert blank.count() == 2 and mixing.mix(blank).count() == 0


def test_query(spark):
    got = queries.op1_mixing(spark, SF_SMALL).toPandas()
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id").text
    assert len(got) == len(text) and all(r.size == len(text[r.doc_id].encode().split()) for r in got.rename(columns={"size": "size"}).itertuples(index=False) if not callable(r.size))
    sums = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert dict(sums.target) == pytest.approx(brute_targets(dict(sums["size"])))
    assert (abs(sums.taken - sums.target) <= 128).all() and (got.taken <= 3 * got["size"]).all()


def test_slots_are_drawn_in_many_tasks(spark, monkeypatch):
    """Few source rows become many slots: not in one task, whatever AQE makes of the source rows."""
    monkeypatch.setattr(mixing, "TASK_SLOTS", 1000)
    targets = spark.createDataFrame([(1, 4000, 6000), (2, 500, 1500)], "sid long, blocks long, slots long")
    slots = mixing.draw_slots(targets, shard_slots=64)
    assert slots.count() == 7500 and slots.select("shard", "slot").distinct().count() == 7500
    assert slots.groupBy(F.spark_partition_id()).count().count() > 3


def test_a_very_long_text(spark):
    rows = [(1, "long " * 50_000, "a"), (2, "short text", "b")]
    sized = mixing.measured(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, tie string"))
    taken = {r.doc_id: r.n for r in mixing.mix(sized).groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert taken[2] == 6 and abs(taken[1] - 49_996) <= 2 * mixing.BLOCK_WORDS
