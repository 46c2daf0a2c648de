"""Range join, bag difference, sketches and drifting documents against plain loops."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.operators import bands, sketches
from starloom.plans.queries import QUERIES
from starloom.sources import variants


@pytest.mark.parametrize("width", [0.5, 10.0, 1e6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join(spark, width, how):
    rng = random.Random(4)
    points = [(i, rng.choice([None, float("nan"), 5.0, 5.0, rng.uniform(-50, 50)])) for i in range(150)] + [(7, 5.0)]
    held = [(j, rng.choice([None, 5.0, rng.uniform(-60, 60)]), rng.choice([None, 5.0, rng.uniform(-60, 60)])) for j in range(25)] + [(3, -1.0, 6.0)] * 2
    p, b = spark.createDataFrame(points, "i int, v double"), spark.createDataFrame(held, "j int, lo double, hi double")
    got = Counter((r.i, r.j) for r in bands.range_join(p, b, "v", "lo", "hi", width, how).collect())
    want = Counter()
    for i, v in points:
        fits = [j for j, lo, hi in held if v is not None and v == v and (lo is None or v >= lo) and (hi is None or v < hi)]
        want.update([(i, j) for j in fits] or ([(i, None)] if how == "left" else []))
    assert got == want
    plan = bands.range_join(p, b, "v", "lo", "hi", width, how)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_of_empty_tables(spark):
    p, b = spark.createDataFrame([(1, 2.0)], "i int, v double"), spark.createDataFrame([(1, None, None)], "j int, lo double, hi double")
    assert bands.range_join(p, b.limit(0), "v", "lo", "hi", 1.0).count() == 0
    assert bands.range_join(p.limit(0), b, "v", "lo", "hi", 1.0).count() == 0
    assert bands.range_join(p, b, "v", "lo", "hi", 1.0).count() == 1


def test_range_join_summed(spark):
    rng, nan = random.Random(5), float("nan")
    value = lambda: rng.choice([None, nan, 5.0, 5.0, 0.0, -0.0, float(rng.randint(-9, 9)), rng.uniform(-50, 50)])
    points = [(value(), rng.choice([None, Decimal(rng.randint(-999, 999)) / 100]), rng.randint(0, 3)) for _ in range(300)] + [(-49.5, None, 1)] * 3
    bound = lambda: rng.choice([None, 5.0, 0.0, -0.0, nan, float(rng.randint(-9, 9)), rng.uniform(-60, 60), 1e300, float("inf"), -float("inf")])
    held = [(j, bound(), bound()) for j in range(120)] + [(3, -1.0, 6.0)] * 2 + [(None, None, None), (8, -49.5, -49.0)]
    p, b = spark.createDataFrame(points, "v double, d decimal(18,2), k int"), spark.createDataFrame(held, "j int, lo double, hi double")
    got = bands.range_join(p, b, "v", "lo", "hi", 10.0, sums={"total": F.col("d"), "ks": F.col("k")})
    assert got.dtypes[3:] == [("n", "bigint"), ("total", "decimal(28,2)"), ("ks", "bigint")]
    want = []
    for j, lo, hi in held:  # NaN is above all others
        fits = [(d, k) for v, d, k in points if v is not None and v == v and (lo is None or v >= lo) and (hi is None or hi != hi or v < hi)]
        ds = [d for d, _ in fits if d is not None]
        want += [(j, lo, hi, len(fits), sum(ds) if ds else None, sum(k for _, k in fits))] if fits else []
    assert Counter(map(str, map(tuple, got.collect()))) == Counter(map(str, want))
    for points_, bands_ in ((p.limit(0), b), (p, b.limit(0)), (p.limit(0), b.limit(0))):
        assert bands.range_join(points_, bands_, "v", "lo", "hi", 10.0, sums={"ks": F.col("k")}).count() == 0
    with pytest.raises(ValueError, match="exact"):
        bands.range_join(p, b, "v", "lo", "hi", 10.0, sums={"total": F.col("v")})
    with pytest.raises(ValueError, match="left"):
        bands.range_join(p, b, "v", "lo", "hi", 10.0, "left", sums={"ks": F.col("k")})


def _most_rows(node):
    """The most rows that an operator of an executed plan has made."""
    inner = {"AdaptiveSparkPlanExec": "executedPlan"}.get(node.getClass().getSimpleName(), "plan" if node.getClass().getSimpleName().endswith("StageExec") else "")
    below = [getattr(node, inner)()] if inner else [node.children().apply(i) for i in range(node.children().size())]
    made = node.metrics().get("numOutputRows")
    return max([made.get().value() if made.isDefined() else 0, *map(_most_rows, below)])


def test_price_bands_make_no_pairs(spark, tmp_path):
    """Most bands hold a third of the sales or more: what the query makes must not grow as the product of the two."""
    sales, suppliers = 3000, [i % 350 for i in range(400)]
    spark.range(sales).selectExpr(
        "id o_orderkey", "id o_custkey", "if(id % 50 = 0, null, cast(id * 0.37 as double)) o_totalprice", "timestamp'2000-01-01' o_orderdate", "'x' o_orderpriority"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, float(k % 20)) for k in suppliers], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    found = QUERIES["sales_price_band"](spark, str(tmp_path))
    got = found.collect()
    assert Counter(r.band_id for r in got) == Counter(suppliers)
    amounts = [37 * i / 100 for i in range(sales) if i % 50]
    for r in got:  # a band that comes twice has the sales of both
        fits = [a for a in amounts if (r.lower is None or a >= r.lower) and (r.upper is None or a < r.upper)] * suppliers.count(r.band_id)
        assert (r.n, r.total) == (len(fits), round(sum(fits), 2) if fits else None)
    assert 100 * (sales + len(suppliers)) < sum(r.n for r in got)
    assert _most_rows(found._jdf.queryExecution().executedPlan()) < 10 * (sales + len(suppliers))


def test_bag_difference(spark):
    left = [(1, "a"), (1, "a"), (2, None), (None, None), (3, "c")] + [(9, "hot")] * 500
    right = [(1, "a"), (2, None), (None, None), (None, None), (4, "d")] + [(9, "hot")] * 500
    l, r = (spark.createDataFrame([(*x, "other") for x in rows], "k int, s string, more string") for rows in (left, right))
    got = sorted(map(tuple, bands.bag_difference(l, r, ["k", "s"]).collect()), key=str)
    assert got == sorted([(1, "a", 2, 1), (None, None, 1, 2), (3, "c", 1, 0), (4, "d", 0, 1)], key=str)
    assert bands.bag_difference(l, l, ["k", "s"]).count() == 0
    assert bands.bag_difference(l.limit(0), l.limit(0), ["k"]).count() == 0


def test_sketches_merge(spark):
    rng = random.Random(6)
    rows = [(p, m, rng.choice([None, *range(3000)]), rng.choice([None, rng.gauss(0, 9)])) for p in ("a", None) for m in range(4) for _ in range(2500)]
    rows += [("void", 0, None, None)] * 3
    df = spark.createDataFrame(rows, "p string, m int, k int, v double")
    stored = sketches.partition_sketches(df, ["p", "m"], "k", "v")
    got = {r.p: r for r in sketches.estimates(sketches.merged_sketches(stored, ["p"]), [0.1, 0.5]).collect()}
    for p in ("a", None):
        mine = [r for r in rows if r[0] == p]
        exact = len({r[2] for r in mine if r[2] is not None})
        assert got[p].n == len(mine) and abs(got[p].about_distinct - exact) <= 3 * sketches.HLL_ERROR * exact
        values = sorted(r[3] for r in mine if r[3] is not None)
        for rank, found in zip([0.1, 0.5], got[p].about_quantiles):
            assert abs(sum(v <= found for v in values) / len(values) - rank) <= sketches.KLL_RANK_ERROR
    assert (got["void"].n, got["void"].about_distinct, got["void"].about_quantiles) == (3, 0, None)
    assert sketches.estimates(sketches.partition_sketches(df.limit(0), ["p"], "k", "v")).count() == 0


def test_drifting_documents(spark):
    docs = [
        '{"trx_id": 1, "retailer_id": 2, "amount": 3.5, "city_id": 4, "day": "2024-02-03"}', '{"trx_id": "7", "amount": "12.25", "z": 1, "b": null}',
        '{"trx_id": {"x": 1}, "amount": [1], "city_id": null, "day": "no day"}', "{}", "[1, 2]", '"text"', "5", "null", "not json", '{"trx_id": 1', None, "",
        '{"trx_id": 99999999999, "retailer_id": 2.0, "city_id": true}', '{"trx_id": 1, "trx_id": 2}', '{"day": "2024-02-03", "long": "' + "x" * 100_000 + '"}',
    ]
    frame = spark.createDataFrame([(i, d, "kept") for i, d in enumerate(docs)], "i int, doc string, day string")
    got = {r.i: r for r in variants.typed_sales(frame, "doc").collect()}
    assert (got[0].trx_id, got[0].retailer_id, got[0].amount, got[0].city_id, str(got[0].day)) == (1, 2, Decimal("3.50"), 4, "2024-02-03")
    assert (got[1].trx_id, got[1].amount, got[1].misfits, got[1].unknown, got[1].broken) == (7, Decimal("12.25"), "", "b,z", False)
    assert (got[2].misfits, got[2].city_id, got[2].broken) == ("amount,day,trx_id", None, False)
    assert (got[3].misfits, got[3].unknown, got[3].broken) == ("", "", False)
    assert [got[i].broken for i in (4, 5, 6, 7, 8, 9, 10, 11, 13)] == [True] * 9
    assert got[12].misfits == "trx_id" and got[12].retailer_id == 2
    assert (str(got[14].day), got[14].unknown) == ("2024-02-03", "long")
    assert variants.typed_sales(frame.limit(0), "doc").count() == 0
