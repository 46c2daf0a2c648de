"""The byte network: gradients, batching, held-out accuracy, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import language_id as lid
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = lid.sampled_windows(docs.filter(~held), "doc_id", "text", "lang", sample_docs=40).collect()
    langs = sorted({r["lang"] for r in rows})
    assert max(np.bincount([langs.index(r["lang"]) for r in rows])) <= 40 * lid.SAMPLE_WINDOWS
    return langs, lid.fit([bytes(r["window"]) for r in rows], np.array([langs.index(r["lang"]) for r in rows]), len(langs), steps=120), docs.filter(held)


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    p = {k: v.astype(np.float64) for k, v in lid.start_params(3, units=4, seed=1).items()}
    x, label = rng.integers(97, 110, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    mask = (np.arange(7)[:, None] < np.array([7, 7, 3, 5, 1])).astype(float)
    # float32 states limit the precision, so steps are large and the comparison is loose
    _, grads = lid.gradients(p, x, mask, label)
    for name in p:
        flat = np.flatnonzero(np.abs(grads[name]) > 5e-3)
        for at in rng.choice(flat, min(4, len(flat)), replace=False):
            values = []
            for d in (1e-3, -1e-3):
                moved = {k: v.copy() for k, v in p.items()}
                moved[name].flat[at] += d
                values.append(lid.gradients(moved, x, mask, label)[0])
            assert (values[0] - values[1]) / 2e-3 == pytest.approx(grads[name].flat[at], rel=0.05, abs=2e-3), name


def test_held_out_accuracy(model):
    langs, p, held = model
    found = lid.identify(held, langs, p, lang=F.col("lang")).toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()


def test_texts_in_pieces_are_pooled_whole(model, monkeypatch):
    langs, p, held = model
    datas = [r.text.encode() for r in held.limit(20).collect()] + [b"", b"x", b"y" * lid.WINDOW]
    want = lid.pooled(p, datas)
    monkeypatch.setattr(lid, "_BATCH", 3)
    assert lid.pooled(p, datas) == pytest.approx(want, abs=1e-5)
    assert lid.pooled(p, datas[3:4])[0] == pytest.approx(want[3], abs=1e-5)


def plain_states(wx, wh, data):
    """The network's states, one byte after the other, written out."""
    units, states = wh.shape[1], []
    h = [0.0] * units
    for byte in data:
        a, g = wx[:, byte].astype(float), wh.astype(float) @ np.array(h)
        gate = lambda k: min(1.0, max(0.0, 0.25 * (a[k] + g[k]) + 0.5))  # noqa: B023, E731
        new = []
        for k in range(units):
            z, r = gate(k), gate(units + k)
            c = a[2 * units + k] + r * g[2 * units + k]
            new.append(z * h[k] + (1 - z) * c / (1 + abs(c)))
        h = new
        states.append(np.array(h))
    return states


def plain_pooled(p, data):
    total = np.zeros(len(p["o"]))
    for at in range(0, len(data), lid.WINDOW):
        part = data[at : at + lid.WINDOW]
        ahead, back = plain_states(p["fx"], p["fh"], part), plain_states(p["bx"], p["bh"], part[::-1])[::-1]
        for f, b in zip(ahead, back):
            scores = p["o"].astype(float) @ np.concatenate([f, b]) + p["c"][:, 0]
            e = np.exp(scores - scores.max())
            total += e / e.sum()
    return total / max(1, len(data))


def test_against_a_plain_forward_pass(spark, model):
    """Every position of every text on its own, without batches, masks or matrices over time."""
    langs, p, held = model
    texts = [r.text[:400] for r in held.limit(8).collect()] + ["a", "été à la", "x" * lid.WINDOW, "the " * 40, "der Hund\n" * 9]
    got = lid.identify(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), langs, p).collect()
    for r in got:
        want = plain_pooled(p, texts[r.doc_id].encode())
        assert r.lang_pred == langs[int(want.argmax())] and r.score == pytest.approx(want.max(), abs=1e-4)


def test_edge_cases(spark, model):
    langs, p, _ = model
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the and of"), (4, "the and of"), (None, "der die das"), (5, "z" * 200_000)]
    docs = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang_pred string, score double")
    got = lid.identify(docs, langs, p).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.lang_pred == "und" and r.score == 0) if r.doc_id in (1, 2, 3) else (r.lang_pred in langs and 0 < r.score <= 1)
    assert lid.identify(docs.limit(0), langs, p).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    languages, params = lid.train(empty)
    assert languages == [] and {r.lang_pred for r in lid.identify(docs, languages, params).collect()} == {"und"}
