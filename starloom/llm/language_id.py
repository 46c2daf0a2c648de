"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of ``WINDOW`` bytes. In each, one recurrent layer runs forward and one
backward; every position gets a label distribution from both states, and a text's probabilities are the
mean over all its positions. Training is backpropagation through time with Adam, in numpy on the driver,
on a bounded sample: at most ``SAMPLE_DOCS`` documents of each language (those with the smallest id
hash), ``SAMPLE_WINDOWS`` evenly spaced windows of each. Prediction reads whole texts, in Arrow batches,
``_BATCH`` windows at a time, so its memory is bounded by the batch.

The gates use a hard sigmoid and the candidate a softsign: both are a few vector operations, where
``exp`` and ``tanh`` would take most of the time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 64
UNITS = 8
SAMPLE_DOCS = 256
SAMPLE_WINDOWS = 16
STEPS = 300
TRAIN_BATCH = 256
LEARNING_RATE = 0.01
SEED = 7
UNDETERMINED = "und"

_BATCH = 4096
_PAD = 0

Params = dict[str, np.ndarray]


def start_params(n_labels: int, units: int = UNITS, seed: int = SEED) -> Params:
    """Feature-major weights: ``f`` forward, ``b`` backward; gate order update, reset, candidate."""
    rng = np.random.default_rng(seed)
    made: Params = {}
    for d in "fb":
        made[f"{d}x"] = rng.normal(0, 0.3, (3 * units, 256))
        made[f"{d}h"] = rng.normal(0, 0.5 / np.sqrt(units), (3 * units, units))
        made[f"{d}x"][:units] += 1.0  # updates start slow, so that states last
    made["o"] = rng.normal(0, 0.3, (n_labels, 2 * units))
    made["c"] = np.zeros((n_labels, 1))
    return {k: v.astype(np.float32) for k, v in made.items()}


def _run(wx: np.ndarray, wh: np.ndarray, x: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States (time, units, batch) for bytes ``x`` (time, batch). Where ``mask`` (time, batch) is 0 the
    state stays zero. ``keep`` collects what the backward pass needs."""
    steps, n = x.shape
    u = wh.shape[1]
    h = np.zeros((u, n), np.float32)
    out = np.empty((steps, u, n), np.float32)
    for t in range(steps):
        a = np.take(wx, x[t], axis=1)
        g = wh @ h
        gates = a[: 2 * u]
        gates += g[: 2 * u]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0.0, 1.0, out=gates)
        z, r = gates[:u], gates[u:]
        candidate = a[2 * u :]
        candidate += r * g[2 * u :]
        size = np.abs(candidate)
        size += 1.0
        made = candidate / size
        if keep is not None:
            keep.append((h, z, r, g[2 * u :], made, size))
        new = h - made
        new *= z
        new += made
        if mask is not None:
            new *= mask[t]
        h = out[t] = new
    return out


def _back(wh: np.ndarray, x: np.ndarray, mask: np.ndarray, kept: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and recurrent weights, through time."""
    u = wh.shape[1]
    dwx, dwh = np.zeros((3 * u, 256), np.float32), np.zeros_like(wh)
    carry = np.zeros_like(dout[0])
    one_hot = np.eye(256, dtype=np.float32)
    for t in range(len(kept) - 1, -1, -1):
        h, z, r, g, made, size = kept[t]
        d = (dout[t] + carry) * mask[t]
        dcandidate = d * (1 - z) / (size * size)
        slope = lambda s: 0.25 * ((s > 0) & (s < 1))
        dz, dr = d * (h - made) * slope(z), dcandidate * g * slope(r)
        dg = np.concatenate([dz, dr, dcandidate * r])
        dwh += dg @ h.T
        dwx += np.concatenate([dz, dr, dcandidate]) @ one_hot[x[t]]
        carry = d * z + wh.T @ dg
    return dwx, dwh


def _probabilities(p: Params, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """(time, labels, batch)"""
    u = forward.shape[1]
    scores = np.matmul(p["o"][:, :u], forward)
    scores += np.matmul(p["o"][:, u:], backward)
    scores += p["c"]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def gradients(p: Params, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, Params]:
    """Mean cross-entropy of all unmasked positions, and its gradients."""
    kept_f, kept_b = [], []
    forward = _run(p["fx"], p["fh"], x, mask, kept_f)
    backward = _run(p["bx"], p["bh"], x[::-1], mask[::-1], kept_b)[::-1]
    prob = _probabilities(p, forward, backward)
    u, total = forward.shape[1], mask.sum()
    at = (slice(None), label, np.arange(len(label)))
    loss = float(-(np.log(prob[at] + 1e-12) * mask).sum() / total)
    d = prob
    d[at] -= 1.0
    d *= mask[:, None, :] / total
    grads = {"c": d.sum(axis=(0, 2))[:, None]}
    both = np.concatenate([forward, backward], axis=1)
    grads["o"] = np.einsum("tln,tun->lu", d, both, optimize=True)
    dstate = np.matmul(p["o"].T, d)
    grads["fx"], grads["fh"] = _back(p["fh"], x, mask, kept_f, dstate[:, :u])
    grads["bx"], grads["bh"] = _back(p["bh"], x[::-1], mask[::-1], kept_b, dstate[::-1, u:])
    return loss, grads


def fit(windows: Sequence[bytes], labels: np.ndarray, n_labels: int, steps: int = STEPS, seed: int = SEED) -> Params:
    """Adam on batches that draw every label equally often."""
    rng = np.random.default_rng(seed)
    p = start_params(n_labels, seed=seed)
    x = np.zeros((len(windows), WINDOW), np.uint8)
    mask = np.zeros((len(windows), WINDOW), np.float32)
    for i, w in enumerate(windows):
        x[i, : len(w)] = np.frombuffer(w, np.uint8)
        mask[i, : len(w)] = 1
    of = [np.flatnonzero(labels == k) for k in range(n_labels)]
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(i, -(-TRAIN_BATCH // n_labels)) for i in of])
        _, grads = gradients(p, np.ascontiguousarray(x[pick].T), np.ascontiguousarray(mask[pick].T), labels[pick])
        rate = LEARNING_RATE * (1 - step / (steps + 1))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def sampled_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, window``: the bounded training sample. Only rows with a language and a letter count."""
    data = F.col(text_col).cast("binary")
    start = lambda i: F.floor(F.greatest(F.octet_length(data) - WINDOW, F.lit(0)) * i / (SAMPLE_WINDOWS - 1)).cast("int") + 1
    windows = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda i: F.substring(data, start(i), F.lit(WINDOW)))
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col)).alias("h"), windows.alias("windows")
    )
    # the windows travel, not the texts; salted first, so that what each task of the scan finds of a
    # frequent language is cut down by many tasks before one takes the last choice
    for key in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        order = Window.partitionBy(*key).orderBy("h", "doc_id", "windows")
        rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_docs).drop("n")
    return rows.select("lang", "h", F.explode("windows").alias("window")).distinct().orderBy("lang", "h", "window")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Params]:
    """``(languages, weights)`` learnt from ``docs``; without any usable row the list is empty."""
    rows = sampled_windows(docs, id_col, text_col, lang_col).select("lang", "window").collect()
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return [], start_params(1)
    number = {lang: i for i, lang in enumerate(languages)}
    return languages, fit([bytes(r["window"]) for r in rows], np.array([number[r["lang"]] for r in rows]), len(languages))


def _windows(datas: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text number, bytes, lengths)`` of at most _BATCH windows at a time; a text may span several."""
    numbers, parts, held = [], [], 0

    def made() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.concatenate([np.append(np.full((len(d) - 1) // WINDOW, WINDOW), (len(d) - 1) % WINDOW + 1) for d in parts])
        joined = b"".join(d.ljust(-(-len(d) // WINDOW) * WINDOW, b"\0") for d in parts)
        of = np.repeat(numbers, [-(-len(d) // WINDOW) for d in parts])
        return of, np.frombuffer(joined, np.uint8).reshape(-1, WINDOW), sizes

    for i, data in enumerate(datas):
        for at in range(0, len(data), _BATCH * WINDOW):
            part = data[at : at + _BATCH * WINDOW]
            count = -(-len(part) // WINDOW)
            if held + count > _BATCH and held:
                yield made()
                numbers, parts, held = [], [], 0
            numbers.append(i), parts.append(part)
            held += count
    if parts:
        yield made()


def pooled(p: Params, datas: Sequence[bytes]) -> np.ndarray:
    """(texts, labels): mean label probabilities over all positions; zeros for an empty text."""
    total = np.zeros((len(datas), len(p["o"])))
    count = np.zeros(len(datas))
    for of, x, sizes in _windows(datas):
        x = np.ascontiguousarray(x.T)
        mask = None
        if (sizes < WINDOW).any():
            mask = (np.arange(WINDOW)[:, None] < sizes).astype(np.float32)
        forward = _run(p["fx"], p["fh"], x, None)
        backward = _run(p["bx"], p["bh"], x[::-1], None if mask is None else mask[::-1])[::-1]
        prob = _probabilities(p, forward, backward)
        summed = prob.sum(axis=0) if mask is None else np.einsum("tln,tn->ln", prob, mask)
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        total[of[starts]] += np.add.reduceat(summed.T, starts, axis=0)
        count[of[starts]] += np.add.reduceat(sizes, starts)
    return total / np.maximum(count, 1)[:, None]


def predict(text: Column, languages: list[str], params: Params) -> Column:
    """struct ``lang_pred, score``: the most probable language and its pooled probability.

    Edge cases: a null text, one without a letter, or a model without languages gives ``und`` with score
    0. Ties go to the language that sorts first. Texts of any length are read whole.
    """
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for at in range(0, len(texts), 1024):
            datas = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in texts.slice(at, 1024)]
            prob = pooled(params, datas)
            best = prob.argmax(axis=1)
            names += [languages[k] if d else UNDETERMINED for k, d in zip(best.tolist(), datas)]
            scores += prob[np.arange(len(best)), best].tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    nothing = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if not languages:
        return nothing
    readable = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.when(readable, run(F.when(readable, text))).otherwise(nothing)


def identify(docs: DataFrame, languages: list[str], params: Params, id_col: str = "doc_id", text_col: str = "text", **extra: Column) -> DataFrame:
    """One row per input row: ``doc_id``, the ``extra`` columns, ``lang_pred, score``. Repeated rows and
    null ids are kept, an empty table gives an empty result, other columns are ignored."""
    found = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in extra.items()], predict(F.col(text_col), languages, params).alias("p"))
    return found.select("doc_id", *extra, "p.lang_pred", "p.score")
