"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are built-in functions over whole texts, computed once and written. Training takes a
bounded sample, at most ``SAMPLE_ROWS`` labelled rows (those with the smallest id hash): features are cut
into at most ``BINS`` quantile bins, and each node's split comes from per-bin sums of gradients. The
trees are flattened into arrays; prediction walks all rows and trees one level at a time in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import checkpointed
from starloom.llm.quality_rules import text_stats

SAMPLE_ROWS = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
MIN_ROWS = 10
RIDGE = 1.0


def features() -> dict[str, Column]:
    """The model's inputs, from the columns of ``quality_rules.STATS``. Each is defined for any text."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_text_lines"), F.lit(1))
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "symbol_ends": F.col("n_symbol_ends") / n,
        "odd_chars": F.col("n_odd_chars") / chars,
        "capitals": F.col("n_capitals") / chars,
        "exclaimed": F.col("n_exclaimed") / n,
        "line_copies": F.col("n_dup_lines") / lines,
        "line_words": F.col("n_words") / lines,
        "window_copies": F.col("n_repeat_words") / n,
        "variety": F.log1p(F.col("n_distinct_words").cast("double")) / F.log1p(n.cast("double")),
    }


@dataclass
class Forest:
    """Complete trees of one depth: node k has the children 2k+1 and 2k+2; the last level holds values."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): left if x <= threshold
    value: np.ndarray  # (trees, leaves)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Logistic loss, second-order leaf values. Without rows, or with one label only, there is no split
    and the base alone decides (an even chance without rows)."""
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Forest(base, feature[:0], threshold[:0], value[:0])
    cuts = [_cuts(x[:, j], bins) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(n, base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            best = np.zeros(nodes)
            chosen = np.zeros(nodes, np.int64), np.full(nodes, bins + 1)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                key = node * (bins + 1) + binned[:, j]
                sums = [np.cumsum(np.bincount(key, w, nodes * (bins + 1)).reshape(nodes, -1), axis=1) for w in (g, h, np.ones(n))]
                (gl, hl, nl), (gt, ht, nt) = sums, (s[:, -1:] for s in sums)
                score = lambda a, b: a * a / (b + RIDGE)
                gain = score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht)
                gain = np.where((nl >= MIN_ROWS) & (nt - nl >= MIN_ROWS), gain, 0.0)[:, : len(cuts[j])]
                at = gain.argmax(axis=1)
                got = gain[np.arange(nodes), at]
                better = got > best + 1e-9
                best[better], chosen[0][better], chosen[1][better] = got[better], j, at[better]
            for k in range(nodes):
                if best[k] > 0:
                    feature[tree, first + k], threshold[tree, first + k] = chosen[0][k], cuts[chosen[0][k]][chosen[1][k]]
            node = 2 * node + (binned[np.arange(n), chosen[0][node]] > chosen[1][node])
        gs, hs = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value[tree] = -RATE * gs / (hs + RIDGE)
        margin += value[tree][node]
    return Forest(base, feature, threshold, value)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` (array<double> of ``features``), one row per document, written once."""
    stats = docs.select(F.col(id_col).alias("doc_id"), text_stats(F.col(text_col)).alias("s")).select("doc_id", "s.*")
    return checkpointed(stats.select("doc_id", F.array(*features().values()).alias("x")))


def train(x: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on the documents of ``x`` that have a label. A document with several labels counts with the
    more frequent one (good if even); null labels and ids do not count."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    rows = x.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).select("x", "y").toArrow()
    matrix = np.array(rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False) if len(rows) else []).reshape(len(rows), len(features()))
    return fit(matrix, rows["y"].to_numpy().astype(float))


def score(x: DataFrame, forest: Forest, **extra: Column) -> DataFrame:
    """``doc_id``, the ``extra`` columns, ``score`` (probability of a good document), ``predicted`` (1 from
    0.5 on, so a tie is good). Edge cases: null and empty texts have all-zero statistics and get their leaf's
    score; very long texts are counted whole; repeated rows and null ids are kept; other columns of the
    documents, of any name, are left behind by ``measured``; an empty table gives an empty result."""
    @F.arrow_udf("double")
    def run(rows: pa.Array) -> pa.Array:
        width = len(features_)
        return pa.array(forest.probability(rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)), pa.float64())

    features_ = list(features())
    found = x.select("doc_id", *[c.alias(k) for k, c in extra.items()], run("x").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
