"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to ``order``, with counts from all training texts. A symbol is
predicted in the longest context that the trie has. If it was never seen there, the escape probability is
paid and the next shorter context is asked, where the symbols of the longer one are excluded, down to a
uniform choice. The logarithms add up to the text's log probability; an end symbol makes the model a
distribution over whole texts.

* Escape estimate: a context with count T and D stored symbols escapes with probability
  (D / 2 + U) / T, where U is the count of its symbols that are not stored: method D, plus the mass that
  pruning removed. A stored symbol of count c has (c - 1/2) / T.
* Exclusion: the symbols of a context are among those of each shorter one, so what an escape excludes
  depends on the escaped context alone, and its corrected denominator is computed once, in the trie.
* Pruning: none, unless ``share`` asks for it; every gram of the corpus is in the trie.

Most positions have a common gram of the longest context: one that makes up at least ``COMMON_SHARE`` of all
positions. There are at most ``1 / COMMON_SHARE`` of these, and they are broadcast with their exact
probabilities. The grams that miss are counted per document and joined with the table of all grams. What is not
there either escapes to shorter contexts: such grams meet all grams with the same last ``BASE`` context bytes,
which hold every count of the contexts of ``BASE`` and more bytes; the grams of shorter contexts (at most
``256 ** BASE``) are broadcast whole.

Training is one pass: each task counts its longest grams in numpy, and the words for the base score;
Spark sums both. The base score needs the corpus count of
every word: words that make up at least ``HEAD_SHARE`` of all tokens (at most ``1 / HEAD_SHARE``) are
broadcast, all others are joined with the count table by word; such words are rare by definition, so the
join has no hot key.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import written

ORDER = 6
COMMON_SHARE = 2.0**-24
BASE = 3
HEAD_SHARE = 2.0**-20

#: Bytes that UTF-8 never has: the symbol behind a text, and the context before it.
END, PAD = 0xFE, 0xFF
SYMBOLS = 255
_CHUNK = 1 << 20
_FLUSH = 1 << 21
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def lowered(value) -> bytes:
    """A text cell in UTF-8 with A-Z lower-cased; null is empty."""
    return (value.as_buffer().to_pybytes() if value.is_valid else b"").lower()


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded number of bytes at a time."""
    at = 0
    while len(data) - at > 4 * _CHUNK:
        space = _SPACE.search(data, at + 4 * _CHUNK)
        if not space:
            break
        yield data[at : space.start()].split()
        at = space.start()
    yield data[at:].split()


def coded(datas: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text number, gram)`` arrays for every symbol of the texts, ends included, in pieces of about
    _CHUNK symbols. A gram holds the symbol in its lowest byte and the ``order`` bytes before above it."""
    pad, group, first, size = bytes([PAD]) * order, [], 0, 0

    def grams(joined: bytes) -> np.ndarray:
        raw = np.frombuffer(joined, np.uint8)
        code = np.zeros(len(raw) - order, np.int64)
        for j in range(order + 1):
            code <<= 8
            code |= raw[j : len(raw) - order + j]
        return code[raw[order:] != PAD]

    for i, data in enumerate(datas):
        if len(data) > _CHUNK:
            whole = pad + data + bytes([END])
            for at in range(0, len(data) + 1, _CHUNK):
                code = grams(whole[at : at + _CHUNK + order])
                yield np.full(len(code), i), code
            group.append((i, None))
        else:
            group.append((i, data))
            size += len(data)
        if size > _CHUNK or len(group) >= 4096 or i == len(datas) - 1:
            some = [(k, d) for k, d in group if d is not None]
            if some:
                yield np.repeat([k for k, _ in some], [len(d) + 1 for _, d in some]), grams(b"".join(pad + d + bytes([END]) for _, d in some))
            group, size = [], 0


def count_grams_and_words(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(text)`` -> ``code, word, n``: the counts of all grams (``word`` null) and of all words (``code``
    null; the end token is the empty word), written once."""
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    arrow = pa.schema([("code", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        if counts is None:
            codes = np.sort(codes)
        else:
            by = np.argsort(codes)
            codes, counts = codes[by], counts[by]
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
        return codes[starts], np.diff(np.append(starts, len(codes))) if counts is None else np.add.reduceat(counts, starts)

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        return parts[0] if len(parts) == 1 else summed(*map(np.concatenate, zip(*parts)))

    def gram_rows(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(codes), 1 << 16):
            n = len(codes[at : at + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(codes[at : at + n]), pa.nulls(n, pa.binary()), pa.array(counts[at : at + n])], schema=arrow)

    def word_rows(words: Counter) -> Iterator[pa.RecordBatch]:
        keys, counts = list(words), list(words.values())
        for at in range(0, len(keys), 1 << 16):
            some = keys[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.array(some, pa.binary()), pa.array(counts[at : at + (1 << 16)], pa.int64())], schema=arrow)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, raw, parts = Counter(), [], []
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), 512):
                datas = [lowered(v) for v in column.slice(at, 512)]
                words[b""] += len(datas)
                for data in datas:
                    for some in word_lists(data):
                        words.update(some)
                for _, code in coded(datas, order):
                    raw.append(code)
                    if sum(map(len, raw)) > _FLUSH:
                        parts.append(summed(np.concatenate(raw)))
                        raw = []
                        if sum(len(c) for c, _ in parts) > _FLUSH:
                            parts = [merged(parts)]
                            if len(parts[0][0]) > _FLUSH // 2:  # Spark sums what a task sends at different times
                                yield from gram_rows(*parts.pop())
                if len(words) > _FLUSH // 8:
                    yield from word_rows(words)
                    words = Counter()
        if raw:
            parts.append(summed(np.concatenate(raw)))
        if parts:
            yield from gram_rows(*merged(parts))
        yield from word_rows(words)

    return written(texts.mapInArrow(count, schema).groupBy("code", "word").agg(F.sum("n").alias("n")), "ppm-counts")


def with_totals(counts: DataFrame) -> DataFrame:
    """``code, n, total``: the longest grams with the count of their context, written once. A context has at
    most SYMBOLS rows, so its window is small."""
    whole = Window.partitionBy(F.shiftright("code", 8))
    return written(counts.filter("code IS NOT NULL").select("code", "n", F.sum("n").over(whole).alias("total")), "ppm-grams")


def shortened(gram: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the last ``size`` bytes of grams, sorted."""
    gram, of = np.unique(gram & ((1 << 8 * size) - 1), return_inverse=True)
    summed = np.zeros(len(gram), np.int64)
    np.add.at(summed, of, n)
    return gram, summed


def stored(level: int, gram: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """``level, gram, n, total`` of the grams of one context length that the trie has."""
    _, total = shortened(gram >> 8, n, level)
    _, of = np.unique(gram >> 8, return_inverse=True)
    some = n >= least
    return np.full(some.sum(), level), gram[some], n[some], total[of][some]


def stacked(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4


@dataclass
class Level:
    grams: np.ndarray  # sorted
    log_counts: np.ndarray
    contexts: np.ndarray  # sorted
    log_top: np.ndarray  # of each gram, entered without exclusion
    escape: np.ndarray  # of each context, entered without exclusion
    below: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log denominator in the shorter context, after this one's exclusion
    below_escape: np.ndarray = field(default_factory=lambda: np.zeros(0))


def build_levels(level: np.ndarray, gram: np.ndarray, n: np.ndarray, total: np.ndarray, order: int = ORDER) -> list[Level]:
    """The trie with its escape estimates and exclusions (natural logarithms)."""
    levels: list[Level] = []
    upper = None
    for j in range(order + 1):
        mine = np.flatnonzero(level == j)
        mine = mine[np.argsort(gram[mine])]
        grams, counts = gram[mine], n[mine].astype(np.float64)
        contexts, starts, of = np.unique(grams >> 8, return_index=True, return_inverse=True)
        distinct = np.bincount(of, minlength=len(contexts)).astype(np.float64)
        stored = np.bincount(of, counts, len(contexts))
        pruned = total[mine][starts] - stored
        whole, logs = stored + pruned, np.log(counts - 0.5)
        made = Level(grams, logs, contexts, logs - np.log(whole)[of], np.log((distinct / 2 + pruned) / whole))
        if j:
            shorter, s_counts, s_distinct, s_stored, s_pruned = upper
            parent = np.searchsorted(shorter.contexts, contexts & ((1 << 8 * (j - 1)) - 1))
            twin = np.searchsorted(shorter.grams, grams & ((1 << 8 * j) - 1))
            left = s_stored[parent] - np.bincount(of, s_counts[twin], len(contexts))
            fresh = s_distinct[parent] - distinct
            some = fresh > 0
            denominator = np.where(some, left + s_pruned[parent], 1.0)
            made.below = np.log(denominator)
            # without any symbol left the escape is certain
            made.below_escape = np.log(np.where(some, fresh / 2 + s_pruned[parent], 1.0) / denominator)
        upper = (made, counts, distinct, stored, pruned)
        levels.append(made)
    small = lambda x: x.astype(np.float32)
    return [Level(x.grams, small(x.log_counts), x.contexts, small(x.log_top), small(x.escape), small(x.below), small(x.below_escape)) for x in levels]


class _Index:
    """Position of a key in an array, -1 if it isn't there: open addressing, all keys at a time."""

    def __init__(self, keys: np.ndarray):
        self.bits, self.keys = max(4, int(len(keys) * 2).bit_length()), np.append(keys, -1)
        self.at = np.full(1 << self.bits, -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.at[slot] < 0
            self.at[slot[free]] = todo[free]  # of several, the last one written stays
            won = self.at[slot] == todo
            todo, slot = todo[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.at[slot]
        other = np.flatnonzero(self.keys[found] != keys)  # an empty slot shows the last key, -1
        open_ = other[found[other] >= 0]
        found[other] = -1
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there = self.at[slot]
            same = self.keys[there] == keys[open_]
            found[open_[same]] = there[same]
            go = ~same & (there >= 0)
            open_, slot = open_[go], slot[go]
        return found


class Scorer:
    """Log probabilities of grams under the trie."""

    def __init__(self, levels: list[Level]):
        self.levels = levels
        self.grams, self.contexts = [_Index(x.grams) for x in levels], [_Index(x.contexts) for x in levels]
        self.rest = -np.log(max(1, SYMBOLS - len(levels[0].grams)))

    def log_probability(self, code: np.ndarray) -> np.ndarray:
        out = np.zeros(len(code))
        todo, last = np.arange(len(code)), np.full(len(code), -1)  # last: the context that was escaped, -1 for none
        for j in range(len(self.levels) - 1, -1, -1):
            here = self.levels[j]
            gram = code[todo] & ((1 << 8 * (j + 1)) - 1)
            at = self.grams[j].find(gram)
            hit = at >= 0
            a, above = at[hit], last[hit]
            value = here.log_top[a]
            if j + 1 < len(self.levels) and len(self.levels[j + 1].contexts):
                value = np.where(above >= 0, here.log_counts[a] - self.levels[j + 1].below[above], value)
            out[todo[hit]] += value
            todo, last, gram = todo[~hit], last[~hit], gram[~hit]
            context = self.contexts[j].find(gram >> 8)
            if j + 1 < len(self.levels) and len(self.levels[j + 1].contexts):
                after = self.levels[j + 1].below_escape[last]
            else:
                after = 0.0
            if len(here.contexts):
                out[todo] += np.where(last >= 0, after, np.where(context >= 0, here.escape[context], 0.0))
            last = context
        out[todo] += self.rest
        return out


@dataclass
class Model:
    """What scoring needs. In memory are the grams of contexts below BASE bytes, at most 1 / COMMON_SHARE
    grams of the longest contexts and at most 1 / HEAD_SHARE words; the rest is in tables."""

    key: str
    order: int
    levels: list[Level]  # those below BASE, and last the common grams of the longest contexts
    base: list[np.ndarray] = field(repr=False)  # level, gram, n, total below BASE
    least: float  # count of a stored gram
    common: float  # count of a gram in memory
    grams: DataFrame = field(repr=False)  # code, n, total: all longest grams
    head: dict[bytes, int]
    words: DataFrame = field(repr=False)  # word, n: all counts
    tokens: int = 0  # N
    distinct: int = 0  # V


def train(
    docs: DataFrame, text_col: str = "text", order: int = ORDER, share: float = 0.0, head_share: float = HEAD_SHARE, common_share: float = COMMON_SHARE
) -> Model:
    """The model of all texts of ``docs``. Without any row the trie is empty: every symbol is uniform.

    ``share`` above 0 prunes the grams below that share of all positions. ``common_share`` and ``head_share``
    only say what is kept in memory; results don't depend on them."""
    counts = count_grams_and_words(docs.select(F.col(text_col).cast("binary").alias("text")), order)
    grams, first = with_totals(counts), min(BASE, order)
    low = grams.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * first) - 1)).alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    column = lambda table, name: table.column(name).to_numpy().astype(np.int64)
    gram, n = column(low, "gram"), column(low, "n")
    least = share * n.sum()
    common = max(least, common_share * n.sum())
    base = stacked([stored(j, *shortened(gram, n, j + 1), least) for j in range(first)])
    top = grams.filter(F.col("n") >= common).toArrow()
    longest = (np.full(len(top), first), column(top, "code"), column(top, "n"), column(top, "total"))
    levels = build_levels(*stacked([tuple(base), longest]), order=first)
    words = counts.filter("code IS NULL").select("word", "n")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = words.filter(F.col("n") >= head_share * tokens).toArrow()
    head = dict(zip(head["word"].to_pylist(), head["n"].to_pylist()))
    return Model(uuid.uuid4().hex, order, levels, base, float(least), float(common), grams, head, words, tokens, distinct)


def unseen_logs(codes: DataFrame, model: Model) -> DataFrame:
    """``code`` (distinct, none of them stored) -> ``code, log``: natural logarithms by the shorter contexts."""
    spark, order, least, first = codes.sparkSession, model.order, model.least, min(BASE, model.order)
    shared = spark.sparkContext.broadcast(model.base)
    key = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * first) - 1)).alias("key")
    rows = model.grams.select(key, "code", "n").unionByName(codes.select(key, "code", F.lit(-1).cast("long").alias("n")))
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("log", T.DoubleType())])

    def solved(keys: np.ndarray, code: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        asked = n < 0
        wanted = np.unique(keys[asked])
        if len(wanted):
            near = ~asked & np.isin(keys, wanted)
            local = [stored(j, *shortened(code[near], n[near], j + 1), least) for j in range(first, order + 1)]
            levels = build_levels(*stacked([tuple(shared.value), *local]), order=order)
            ask, scorer = code[asked], Scorer(levels)
            for at in range(0, len(ask), 1 << 16):
                some = ask[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(scorer.log_probability(some))], names=["code", "log"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            size += batch.num_rows
            if size > _CHUNK:
                whole = [np.concatenate(x) for x in zip(*held)]
                cut = np.searchsorted(whole[0], whole[0][-1])  # the last key may go on
                if cut:
                    yield from solved(*(x[:cut] for x in whole))
                held = [[x[cut:] for x in whole]]
                size = 0 if not cut else len(held[0][0])  # a large key is looked at again after as many rows
        if held:
            yield from solved(*(np.concatenate(x) for x in zip(*held)))

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


_INDEXES: dict[str, _Index] = {}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **extra: Column) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, base_score, score`` and the ``extra`` columns.

    ``score`` is the log10 probability of the whole lower-cased text, its end included; ``base_score``
    that of its words and end under add-one word counts.

    Edge cases: a null text counts as empty (one token, the end). A very long text is scored whole, a
    megabyte at a time. Repeated rows are scored each. A null id is kept. An empty table gives an empty
    result. Other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.key, model.order, model.levels[-1].grams, model.levels[-1].log_top, {w: (np.log10(n + 1), n > 0) for w, n in model.head.items()}))
    made = [("row", "bigint"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("known_logs", "double"), ("score", "double"), ("tail", "array<binary>"), ("rest", "array<struct<code: bigint, times: bigint>>")]
    columns = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), *[c.alias(k) for k, c in extra.items()], F.col(text_col).cast("binary").alias("text"))
    carried = columns.schema[1:-1]
    schema = T.StructType([*carried, *T._parse_datatype_string(", ".join(f"`{a}` {b}" for a, b in made)).fields])

    def pieces(number: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``number, code, times``, each pair once."""
        by = np.lexsort((code, number))
        number, code = number[by], code[by]
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (number[1:] != number[:-1]))[: len(code)])
        return number[new], code[new], np.diff(np.append(new, len(code)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, order, grams, tops, head = shared.value
        index = _INDEXES.get(key)
        if index is None:
            _INDEXES.clear()
            index = _INDEXES[key] = _Index(grams)
        get = head.get
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                datas = [lowered(v) for v in batch.column(batch.num_columns - 1)]
                logs, rest = np.zeros(len(datas)), []
                for number, code in coded(datas, order):
                    at = index.find(code)
                    miss = at < 0
                    logs += np.bincount(number[~miss], tops[at[~miss]], len(datas))
                    rest.append(pieces(number[miss], code[miss]))
                rest = [np.concatenate(x) for x in zip(*rest)] or [np.zeros(0, np.int64)] * 3
                by = np.argsort(rest[0], kind="stable")
                ends = np.append(0, np.cumsum(np.bincount(rest[0], minlength=len(datas)))).astype(np.int32)
                left = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(rest[1][by]), pa.array(rest[2][by])], names=["code", "times"]))
                tokens, known, sums, tails = [], [], [], []
                for data in datas:
                    n, total, rare = 1, 0.0, []
                    end = get(b"")
                    total += end[0] if end else 0.0
                    for some in word_lists(data):
                        n += len(some)
                        for w in some:
                            v = get(w)
                            if v is None:
                                rare.append(w)
                            else:
                                total += v[0]
                    if end is None:
                        rare.append(b"")
                    tokens.append(n), known.append(n - len(rare)), sums.append(total), tails.append(rare)
                arrays = [*batch.columns[1:-1], batch.column(0), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(sums), pa.array(logs), pa.array(tails, pa.list_(pa.binary())), left]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    scored = written(columns.mapInArrow(run, schema), "ppm-scored")
    tail = scored.select("row", F.explode("tail").alias("word"))
    rare = (
        tail.join(model.words, "word").groupBy("row")
        .agg(F.count(F.lit(1)).alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_logs"))
    )
    others = model.grams.filter((F.col("n") >= model.least) & (F.col("n") < model.common)).select("code", (F.log(F.col("n") - 0.5) - F.log("total")).alias("log"))
    looked = written(
        scored.select("row", F.inline("rest")).join(others, "code", "left")
        .groupBy("row", F.when(F.col("log").isNull(), F.col("code")).alias("code"))
        .agg(F.sum(F.col("times") * F.col("log")).alias("log"), F.sum("times").alias("times")),
        "ppm-looked",
    )
    unseen = looked.filter("code IS NOT NULL").select("row", "code", "times")
    logs = unseen_logs(unseen.select("code").distinct(), model)
    missed = (
        looked.filter("code IS NULL").select("row", "log")
        .unionByName(unseen.join(logs, "code").select("row", (F.col("times") * F.col("log")).alias("log")))
        .groupBy("row").agg(F.sum("log").alias("missed_logs"))
    )
    every = np.log10(model.tokens + model.distinct + 1)
    nothing = F.lit(0.0)
    return scored.join(rare, "row", "left").join(missed, "row", "left").select(
        *[f.name for f in carried], "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("known_logs") + F.coalesce("rare_logs", nothing) - F.col("n_tokens") * F.lit(float(every))).alias("base_score"),
        ((F.col("score") + F.coalesce("missed_logs", nothing)) / float(np.log(10))).alias("score"),
    )
