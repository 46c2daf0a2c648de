"""Periodic runs of words, found on a Re-Pair grammar of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and at least
``max(min_words, 2 q)`` words that no neighbouring word extends.

1. *Grammar.* Words become ids. Re-Pair replaces the most frequent pair of neighbouring symbols of a text
   by a new symbol until no pair occurs twice. All texts of a chunk are worked on together, and a round
   replaces every pair that is more frequent than all pairs overlapping it: such a pair is not changed by
   the less frequent ones, so the order among them does not matter. The symbols left at the end are joined
   by a balanced binary tree.
2. *Boundaries.* A run lies in a lowest node of the derivation and crosses the boundary between that node's
   two parts. So each nonterminal is searched once, at its first occurrence, for runs that cross its
   boundary. At least three neighbouring words on one side of the boundary return one period further, so the
   periods to try are the distances to equal triples within the node; each is extended exactly, word by
   word. A multiple of the period of a run that holds the same words is not extended again.
3. *Positions.* The runs of a nonterminal are moved to all the places where it replaced a pair.
4. *Merging.* Intervals of one period that overlap by a period or more are parts of one maximal run.

The work is one pass over Arrow batches of the texts: no shuffle, and a lost executor costs its task. A task holds
``CHUNK_BYTES`` of text (or one longer text) at a time, with some 300 bytes of work for each of its words.

Edge cases: a null or empty text, or one of white space, has no words, no runs and an empty collapsed text.
Very long texts are handled whole. Runs may tie in start or length; those that start at the same word differ
in their period. Repeated rows give repeated results and an empty table none. Only the two named columns are
read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_WORDS = 12
CHUNK_BYTES = 4 << 20

_RESULT = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
#: Words compared at once in the first extension; pairs of equal triples handled at once.
_NEAR = 16
_PAIRS = 1 << 20


def _named(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A dense name of each key, in key order, and the number of keys of each name."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    names = np.empty(len(key), np.int64)
    names[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(key) else 0
    return names, np.bincount(names, minlength=0)


class Grammar:
    """The Re-Pair grammars of the texts of one chunk; positions number the words of the whole chunk."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        n = len(ids)
        self.heads = np.ones(n, bool)  # where a symbol of the final sequences starts
        self.rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # start, middle and end of first occurrences
        self.places: list[tuple[np.ndarray, np.ndarray]] = []  # rule and position of every occurrence
        self.count = 0
        #: For the triples: the name of the pair at each position, and whether it is repeated in its text.
        self.pair, self.repeated = np.zeros(n, np.int64), np.zeros(n, bool)
        if n > 1:
            self._build(ids.astype(np.int64), doc)

    def _build(self, ids: np.ndarray, doc: np.ndarray) -> None:
        symbols, _ = _named(doc * (int(ids.max()) + 1) + ids)  # of a word in a text
        link = np.zeros(len(ids), bool)
        link[:-1] = doc[1:] == doc[:-1]
        at = np.flatnonzero(link)
        names, counts = _named(symbols[at] << 32 | symbols[at + 1])
        self.pair[at], self.repeated[at] = names, counts[names] > 1
        position, size, top = np.arange(len(ids)), np.ones(len(ids), np.int64), len(ids)
        wanted = self.repeated.copy()
        wanted[1:] |= self.repeated[:-1]
        while True:
            # only symbols beside a pair that can still be replaced
            kept = np.flatnonzero(wanted)
            if len(kept) < 2:
                return
            link = link[kept] & np.concatenate([kept[1:] == kept[:-1] + 1, [False]])
            symbols, position, size = symbols[kept], position[kept], size[kept]
            at = np.flatnonzero(link)
            twin = link.copy()
            twin[at] = symbols[at] == symbols[at + 1]
            # in a stretch of equal symbols, every second pair overlaps the one before
            index = np.arange(len(twin))
            odd = twin & ((index - np.maximum.accumulate(np.where(twin, -1, index))) % 2 == 0)
            at = at[~odd[at]]
            names, counts = _named(symbols[at] << 32 | symbols[at + 1])
            often = counts[names] > 1
            at, names = at[often], names[often]
            if not len(at):
                return
            rank = np.zeros(len(symbols) + 2, np.int64)  # of the pair at index - 1: its count, then any fixed order
            rank[at + 1] = counts[names] << 32 | (names * 2654435761 & 0xFFFFFFFF)
            free = np.ones(len(counts), bool)
            free[names[np.maximum(rank[at], rank[at + 2]) > rank[at + 1]]] = False
            chosen = free[names]
            first, places, rule = np.unique(names[chosen], return_index=True, return_inverse=True)
            left = at[chosen]
            right = left + 1
            self.places.append((rule + self.count, position[left]))
            self.rules.append((position[left[places]], position[right[places]], position[right[places]] + size[right[places]]))
            self.count += len(first)
            symbols[left], top = top + rule, top + len(first)
            size[left] += size[right]
            link[left] = link[right]
            self.heads[position[right]] = False
            wanted = np.zeros(len(symbols), bool)
            still = at[~chosen]
            wanted[still] = wanted[still + 1] = wanted[left] = True
            gone = np.zeros(len(symbols), bool)
            gone[right] = True
            stay = np.flatnonzero(~gone)
            symbols, position, size, link, wanted = symbols[stay], position[stay], size[stay], link[stay], wanted[stay]
            fresh = np.flatnonzero(symbols >= top - len(first))
            wanted[fresh[fresh > 0] - 1] = True
            wanted[fresh[fresh + 1 < len(wanted)] + 1] = True

    def nodes(self, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, middle and end of the first occurrence of every node: first the rules', then those of the
        balanced trees over the final sequences. The node of the j-th symbol's boundary reaches as many
        symbols to both sides as the largest power of two that divides j."""
        heads = np.flatnonzero(self.heads)
        before = np.searchsorted(heads, bounds)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(before))
        j = np.arange(len(heads)) - before[doc]
        inner = np.flatnonzero(j)
        reach = j[inner] & -j[inner]
        ends = np.concatenate([heads, [bounds[-1]]])
        low = heads[inner - reach]
        high = ends[np.minimum(inner + reach, before[doc[inner] + 1])]
        parts = [*zip(*self.rules), *([()] * 3 if not self.rules else [])]
        return tuple(np.concatenate([*p, q]) for p, q in zip(parts, (low, heads[inner], high)))


def _triples(grammar: Grammar, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position the name of its three words (-1 if they occur once in the text), and the sorted
    ``name * n + position`` of all occurrences."""
    n = len(doc_end)
    name = np.full(n, -1, np.int64)
    if n > 2:
        at = np.flatnonzero(grammar.repeated[:-1] & grammar.repeated[1:])
        at = at[at + 2 < doc_end[at]]
        names, counts = _named(grammar.pair[at] << 32 | grammar.pair[at + 1])
        again = counts[names] > 1
        name[at[again]] = names[again]
    at = np.flatnonzero(name >= 0)
    return name, np.sort(name[at] * n + at)


def _equal(ids: np.ndarray, a: int, b: int, step: int, most: int) -> int:
    """For how many words, up to ``most``, ``ids`` agrees from ``a`` and ``b`` on (``step`` -1: backwards)."""
    done, width = 0, 64
    while done < most:
        k = min(width, most - done)
        if step > 0:
            differ = ids[a + done : a + done + k] != ids[b + done : b + done + k]
        else:
            differ = (ids[a - done - k + 1 : a - done + 1] != ids[b - done - k + 1 : b - done + 1])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done, width = done + k, width * 4
    return most


def _extended(ids: np.ndarray, a: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from ``a`` on, and before ``a``, are equal to those ``p`` further, up to _NEAR."""
    t = np.arange(_NEAR)
    on = a[:, None] + t
    inside = on + p[:, None] < high[:, None]
    on = np.where(inside, on, 0)
    ahead = inside & (ids[on] == ids[np.where(inside, on + p[:, None], 0)])
    back = a[:, None] - 1 - t
    inside = back >= low[:, None]
    back = np.where(inside, back, 0)
    behind = inside & (ids[back] == ids[np.where(inside, back + p[:, None], 0)])
    return tuple(np.where(x.all(axis=1), _NEAR, (~x).argmax(axis=1)) for x in (ahead, behind))


def _crossing(ids: np.ndarray, nodes: tuple, name: np.ndarray, occurrences: np.ndarray, min_words: int) -> np.ndarray:
    """Rows ``node, start, end, period``: the runs that cross the boundary of each node, within the node."""
    low, middle, high = nodes
    n = len(ids)
    found = [np.zeros((0, 4), np.int64)]
    for shift in (0, -2):
        node = np.flatnonzero((high - low >= min_words) & (middle + shift >= low) & (middle + shift + 3 <= high))
        node = node[name[middle[node] + shift] >= 0]
        anchor = middle[node] + shift
        first = np.searchsorted(occurrences, name[anchor] * n + low[node])
        many = np.searchsorted(occurrences, name[anchor] * n + high[node] - 2) - first
        done = np.concatenate([[0], np.cumsum(many)])
        at = 0
        while at < len(node):  # blocks of nodes; a node with more pairs than a block is cut into blocks, too
            to = max(at + 1, int(np.searchsorted(done, done[at] + _PAIRS, side="right")) - 1)
            for skip in range(0, max(1, int(done[to] - done[at])), _PAIRS):
                k = np.arange(skip, min(skip + _PAIRS, int(done[to] - done[at])))
                which = np.searchsorted(done[at : to + 1] - done[at], k, side="right") - 1 + at
                other = occurrences[first[which] + k - (done[which] - done[at])] % n
                found += _tried(ids, node[which], anchor[which], other, nodes, min_words)
            at = to
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # the same words at the same node: the smallest period, the others are its multiples
    fresh = np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]) if len(rows) else np.zeros(0, bool)
    return rows[fresh]


def _tried(ids: np.ndarray, node: np.ndarray, anchor: np.ndarray, other: np.ndarray, nodes: tuple, min_words: int) -> list[np.ndarray]:
    p, a = np.abs(other - anchor), np.minimum(other, anchor)
    use = (p > 0) & (2 * p <= nodes[2][node] - nodes[0][node])
    node, p, a = node[use], p[use], a[use]
    low, high = nodes[0][node], nodes[2][node]
    ahead, behind = _extended(ids, a, p, low, high)
    open_ = ((ahead == _NEAR) & (a + p + _NEAR < high)) | ((behind == _NEAR) & (a - _NEAR > low))
    start, end = a - behind, a + ahead + p
    whole = ~open_ & (end - start >= np.maximum(min_words, 2 * p))
    found = [np.stack([node[whole], start[whole], end[whole], p[whole]], axis=1)]
    rest = np.flatnonzero(open_)
    rest = rest[np.lexsort((p[rest], node[rest]))]
    at, known = -1, []
    for i, v, q, x, lo, hi in zip(rest, *(c[rest].tolist() for c in (node, p, a, low, high))):
        if v != at:
            at, known = v, []
        if any(q % r == 0 and x >= s and x + q < e for s, e, r in known):
            continue
        e = x + q + _equal(ids, x, x + q, 1, hi - x - q)
        s = x - _equal(ids, x - 1, x + q - 1, -1, x - lo)
        if e - s >= 2 * q:
            known.append((s, e, q))
            if e - s >= min_words:
                found.append(np.array([[v, s, e, q]]))
    return found


def find_runs(ids: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """``ids`` of the words of several texts, text ``d`` being ``ids[bounds[d] : bounds[d + 1]]`` -> rows
    ``start, end, period`` by start and period; positions are those in ``ids``."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    grammar = Grammar(ids, doc)
    name, occurrences = _triples(grammar, bounds[doc + 1])
    if not len(occurrences):
        return np.zeros((0, 3), np.int64)
    nodes = grammar.nodes(bounds)
    crossing = _crossing(ids, nodes, name, occurrences, min_words)
    node, start, end, period = crossing.T
    tree = node >= grammar.count
    parts = [crossing[tree, 1:]]
    if not tree.all():
        rule, place = (np.concatenate(c) for c in zip(*grammar.places))
        order = np.argsort(rule, kind="stable")
        place, first = place[order], np.searchsorted(rule[order], np.arange(grammar.count + 1))
        node, start, end, period = crossing[~tree].T
        many = first[node + 1] - first[node]
        row = np.repeat(np.arange(len(node)), many)
        move = place[first[node[row]] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)] - nodes[0][node[row]]
        parts.append(np.stack([start[row] + move, end[row] + move, period[row]], axis=1))
    return _merged(np.concatenate(parts))


def _merged(rows: np.ndarray) -> np.ndarray:
    """Maximal intervals: those of one period that share at least that many words become one."""
    if not len(rows):
        return rows
    start, end, period = rows[np.lexsort((rows[:, 0], rows[:, 2]))].T
    reach = int(end.max()) + 1
    group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * reach
    last = np.maximum.accumulate(group + end) - group
    fresh = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] > last[:-1] - period[1:])])
    first = np.flatnonzero(fresh)
    merged = np.stack([start[first], np.maximum.reduceat(end, first), period[first]], axis=1)
    return merged[np.lexsort((merged[:, 2], merged[:, 0]))]


def _analysed(texts: pa.Array, min_words: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each text the number of words, the runs and the collapsed text."""
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    words, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    bounds = before[offsets]
    words = words.filter(pa.array(real))
    runs = find_runs(words.dictionary_encode().indices.to_numpy(), bounds, min_words)
    start, end, period = runs.T
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    kept = np.cumsum(step[:-1]) == 0
    after = np.concatenate([[0], np.cumsum(kept)])[bounds]
    lists = pa.ListArray.from_arrays(pa.array(after, pa.int32()), words.filter(pa.array(kept)))
    doc = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - bounds[doc], end - start, period)], fields=list(_RUN))
    runs_of = pa.ListArray.from_arrays(pa.array(first, pa.int32()), items)
    return pa.array(np.diff(bounds), pa.int64()), runs_of, pc.binary_join(lists, " ")


def detect_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (array of ``start, length, period``, by start and
    period) and ``collapsed``: the words, joined by one space, without those that a run holds after its
    first period. ``min_words`` is 9 at least, so that half a run has the five words around a boundary
    that hold a triple on one side of it."""
    if min_words < 9:
        raise ValueError("min_words must be at least 9")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([narrow.schema["doc_id"], *T._parse_datatype_string(_RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1), 0
            sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + chunk_bytes, side="right")))
                part = _analysed(texts.slice(at, end - at), min_words)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), *part], names=["doc_id", "n_words", "runs", "collapsed"])
                at = end

    return narrow.mapInArrow(run, schema)
