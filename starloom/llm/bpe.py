"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

A text is split by the tokenizer's pattern; each piece (a *word* here) is encoded on its own: from its
bytes on, the adjacent pair whose joined bytes have the lowest rank is merged, leftmost first, until no
pair has a rank.

Two forms of the same fold:

* ``encode_words`` is the fold in Spark higher-order functions, over the byte arrays of distinct words,
  with the rank table as a literal. It interprets every pair of every step, and joining distinct words
  back to all their positions shuffles every position (README has the figures), so it serves small
  inputs and as a second implementation in the tests.
* ``encode`` runs in Arrow batches: the distinct words of a batch are folded together in numpy, one merge
  per word and step, and remembered up to a bound. No shuffle; memory does not depend on the input.

Token ids are exchanged as little-endian unsigned 32-bit integers in a binary column, the form in which
training shards store them.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import let

#: Words remembered per Python worker; longer words are folded one by one with a heap.
CACHE_WORDS = 1 << 18
LONG_BYTES = 64
#: Words of one text that are held at a time.
TEXT_WORDS = 1 << 20

_SHIFT = 20
_NONE = np.int64(1) << 40
_HASH_BITS = 20
_HASH = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """The vocabulary: token bytes by rank, and the rank of every pair of tokens that can merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.pieces[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {
            (ranks[t[:i]] << _SHIFT) | ranks[t[i:]]: rank
            for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        }
        keys = np.fromiter(self.pairs.keys(), np.int64, len(self.pairs))
        slots = self._slot(keys)
        order = np.argsort(slots, kind="stable")
        self._keys, self._values = keys[order], np.fromiter(self.pairs.values(), np.int64, len(keys))[order]
        self._first = np.searchsorted(slots[order], np.arange((1 << _HASH_BITS) + 1))
        self._depth = int(np.diff(self._first).max(initial=0))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _HASH) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, _NONE where there is none."""
        keys = (left << _SHIFT) | right
        slots = self._slot(keys)
        at, end = self._first[slots], self._first[slots + 1]
        found = np.full(len(keys), _NONE)
        todo = np.flatnonzero(at < end)
        for _ in range(self._depth):  # the fullest hash slot
            todo = todo[at[todo] < end[todo]]
            if not len(todo):
                break
            hit = self._keys[at[todo]] == keys[todo]
            found[todo[hit]] = self._values[at[todo[hit]]]
            todo = todo[~hit]
            at[todo] += 1
        return found

    def encode_long(self, word: bytes) -> bytes:
        """One word with a heap of its pairs, for words of any length."""
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := get(ids[i] << _SHIFT | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (r := get(ids[a] << _SHIFT | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """All words at once: each step merges the lowest pair of every word that still has one."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        result = [b""] * len(words)
        while len(ids):
            rank = np.full(len(ids), _NONE)
            inner = np.flatnonzero(word[:-1] == word[1:])
            rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat((rank << 22) | (np.arange(len(ids)) & ((1 << 22) - 1)), starts)
            has = (lowest >> 22) < _NONE
            ends = np.append(starts[1:], len(ids))
            done = np.flatnonzero(~has)
            plain = ids.astype("<u4")
            for w, a, b in zip(word[starts[done]].tolist(), starts[done].tolist(), ends[done].tolist()):
                result[w] = plain[a:b].tobytes()
            at = lowest[has] & ((1 << 22) - 1)
            ids[at] = lowest[has] >> 22
            keep = np.repeat(has, ends - starts)
            keep[at + 1] = False
            ids, word = ids[keep], word[keep]
        return result


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    """Once per process; the file is read where the task runs, from a path that every node has."""
    return Ranks(path)


def ascii_form(pattern: str) -> str | None:
    """The pattern for texts of ASCII only, in the standard library's syntax, which matches them twice as
    fast; None if it has Unicode classes other than letters and numbers."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        if pattern.startswith(("\\p", "\\P"), at):
            ranges = {"\\p{L}": "A-Za-z", "\\p{N}": "0-9"}.get(pattern[at : at + 5])
            if ranges is None:
                return None
            out.append(ranges if inside else f"[{ranges}]")
            at += 5
            continue
        if pattern[at] == "\\":
            out.append(pattern[at : at + 2])
            at += 2
            continue
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        out.append(pattern[at])
        at += 1
    return "".join(out)


class Encoder:
    """Encodes texts, remembering the words seen last."""

    def __init__(self, path: str, pattern: str, cache_words: int = CACHE_WORDS):
        self.ranks, self.limit = load_ranks(path), cache_words
        self.find_any, self.iterate = regex.compile(pattern).findall, regex.compile(pattern).finditer
        plain = ascii_form(pattern)
        self.find_ascii = re.compile(plain, re.ASCII).findall if plain else self.find_any
        self.known: dict[str, bytes] = {}

    def find(self, text: str) -> list[str]:
        return self.find_ascii(text) if text.isascii() else self.find_any(text)

    def fold(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct words."""
        out: dict[str, bytes] = {}
        for at in range(0, len(words), 1 << 15):  # 2 ** 15 words of 64 bytes: 21 bits number their bytes
            part = words[at : at + (1 << 15)]
            raw = [w.encode("utf-8", "surrogatepass") for w in part]
            short = [i for i, b in enumerate(raw) if len(b) <= LONG_BYTES]
            out.update(zip([part[i] for i in short], self.ranks.encode_many([raw[i] for i in short])))
            out.update((part[i], self.ranks.encode_long(b)) for i, b in enumerate(raw) if len(b) > LONG_BYTES)
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known.clear()
        found = [self.find(t) if t and len(t) < TEXT_WORDS else [] for t in texts]
        self.known.update(self.fold(list(set().union(*found).difference(self.known))))
        get = self.known.__getitem__
        return [self._long(t) if t and len(t) >= TEXT_WORDS else b"".join(map(get, w)) for t, w in zip(texts, found)]

    def _long(self, text: str) -> bytes:
        """A text of very many words, a part at a time; its words are not remembered."""
        matches, out = self.iterate(text), []
        while part := [m.group() for m in islice(matches, TEXT_WORDS)]:
            distinct = set(part)
            ids = self.fold([w for w in distinct if w not in self.known])
            ids.update((w, self.known[w]) for w in distinct if w in self.known)
            out.append(b"".join(map(ids.__getitem__, part)))
        return b"".join(out)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text (binary, 4 bytes each, little-endian). A null text counts as empty and gives
    no ids; a text of any length is encoded whole. Special tokens are ordinary text."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        encoder = _ENCODERS.get((path, pattern)) or _ENCODERS.setdefault((path, pattern), Encoder(path, pattern))
        out = []
        for at in range(0, len(texts), 256):
            out += encoder.encode(texts.slice(at, 256).to_pylist())
        return pa.array(out, pa.binary())

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes of token ids as given by ``encode``: their pieces, concatenated. Null gives no bytes."""

    @F.arrow_udf("binary")
    def run(encoded: pa.Array) -> pa.Array:
        piece = load_ranks(path).pieces.__getitem__
        return pa.array([b"".join(map(piece, np.frombuffer(x.as_buffer(), "<u4").tolist())) if x.is_valid else b"" for x in encoded], pa.binary())

    return run(ids)


def encode_documents(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``ids`` and ``n_tokens`` (columns of those names are replaced). Row by row: repeated
    rows, null ids and an empty table need no special rule."""
    return docs.withColumn("ids", encode(F.col(text_col), path, pattern)).withColumn("n_tokens", F.expr("octet_length(ids) div 4"))


# --- the fold as higher-order functions -----------------------------------------------------------


def rank_literal(ranks: Ranks, slots: int = 1 << 16) -> Column:
    """The pair ranks as one literal: ``array<map<bigint,int>>`` by ``pair % slots``, because a map of
    Spark is searched from its start."""
    table: list[dict[int, int]] = [{} for _ in range(slots)]
    for pair, rank in ranks.pairs.items():
        table[pair % slots][pair] = rank
    text = "[" + ",".join("{" + ",".join(f'"{k}":{v}' for k, v in t.items()) + "}" for t in table) + "]"
    return F.from_json(F.lit(text), "array<map<string,int>>")


def encode_words(word: Column, ranks: Ranks, literal: Column, slots: int = 1 << 16) -> Column:
    """Token ids (array<int>) of one word, folded by built-in functions."""
    byte_ids = F.lit(ranks.bytes.astype(np.int32))
    raw = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.get(byte_ids, F.conv(F.hex(F.substring(word.cast("binary"), i, F.lit(1))), 16, 10).cast("int")))

    def step(ids: Column, _: Column) -> Column:
        def candidate(x: Column, i: Column) -> Column:
            pair = x.cast("long") * (1 << _SHIFT) + F.get(ids, i + 1)
            rank = F.try_element_at(F.get(literal, (pair % slots).cast("int")), pair.cast("string"))
            return F.struct(F.coalesce(rank, F.lit(1 << 30)).alias("rank"), i.alias("i"))

        best = F.array_min(F.transform(F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))), candidate))
        merge = lambda b: F.when(b.isNull() | (b["rank"] == 1 << 30), ids).otherwise(
            F.concat(F.slice(ids, F.lit(1), b["i"]), F.array(b["rank"]), F.slice(ids, b["i"] + 3, F.size(ids)))
        )
        return let(best, merge)

    return F.when(F.octet_length(word) == 0, F.array().cast("array<int>")).otherwise(
        let(raw, lambda r: F.aggregate(F.sequence(F.lit(1), F.size(r)), r, step))
    )


def encode_documents_by_join(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (array<int>) by the higher-order fold over the distinct words of all documents,
    joined back to every position. ``pattern`` must be in Java's syntax; small inputs only."""
    ranks = load_ranks(path)
    words = docs.select("doc_id", F.posexplode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("(?U)" + pattern), F.lit(0))).alias("pos", "word"))
    coded = words.select("word").distinct().withColumn("w", encode_words(F.col("word"), ranks, rank_literal(ranks)))
    joined = words.join(coded, "word").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "w"))).alias("parts"))
    return joined.select("doc_id", F.flatten(F.col("parts.w")).alias("ids"))
