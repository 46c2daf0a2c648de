"""SimHash near-duplicates by multi-index hashing.

Fingerprints: 64 bits; bit *b* is set if it is set in more than half of the XXH64 values (seed 42) of
a text's word shingles, repeats included. Texts link when their fingerprints differ in at most
``max_bits`` bits.

Links, over distinct fingerprints (copies collapse first):

* A fingerprint is cut into two segments, the upper and the lower half, and stored in one table per
  segment. With two bits to spend, either the upper halves differ by at most one bit or the lower
  halves are equal. So a fingerprint looks up the 33 values of the Hamming ball of radius 1 around its
  upper half in the first table, and its own lower half in the second. In general the first segments
  get radius ``max_bits // segments`` and the others one less (the pigeonhole bound).
* Every table match is verified by the number of differing bits of the whole fingerprint.
* A table cell holding more than ``crowded`` fingerprints would yield all pairs of its members, so it
  is not expanded. The fingerprints in such cells and those that look one up take another exact route:
  each is entered at the centres of its whole Hamming ball (radius ``max_bits / 2``); the members of a
  centre all lie within ``max_bits`` of each other, so linking each to the smallest of them, again
  verified, connects exactly what the pairs would, with rows in proportion to the members.

Components come from alternating large-star and small-star rounds, each a partial aggregation and an
equi-join, checkpointed to the shared folder. Nothing but the count of changed links reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import checkpointed

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 2
CROWDED = 64
#: Fingerprints whose balls (65 values each, with 2 bits) one task enumerates.
TASK_FINGERPRINTS = 1 << 13
_SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one text; 0 for a null text or one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):  # bounds the unpacked bits of a very long text
        part = [h(joined[a:b], _SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])]
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a bigint with the same 64 bits."""

    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle_words) for t in texts], np.uint64).view(np.int64), pa.int64())

    return run(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(bits: range, radius: int) -> list[int]:
    """All XOR masks of at most ``radius`` of ``bits``, as signed 64-bit integers."""
    return [_signed(sum(1 << b for b in some)) for r in range(radius + 1) for some in combinations(bits, r)]


def _ball(fp: Column, bits: range, radius: int) -> Column:
    return F.transform(F.lit(np.array(_masks(bits, radius), np.int64)), lambda m: m.bitwiseXOR(fp))


def _cells(segment: int, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(segment).alias("segment"), v.alias("value")))


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowded: int = CROWDED) -> DataFrame:
    """Distinct fingerprints ``fp`` -> links ``a < b`` (bigint) whose components are those of all
    pairs within ``max_bits``. ``max_bits`` must be even when cells are crowded (centres of balls)."""
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    size = 64 // segments
    ranges = [range(64 - size * (s + 1), 64 - size * s) for s in range(segments - 1)] + [range(0, 64 - size * (segments - 1))]
    radius, spare = divmod(max_bits, segments)
    keep = [_signed(sum(1 << b for b in r)) for r in ranges]
    fp = F.col("fp")
    entry = lambda s: F.struct(F.lit(s).alias("segment"), fp.bitwiseAND(F.lit(keep[s])).alias("value"))
    table = fps.select("fp", F.explode(F.array(*map(entry, range(segments)))).alias("e")).select("fp", "e.*")
    probes = []
    for s in range(segments):
        r = radius if s <= spare else radius - 1
        if r >= 0:
            probes.append(_cells(s, _ball(fp.bitwiseAND(F.lit(keep[s])), ranges[s], r)))
    probe = fps.select(fp.alias("probe"), F.explode(F.concat(*probes)).alias("e")).select("probe", "e.*")

    cells = checkpointed(table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")))
    small = (
        table.join(cells.filter(F.col("n") <= crowded), ["segment", "value"])
        .groupBy("segment", "value").agg(F.collect_list("fp").alias("members"))  # at most `crowded`
    )
    full = cells.filter(F.col("n") > crowded).select("segment", "value", F.lit(None).cast("array<bigint>").alias("members"))
    near = lambda m: (m > F.col("probe")) & (F.bit_count(m.bitwiseXOR(F.col("probe"))) <= max_bits)
    found = probe.join(small.unionByName(full), ["segment", "value"]).select(
        "probe", F.col("members").isNull().alias("crowd"), F.filter("members", near).alias("near")
    ).filter(F.col("crowd") | (F.size("near") > 0))
    found = checkpointed(found)
    pairs = found.filter(~F.col("crowd")).select(F.col("probe").alias("a"), F.explode("near").alias("b"))

    # every member of a crowded cell looks up its own value, so `found` holds both sides of its pairs
    crowd = checkpointed(found.filter("crowd").select(F.col("probe").alias("fp")).distinct())
    # few bytes become many rows; a stated number of partitions is not merged before that
    crowd = crowd.repartition(max(1, -(-crowd.count() // TASK_FINGERPRINTS)), "fp")
    centred = checkpointed(crowd.select("fp", F.explode(_ball(fp, range(64), max_bits // 2)).alias("centre")))
    stars = centred.groupBy("centre").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z").select("centre", "a")
    stars = centred.join(stars, "centre").select("a", F.col("fp").alias("b")).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Links ``a, b`` (bigint) -> ``node, root``: the smallest node of each component.

    Large-star links every larger neighbour of a node to the smallest node around it, small-star every
    smaller one; alternating until nothing changes leaves one star per component (O(log^2 n) rounds).
    """
    flip = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    before = None
    while True:
        both = flip(edges)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # small-star: in (a < b), b is the centre and its smaller neighbours are linked to their least
        large = checkpointed(large)
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select("m", "a", "b")
        small = small.select("m", F.explode(F.array("a", "b")).alias("b")).filter("m < b").select(F.col("m").alias("a"), "b").distinct()
        edges = checkpointed(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    segments: int = SEGMENTS,
    crowded: int = CROWDED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: the columns ``carry``, ``doc_id, fp`` (bigint), ``root`` (the component's
    smallest fingerprint), ``component_id, component_size``.

    ``component_id`` is the smallest id among all rows reachable by links, itself included.

    Edge cases: a null or empty text has fingerprint 0 and links like any other. Repeated rows share a
    fingerprint, so they are always in one component. Null ids are ignored by the minimum; a component
    of null ids only has a null ``component_id``. Very long texts are hashed whole, shingle by shingle. An
    empty table gives an empty result. Other columns are ignored.
    """
    marked = checkpointed(docs.select(*carry, F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col), shingle_words).alias("fp")))
    groups = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    roots = components(links(groups.select("fp"), max_bits, segments, crowded))
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    labels = rooted.join(whole, "root").select("fp", "root", "component_id", "component_size")
    return marked.join(labels, "fp").select(*carry, "doc_id", "fp", "root", "component_id", "component_size")
