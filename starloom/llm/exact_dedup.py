"""Exact deduplication by deterministic block naming.

1. A text is cut into fixed-size byte blocks. The distinct blocks are sorted and numbered: a block's
   integer *name* is its partition and its position in that order.
2. The names of adjacent blocks form pairs; the distinct pairs are sorted and named in turn. After
   ceil(log2(blocks)) rounds each text is one integer. Two texts with as many blocks get the same
   integer exactly when all their blocks are equal.

Blocks meet by a 64-bit digest, so the text is shuffled once and never joined back: only 8 bytes per
block return to the documents. The digest decides nothing: a digest group is accepted only if its
smallest and its largest block are equal. If any group holds two different blocks, the round is
repeated with another seed.

Scale: one shuffle of the blocks after map-side aggregation (copies within a task collapse there, so
a block held by a third of all rows arrives once per task), then 8-byte names. The joins back are
plain equi-joins, which AQE splits when one name is hot. A document's blocks are the only thing that
is gathered per key.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import checkpointed, text_or_empty

BLOCK_BYTES = 4096


def seeded_digest(block: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), block)


def _blocks(data: Column, block_bytes: int, each: Callable[[Column], Column]) -> Column:
    last = F.greatest(F.ceil(F.octet_length(data) / block_bytes) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: each(F.substring(data, i * block_bytes + 1, F.lit(block_bytes))))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    block_bytes: int = BLOCK_BYTES,
    digest: Callable[[Column, int], Column] = seeded_digest,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, n_bytes, n_blocks, name, text_sha256``.

    Rows with equal normalised texts form a group; ``(n_blocks, name)`` identifies it. The row with
    the largest id stays (null ids are smallest). Exactly one row per group is kept, also when rows
    repeat with the same id.

    Edge cases: a null text counts as empty; all empty texts form one group. A null id is kept only
    if its whole group has null ids. A very long text is many blocks and takes a naming round more for each
    doubling (256 MB: 16 rounds). An empty table gives an empty result. Other columns, whatever their names,
    are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), normalise(text_or_empty(text_col)).cast("binary").alias("data"))
    for seed in count():
        rows = checkpointed(
            source.select(
                "doc_id",
                F.octet_length("data").cast("long").alias("n_bytes"),
                F.sha2("data", 256).alias("text_sha256"),
                _blocks(F.col("data"), block_bytes, lambda b: digest(b, seed)).alias("digests"),
                F.monotonically_increasing_id().alias("rid"),
            )
        )
        named = checkpointed(
            source.select(F.explode(_blocks(F.col("data"), block_bytes, lambda b: b)).alias("block"))
            .groupBy(digest(F.col("block"), seed).alias("digest"))
            .agg(F.min("block").alias("low"), F.max("block").alias("high"))
            .sortWithinPartitions("low")
            .select("digest", (F.col("low") == F.col("high")).alias("pure"), F.monotonically_increasing_id().alias("name"))
        )
        if named.filter(~F.col("pure")).isEmpty():
            break
    # every row here is one block; a short text is finished after this join
    sequence = rows.select("rid", F.size("digests").alias("n_blocks"), F.posexplode("digests").alias("pos", "digest"))
    sequence = checkpointed(sequence.join(named, "digest").select("rid", "n_blocks", "pos", "name"))
    identity = _fold_pairs(sequence)
    # both sides of the last join are written: a join next to an aggregation of the same key would keep
    # the aggregation's partitioning, and a hot group could not be split
    facts = checkpointed(rows.select("rid", "doc_id", "n_bytes", "text_sha256").join(identity, "rid"))
    groups = checkpointed(facts.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    ))
    return facts.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        "n_bytes",
        "n_blocks",
        "name",
        "text_sha256",
    )


def _fold_pairs(sequence: DataFrame) -> DataFrame:
    """Name adjacent pairs until each ``rid`` has one name; returns ``rid, n_blocks, name``.

    Texts with equal block counts finish in the same round, so names are only ever compared within
    one round. Rounds end when the longest text is folded: log2 of its number of blocks.
    """
    done = sequence.filter("n_blocks = 1").select("rid", "n_blocks", "name")
    rest = sequence.filter("n_blocks > 1").withColumn("width", F.col("n_blocks"))
    while not rest.isEmpty():
        item = F.struct("pos", "name")
        pairs = (
            rest.groupBy("rid", "n_blocks", "width", F.expr("pos div 2").cast("int").alias("half"))
            .agg(F.min(item).alias("l"), F.max(item).alias("r"))
            # a last block without neighbour is paired with -1, which is no name
            .select(
                "rid", "n_blocks", F.expr("cast((width + 1) div 2 as int)").alias("width"), F.col("half").alias("pos"),
                F.col("l.name").alias("left"), F.when(F.col("l.pos") < F.col("r.pos"), F.col("r.name")).otherwise(F.lit(-1)).alias("right"),
            )
        )
        pairs = checkpointed(pairs)
        names = checkpointed(
            pairs.select("left", "right").distinct().sortWithinPartitions("left", "right").withColumn("name", F.monotonically_increasing_id())
        )
        folded = checkpointed(pairs.join(names, ["left", "right"]).select("rid", "n_blocks", "width", "pos", "name"))
        done = done.unionByName(folded.filter("width = 1").select("rid", "n_blocks", "name"))
        rest = folded.filter("width > 1")
    return done
