"""Mixing sources to target weights.

1. *Pack.* Each source's words form one stream (documents in a hash order), cut into blocks of
   ``block_words``. A block is a list of pieces: (document, first word, number of words).
2. *Draw.* The mix has as many slots as the targets have blocks, ``shard_slots`` per output shard. The
   source counts of each shard are drawn at random, multinomially given the totals: every source puts
   its number of tickets into one urn, and a pseudorandom permutation of the tickets deals them to the
   slots. So shards vary as independent draws do, while each source's total is exact; a plain
   multinomial would miss the targets by chance and could exceed a source's limit.
3. *Map.* The slots of a source are numbered across the shards; number ``j`` reads block
   ``permutation(source, epoch)(j mod blocks)`` with ``epoch = j div blocks``. Each epoch visits every
   block once, so no document is repeated more often than its source has epochs.
4. *Join* the slots with the blocks' pieces by (source, block index).

Everything is built-in functions. Hash values replace random numbers, so reruns agree.

Scale: the text is scanned once for its word counts. Running totals are two-level sums, so a source
with a third of all rows is spread over its hash buckets; block indexes spread the join. Per-source
tables have one row per source and are never gathered into a literal or broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.ranking import distributed_row_number
from starloom.functions.scan import SUM, Running, running
from starloom.llm.common import WORD, WS_CLASS, checkpointed, let, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 1024
SEED = 17
#: Documents per hash bucket, buckets or shards per running-total group, tickets per generated chunk.
BUCKET_DOCS = 1000
GROUP = 1000
CHUNK = 1 << 16
#: Slots drawn and mapped by one task.
TASK_SLOTS = 1 << 18

_WALKS = 64


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Position of ``x`` (bigint, 0 <= x < n) in a pseudorandom permutation of 0 .. n-1.

    A four-round Feistel network over a grid of a x b >= n cells, a = ceil(sqrt(n)): each round adds a
    hash of one coordinate to the other, so every round is a bijection. The fewer than ``a`` cells
    beyond n are walked through until the value is below n, which keeps it a bijection on 0 .. n-1.
    A walk of _WALKS steps has a chance of n ** -(_WALKS / 2); for n <= _WALKS ** 2 it cannot happen.
    """
    def grid(a: Column) -> Column:
        b = F.ceil(n / a).cast("long")

        def rounds(v: Column) -> Column:
            step = lambda to, by, size, i: F.pmod(to + F.pmod(F.xxhash64(*key, F.lit(i), by), size), size)
            first = lambda s: F.struct(step(s["l"], s["r"], a, 1).alias("l"), s["r"].alias("r"))
            second = lambda s, i: F.struct(s["l"].alias("l"), step(s["r"], s["l"], b, i).alias("r"))
            third = lambda s: F.struct(step(s["l"], s["r"], a, 3).alias("l"), s["r"].alias("r"))
            start = F.struct(F.call_function("div", v, b).alias("l"), F.pmod(v, b).alias("r"))
            return let(let(let(let(start, first), lambda s: second(s, 2)), third), lambda s: let(second(s, 4), lambda e: e["l"] * b + e["r"]))

        walk = lambda v: F.aggregate(F.sequence(F.lit(1), F.lit(_WALKS)), v, lambda at, _: F.when(at < n, at).otherwise(rounds(at)))
        return let(rounds(x), lambda v: F.when(v < n, v).otherwise(walk(v)))

    return F.when(n == 1, F.lit(0).cast("long")).otherwise(let(F.ceil(F.sqrt(n.cast("double"))).cast("long"), grid))


def running_before(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, group: int = GROUP) -> DataFrame:
    """Add ``out``: the sum of ``value`` over rows of the same keys with a smaller ``order`` (unique
    per key, bigint). Sums of ``group`` consecutive numbers first, so that no task orders a whole key."""
    grouped = df.withColumn("__g", F.expr(f"{order} div {group}"))
    sums = grouped.groupBy(*keys, "__g").agg(F.sum(value).alias("__sum"))
    earlier = lambda part, by: Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier(keys, "__g")), F.lit(0))).drop("__sum")
    within = F.coalesce(F.sum(value).over(earlier([*keys, "__g"], order)), F.lit(0))
    joined = grouped.withColumn(out, within).join(sums, [*keys, "__g"])
    return joined.withColumn(out, F.col(out) + F.col("__base")).drop("__g", "__base")


def mix_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``(source, source_size)`` -> plus ``sid`` (rank by code point, null last), ``target`` and the
    numbers of ``blocks`` and ``slots``. The targets share the sum of all sizes by weight; a target
    above ``max_repeats`` times its size stops there and its excess is shared by weight among the rest.
    """
    ranked = distributed_row_number(sources, [], [F.col("source").asc_nulls_last()], out="sid")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = checkpointed(ranked.withColumn("weight", weight.cast("long")))
    limit = max_repeats * F.col("source_size")
    total, weights_sum = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # by limit over weight, the sources that stop come first; each in turn shares what those before it leave
    ordered = running(ranked.select("sid", "weight", limit.alias("limit")), [], [F.col("limit") / F.col("weight"), "sid"], {
        "limits": Running(SUM, F.col("limit")), "weights": Running(SUM, F.col("weight")),
    })
    share = (F.lit(total) - F.col("limits") + F.col("limit")) / (F.lit(weights_sum) - F.col("weights") + F.col("weight"))
    goes_on = ordered.withColumn("share", share).filter(F.col("share") * F.col("weight") <= F.col("limit"))
    share = goes_on.agg(F.min_by("share", F.struct(F.col("limit") / F.col("weight"), "sid"))).first()[0]
    at_limit = F.lit(float("inf") if share is None else share) * F.col("weight") > limit
    share = 0.0 if share is None else share
    target = F.when(at_limit, limit.cast("double")).otherwise(F.lit(share) * F.col("weight"))
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    slots = F.least(F.round(target * blocks / F.greatest(F.col("source_size"), F.lit(1))).cast("long"), max_repeats * blocks)
    return ranked.select("source", "source_size", "sid", target.alias("target"), blocks.alias("blocks"), slots.alias("slots"))


def draw_slots(targets: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``shard, slot, sid, epoch, block``: which block of which source fills each slot of the mix."""
    targets = running_before(targets.select("sid", "blocks", "slots"), [], "sid", "slots", "before")
    n_slots = targets.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    # few rows become many; a stated number of partitions is not merged before that
    tasks = max(1, -(-n_slots // TASK_SLOTS))
    chunks = targets.filter("slots > 0").select("*", F.explode(F.expr(f"sequence(0, (slots - 1) div {CHUNK})")).alias("chunk"))
    tickets = (
        chunks.repartition(tasks, "sid", "chunk")
        .select("*", F.explode(F.expr(f"sequence(chunk * {CHUNK}, least(slots, (chunk + 1) * {CHUNK}) - 1)")).alias("j"))
        .select("sid", "blocks", permuted(F.col("before") + F.col("j"), F.lit(n_slots).cast("long"), F.lit(seed)).alias("t"))
    )
    counts = checkpointed(tickets.groupBy(F.expr(f"t div {shard_slots}").alias("shard"), "sid", "blocks").agg(F.count(F.lit(1)).alias("n")))
    counts = running_before(counts, ["sid"], "shard", "n", "first")
    in_shard = Window.partitionBy("shard")
    counts = counts.withColumns({
        "offset": F.coalesce(F.sum("n").over(in_shard.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "width": F.sum("n").over(in_shard),
    })
    counts = counts.repartition(tasks, "shard", "sid")
    slots = counts.select("*", F.explode(F.expr("sequence(0L, n - 1)")).alias("k")).withColumns({"j": F.col("first") + F.col("k"), "at": F.col("offset") + F.col("k")})
    slots = slots.withColumns({"epoch": F.expr("j div blocks"), "index": F.expr("j % blocks")})
    return slots.select(
        "shard", permuted(F.col("at"), F.col("width"), F.lit(seed + 1), F.col("shard")).alias("slot"), "sid", "epoch",
        permuted(F.col("index"), F.col("blocks"), F.lit(seed + 2), F.col("sid"), F.col("epoch")).alias("block"),
    )


def pack_blocks(sized: DataFrame, block_words: int = BLOCK_WORDS, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``(sid, size, doc_id, tie, row, ...)`` -> one row per piece: plus ``block, first_word, n_words``."""
    buckets = max(1, -(-sized.count() // bucket_docs))
    sized = sized.filter("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    sums = sized.groupBy("sid", "bucket").agg(F.sum("size").alias("in_bucket"))
    sums = running_before(sums, ["sid"], "bucket", "in_bucket", "base").drop("in_bucket")
    order = Window.partitionBy("sid", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "tie", "row")
    within = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sized.withColumn("within", within).join(sums, ["sid", "bucket"]).withColumn("start", F.col("base") + F.col("within"))
    placed = placed.withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    first = F.greatest(F.col("start"), F.col("block") * block_words) - F.col("start")
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("start")
    return placed.withColumns({"first_word": first, "n_words": end - first}).drop("bucket", "within", "base", "start")


def measured(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: Sequence[Column] = (), **options
) -> DataFrame:
    """One row per document: ``row`` (a number given here), ``doc_id, tie`` (text hash), ``source, size``,
    the columns ``carry`` and its source's columns of ``mix_targets``."""
    text = text_or_empty(text_col)
    sized = checkpointed(docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), *carry,
    ))
    targets = mix_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), **options)
    return checkpointed(sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"]))


def mix(sized: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """The mix of documents measured by ``measured`` (with the same ``block_words``): one row per piece
    ``shard, slot, source, epoch, block, row, doc_id, first_word, n_words``. Ordered by
    (shard, slot), the pieces are the words of the mix; ``pieces_text`` cuts their text.

    Edge cases: documents without words (null or empty text) have no pieces. A null source is a
    source of its own. Repeated rows are separate documents. A very long text is many blocks. Columns of the
    documents other than id, text and source are ignored, whatever their names. An empty table gives an
    empty mix.
    """
    targets = sized.groupBy("sid").agg(F.first("blocks").alias("blocks"), F.first("slots").alias("slots"))
    slots = draw_slots(targets, shard_slots, seed)
    pieces = pack_blocks(sized.select("row", "doc_id", "tie", "source", "sid", "size"), block_words)
    return slots.join(pieces, ["sid", "block"]).select("shard", "slot", "source", "epoch", "block", "row", "doc_id", "first_word", "n_words")


def pieces_text(text: Column, pieces: Column) -> Column:
    """The text of pieces (array of structs ``first_word, n_words``, in order): their words with the white
    space behind each; a text's leading white space belongs to its first word. All the pieces of a
    document together are its text."""
    tokens = F.regexp_extract_all(text_or_empty(text), F.lit(rf"^[{WS_CLASS}]*{WORD}[{WS_CLASS}]*|{WORD}[{WS_CLASS}]*"), F.lit(0))
    cut = lambda t: F.transform(pieces, lambda p: F.array_join(F.slice(t, p["first_word"].cast("int") + 1, p["n_words"].cast("int")), ""))
    return F.array_join(let(tokens, cut), "")
