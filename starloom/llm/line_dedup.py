"""Line deduplication: range-partitioned line hashes, streamed in (document, position) order.

1. Each line becomes a narrow row: document, text hash, position and a 128-bit hash of its key.
2. The rows are range-partitioned by (hash, document, position) and sorted, so a line that many documents
   share spans several tasks. Streaming through a run of equal hashes, the first row's document holds the
   line; rows of any other document are marked as dropped. Only the first hash of a partition can go on from
   the one before: its holder is carried over, one row per partition (``functions.scan``). Spark's window
   holds the rows of one hash in one partition while it streams them, and spills beyond its buffer.
3. Dropped positions return to their documents as sparse bitmaps: one (word, mask) entry per 32 lines
   that lose any. Absent words keep all their lines. Texts are not part of this shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.scan import FIRST, Running, running
from starloom.llm.common import WS_CHARS, ascii_lower, let, text_or_empty, written

MIN_KEY_CHARS = 10

_WORD_BITS = 32


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WS_CHARS)))


def keep_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_key_chars: int = MIN_KEY_CHARS,
    tasks: int | None = None,
) -> DataFrame:
    """One row per distinct (id, text): ``doc_id, text_hash, n_lines, n_dropped, dropped_words``.

    Keys of at least ``min_key_chars`` code points found in two or more documents lose all their
    lines except in the smallest id holding them. ``dropped_words`` is an array of
    ``(word int, mask bigint)``: bit *b* of word *w* set means line ``32 w + b`` is dropped. The lines are
    streamed in ``tasks`` range partitions, by default as many as shuffles have.

    Edge cases: a null or empty text is one empty line. Rows with the same id count as one document
    (a line they share is not found in two documents). A null id is the largest. Very long texts are
    split whole, a line is a row of its own. An empty table gives an empty result. Other columns are
    ignored.
    """
    text = text_or_empty(text_col)
    lines = (
        docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("th"), F.posexplode(split_lines(text)).alias("pos", "line"))
        .select("d", "th", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_key_chars)
        .select("d", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    lines = written(lines, "lines")
    holder = F.struct(F.col("d").isNull().alias("last"), F.col("d").alias("id"))
    held = running(lines, ["h1", "h2"], [F.col("d").asc_nulls_last(), "th", "pos"], {"first": Running(FIRST, holder)}, tasks)
    dropped = held.filter(~F.col("first.id").eqNullSafe(F.col("d")))
    words = (
        dropped.groupBy("d", "th", F.expr(f"cast(pos div {_WORD_BITS} as int)").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {_WORD_BITS})")).alias("mask"))
        .groupBy("d", "th")
        .agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("dropped_words"))
    )
    base = (
        docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("th"), (F.regexp_count(text, F.lit("\n")) + 1).cast("long").alias("n"))
        .groupBy("d", "th").agg(F.max("n").alias("n_lines"))
    )
    joined = base.join(words, base["d"].eqNullSafe(words["d"]) & (base["th"] == words["th"]), "left")
    none = F.array().cast("array<struct<word:int,mask:bigint>>")
    return joined.select(
        base["d"].alias("doc_id"), base["th"].alias("text_hash"), "n_lines",
        F.coalesce(F.aggregate("dropped_words", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["mask"])), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped_words", none).alias("dropped_words"),
    )


def dropped_positions(dropped_words: Column) -> Column:
    """The bitmap's dropped line numbers, ascending."""
    bits = F.sequence(F.lit(0), F.lit(_WORD_BITS - 1))
    set_bits = lambda w: F.filter(bits, lambda b: w["mask"].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b)) != 0)
    return F.flatten(F.transform(dropped_words, lambda w: F.transform(set_bits(w), lambda b: w["word"] * _WORD_BITS + b)))


def kept_text(text: Column, dropped_words: Column) -> Column:
    """The lines that the bitmap keeps, joined by a line feed."""
    def pick(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped_positions(dropped_words))
        return F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")

    return F.when(F.size(dropped_words) == 0, text).otherwise(let(split_lines(text), pick))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """``docs`` with the columns ``__n_lines, __n_dropped, __dropped_words`` of each row's bitmap. The join
    is on (id, text hash), so every row, repeated ones too, meets its own."""
    marks = bitmaps.select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__th"), F.col("n_lines").alias("__n_lines"),
        F.col("n_dropped").alias("__n_dropped"), F.col("dropped_words").alias("__dropped_words"),
    )
    return docs.join(marks, doc_id.eqNullSafe(marks["__d"]) & (F.xxhash64(text_or_empty(text)) == marks["__th"])).drop("__d", "__th")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` reduced to its kept lines, plus ``n_lines`` and ``n_dropped``. Existing
    columns of those two names are replaced."""
    joined = with_bitmaps(docs, bitmaps, docs[id_col], docs[text_col])
    kept = kept_text(text_or_empty(text_col), F.col("__dropped_words"))
    return joined.withColumns({text_col: kept, "n_lines": F.col("__n_lines"), "n_dropped": F.col("__n_dropped")}).drop(
        "__n_lines", "__n_dropped", "__dropped_words"
    )
