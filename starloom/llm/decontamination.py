"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A *window* is ``window_words`` consecutive words of an item (an item with fewer words is one window). A
document contains it if the same words follow each other in the document. Words are lower-cased (A-Z).

1. *Shingles.* A window is the ordered set of its shingles of ``shingle_words`` words (a shorter window is
   one shingle). The document words that start a shingle of any item are found by an equality join, on a
   64-bit hash and on the words themselves. A document's matches are a few narrow rows; its text is read once.
2. *Rarity.* The matches of each shingle are counted over all documents. The order of a window's shingles
   is from rare to frequent.
3. *Prefix.* All of a window's m shingles must be there, so any set of m - m + 1 = 1 of them has to meet the
   document: the prefix is the rarest one. A window whose rarest shingle has no match is out.
4. *Bounds.* A prefix match at word w, with the shingle at place k of the window, can only be an occurrence
   from word w - k on: that word and the window's last must lie in the document.
5. *Verification.* The m matches from there on, in consecutive places, must be the window's own shingles.
   Matches are held by document and segment of ``SEGMENT`` words (with a margin), so no array grows with
   the text.

Everything is DataFrame functions. The shingles and the windows of the items are joined in blocks of at most
``block_rows`` rows, each a broadcast of bounded size; a larger benchmark takes more blocks. Words of documents
are never shuffled: what is shuffled are matches and occurrences, by document and segment, and counts. The
matches are written once, as later steps read them several times.

Edge cases: a null or empty text has no words; such a document has no hit and such an item no window. Items that
share a window are all counted. Rows that repeat an item id are one item with the windows of all its rows; a null
id is an item of its own, named by the empty string. Documents that are equal in id and text share their result,
once per row. Very long texts are rows like any other, as matches are rows. An empty table gives an empty
result, an empty benchmark no hits. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import text_or_empty, written

#: What separates words, once A-Z are lower-cased: ASCII but for letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Rows of a broadcast block: a shingle holds three words, a window at most ``WINDOW_WORDS`` numbers.
BLOCK_ROWS = 1 << 17
SEGMENT = 1024

_KEY = ["k1", "k2"]
_SPANS = "array<struct<start:int,length:int>>"


def split_words(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """``columns`` and ``w``, the words of each text in a form that is equal if and only if the words are,
    but for the case of A-Z.

    The UTF-8 bytes are read as Latin-1 characters and lower-cased. Besides A-Z that changes lead bytes of
    two-byte characters only (by 32), and how many bytes follow one still tells it from those of longer
    characters. Lower-casing the text itself would also change other letters, and mapping 26 letters
    character by character takes several times as long.
    """
    plain = F.lower(F.decode(F.encode(text_or_empty(text_col), "UTF-8"), "ISO-8859-1"))
    pieces = docs.select(*columns, F.split(plain, SEPARATORS).alias("x"))
    first = (F.get("x", F.lit(0)) == "").cast("int")  # only the first and the last piece can be empty
    last = F.when(F.size("x") > first, (F.get("x", F.size("x") - 1) == "").cast("int")).otherwise(0)
    kept = [c for c in pieces.columns if c != "x"]
    return pieces.select(*kept, F.slice("x", first + 1, F.size("x") - first - last).alias("w"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window_words: int = WINDOW_WORDS) -> DataFrame:
    """``item_id, words``: the distinct windows of each item."""
    split = split_words(items, text_col, F.col(id_col).alias("item_id")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window_words + 1, F.lit(1))))
    return split.select("item_id", "w", at.alias("at")).select("item_id", F.slice("w", F.col("at"), window_words).alias("words")).distinct()


def _blocks(rows: DataFrame, by: str, block_rows: int) -> list[DataFrame]:
    """``rows`` (a written table) in blocks by a hash, each filled to half of ``block_rows`` on average."""
    n = rows.count()
    blocks = 1 if n <= block_rows else -(-2 * n // block_rows)
    return [rows] if blocks == 1 else [rows.filter(F.pmod(F.xxhash64(by), F.lit(blocks)) == b) for b in range(blocks)]


def shingle_matches(
    docs: DataFrame, shingles: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text", with_base: bool = True
) -> DataFrame:
    """Scan ``docs`` for the shingles ``sid, shingle`` (words, of the given ``lengths``): one row per match
    ``k1, k2`` (128 bits of id and text), ``doc_id, n_words, at, length, sid, base``. With ``with_base`` each
    document also has one row with ``base`` set, which is a match only if it has a ``sid``."""
    text = text_or_empty(text_col)
    key = [F.xxhash64(F.col(id_col), text).alias("k1"), F.xxhash64(F.lit(1), F.col(id_col), text).alias("k2")]

    split = split_words(docs, text_col, *key, F.col(id_col).alias("doc_id"))
    following = F.arrays_zip(*[(F.col("w") if i == 0 else F.slice("w", i + 1, F.size("w"))).alias(f"w{i}") for i in range(max(lengths))])
    # the words' array is used up before the words become rows, which would each carry it
    split = split.select(*_KEY, "doc_id", F.size("w").alias("n_words"), following.alias("following"))
    placed = split.select(*_KEY, "doc_id", "n_words", F.posexplode_outer("following").alias("at", "e"))
    placed = placed.withColumn("length", F.lit(lengths[0]) if len(lengths) == 1 else F.explode(F.array(*map(F.lit, lengths))))
    here = [F.col("e.w0"), *[F.when(F.col("length") > i, F.col(f"e.w{i}")) for i in range(1, max(lengths))]]
    placed = placed.withColumn("h", F.xxhash64("length", *here))
    theirs = [F.get("shingle", F.lit(i)) for i in range(max(lengths))]
    known = shingles.select(F.xxhash64(F.size("shingle"), *theirs).alias("kh"), F.struct("sid", *[w.alias(f"w{i}") for i, w in enumerate(theirs)]).alias("k"))
    known = known.groupBy("kh").agg(F.collect_list("k").alias("known"))
    joined = placed.join(F.broadcast(known), F.col("h") == F.col("kh"), "left")
    # equal hashes only point at the shingles; the words decide
    same = F.filter("known", lambda k: reduce(lambda a, b: a & b, [k[f"w{i}"].eqNullSafe(w) for i, w in enumerate(here)]))
    base = (F.coalesce(F.col("at"), F.lit(0)) == 0) & (F.col("length") == lengths[0]) if with_base else F.lit(False)
    joined = joined.withColumns({"sid": F.when(F.col("known").isNotNull(), F.get(same, F.lit(0))["sid"]), "base": base})
    return joined.filter(F.col("base") | F.col("sid").isNotNull()).select(*_KEY, "doc_id", "n_words", "at", "length", "sid", "base")


def prefixes(windows: DataFrame, shingles: DataFrame, frequency: DataFrame) -> DataFrame:
    """``wid, words, size, prefix, place, sids`` of the distinct windows: the numbers of their shingles in
    order, and the rarest of these (then the one with the least number) with its place. Windows with a
    shingle that no document has are left out."""
    listed = windows.select("words", F.posexplode("cut").alias("place", "shingle")).distinct()
    listed = listed.join(shingles, "shingle").join(frequency, "sid", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "sid", "place"))
    ordered = listed.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("place", "sid"))).alias("all"), rarest.alias("rarest"))
    return ordered.filter("rarest.n > 0").select(
        F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("size"), F.col("rarest.sid").alias("prefix"),
        F.col("rarest.place").alias("place"), F.col("all.sid").alias("sids"),
    )


def _by_segment(rows: DataFrame, first: str, last: str) -> DataFrame:
    """``rows`` with ``segment``: those from ``first`` to ``last``."""
    return rows.withColumn("segment", F.explode(F.expr(f"sequence(cast(({first}) div {SEGMENT} as int), cast(({last}) div {SEGMENT} as int))")))


def occurrences(matches: DataFrame, windows: DataFrame, window_words: int = WINDOW_WORDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The occurrences ``k1, k2, wid, start, size`` of ``windows`` (as made by ``prefixes``)."""
    # a segment also has the matches of a window's length behind it, for the windows that start in it
    held = _by_segment(matches, f"greatest(at - {window_words}, 0)", "at")
    held = held.groupBy(*_KEY, "segment", "n_words").agg(F.array_sort(F.collect_set(F.struct("length", "at", "sid"))).alias("m"))
    held = written(held, "segment-matches")
    probe = held.select("*", F.posexplode("m").alias("i", "e")).select(*_KEY, "segment", "n_words", "m", "i", "e.length", "e.at", "e.sid")
    start, first, count = F.col("at") - F.col("place"), F.col("i") - F.col("place"), F.size("sids")
    last = first + count - 1
    bounds = (start >= 0) & (start + F.col("size") <= F.col("n_words")) & (F.expr(f"(at - place) div {SEGMENT}") == F.col("segment")) & (first >= 0) & (last < F.size("m"))
    held_at = lambda i, at: (F.get("m", i)["length"] == F.col("length")) & (F.get("m", i)["at"] == at)
    exact = held_at(first, start) & held_at(last, start + count - 1) & (F.slice("m", first + 1, count)["sid"] == F.col("sids"))
    found = []
    for block in _blocks(windows, "wid", block_rows):
        block = F.broadcast(block.select("wid", "size", "prefix", "place", "sids"))
        candidates = probe.join(block, F.col("sid") == F.col("prefix")).filter(bounds)
        found.append(candidates.filter(exact).select(*_KEY, "wid", start.alias("start"), "size"))
    return reduce(DataFrame.unionByName, found)


def _merged(intervals: Column) -> Column:
    """Sorted intervals ``low, high`` (an array with at least one) -> disjoint spans ``start, length``."""
    span = lambda s: F.array(F.struct(s["low"].alias("start"), (s["high"] - s["low"]).alias("length")))
    state = lambda done, low, high: F.struct(done.alias("done"), low.alias("low"), high.alias("high"))
    step = lambda s, x: F.when(
        x["low"] <= s["high"], state(s["done"], s["low"], F.greatest(s["high"], x["high"]))
    ).otherwise(state(F.concat(s["done"], span(s)), x["low"], x["high"]))
    head = F.get(intervals, F.lit(0))
    return F.aggregate(intervals, state(F.array().cast(_SPANS), head["low"], head["high"]), step, lambda s: F.concat(s["done"], span(s)))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, spans`` (array of ``start, length``: the stretches of
    words inside occurrences of windows, in order, apart, and cut at multiples of ``SEGMENT`` words), ``n_hit``
    (their words) and ``items`` (the ids of the items with an occurring window, as strings, sorted)."""
    windows = item_windows(items, item_id_col, item_text_col, window_words)
    length = F.least(F.size("words"), F.lit(shingle_words))
    cut = F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))
    windows = written(windows.select("item_id", "words", cut.alias("cut")), "windows")
    shingles = windows.select(F.explode("cut").alias("shingle")).distinct().withColumn("sid", F.monotonically_increasing_id())
    shingles = written(shingles, "shingles")
    lengths = sorted(r[0] for r in shingles.select(F.size("shingle")).distinct().collect()) or [shingle_words]  # at most shingle_words numbers

    scans = [shingle_matches(docs, block, lengths, id_col, text_col, with_base=i == 0) for i, block in enumerate(_blocks(shingles, "sid", block_rows))]
    found = written(reduce(DataFrame.unionByName, scans), "shingle-matches")
    matches = found.filter("sid IS NOT NULL").select(*_KEY, "n_words", "at", "length", "sid")
    named = written(prefixes(windows, shingles, matches.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))), "prefixes")
    occurring = written(occurrences(matches, named, window_words, block_rows), "occurrences")

    low, high = F.greatest("start", F.col("segment") * SEGMENT), F.least(F.col("start") + F.col("size"), (F.col("segment") + 1) * SEGMENT)
    spans = _by_segment(occurring.select(*_KEY, "start", "size").distinct(), "start", "start + size - 1")
    spans = spans.groupBy(*_KEY, "segment").agg(_merged(F.array_sort(F.collect_set(F.struct(low.alias("low"), high.alias("high"))))).alias("spans"))
    spans = spans.groupBy(*_KEY).agg(F.flatten(F.array_sort(F.collect_list(F.struct("segment", "spans")))["spans"]).alias("spans"))

    owners = written(windows.join(named.select("wid", "words"), "words").select("wid", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")), "window-items")
    seen = occurring.select(*_KEY, "wid").distinct()
    hit = reduce(DataFrame.unionByName, [seen.join(F.broadcast(b), "wid").select(*_KEY, "item") for b in _blocks(owners, "wid", block_rows)])
    hit = hit.groupBy(*_KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))

    result = found.filter("base").select(*_KEY, "doc_id", "n_words").join(spans.join(hit, _KEY), _KEY, "left")
    result = result.withColumns({"spans": F.coalesce("spans", F.array().cast(_SPANS)), "items": F.coalesce("items", F.array().cast("array<string>"))})
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return result.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "spans", n_hit.alias("n_hit"), "items")
