"""The training-data pipeline: each stage applies one operator of ``starloom.llm`` to the documents that
its predecessor kept, and its decisions take effect.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents``, but for the last. Whatever other columns the input has, of any name, they are
carried inside one struct and come out unchanged. ``run`` writes each stage as Parquet and reads it again,
so a lost executor costs at most part of one stage.

* A null or empty text is rejected by the first stage. An empty table gives empty results.
* Repeated rows are documents of their own until the near-duplicate stage, which keeps one. Rows that are equal
  in id and text but not in other columns are told apart in every stage; where they tie, a hash of all columns
  decides which one the near-duplicate stage keeps.
* Very long texts are handled whole by every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, line_dedup, mixing, quality_rules, simhash
from starloom.llm.common import checkpointed, written

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
#: The mix of the pipeline cuts larger blocks than the query, so that fewer texts are cut.
MIX_BLOCK_WORDS = 128


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[docs[c] for c in docs.columns]).alias("doc")


def _with_text(frame: DataFrame, text: Column) -> DataFrame:
    """The documents in ``doc`` with another text and its length."""
    doc = F.col("doc").withField("text", text).withField("n_chars", F.char_length(text).cast("bigint"))
    return frame.select(doc.alias("doc")).select("doc.*")


def _row_key(docs: DataFrame) -> list[Column]:
    """128 bits of all columns of a row: rows share them exactly if they cannot be told apart. Decisions are
    made on narrow rows and return by this key, so that no stage keeps another copy of the texts."""
    kinds = dict(docs.dtypes)
    plain = [F.array_sort(F.map_entries(docs[c])) if kinds[c].startswith("map") else docs[c] for c in docs.columns]
    return [F.xxhash64(*plain).alias("__k1"), F.xxhash64(F.lit(1), *plain).alias("__k2")]


_KEY = ["__k1", "__k2"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    stats = docs.select(*_row_key(docs), quality_rules.text_stats(F.col("text")).alias("s")).select(*_KEY, "s.*")
    kept = quality_rules.judge(checkpointed(stats)).filter("kept").select(*_KEY)
    return docs.select(_whole(docs), *_row_key(docs)).join(kept, _KEY, "left_semi").select("doc.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that an earlier document holds go. A document may end up without any line; the
    empty texts are one group of the next stage."""
    text = F.col("doc.text")
    marked = line_dedup.with_bitmaps(docs.select(_whole(docs)), line_dedup.keep_bitmaps(docs), F.col("doc.doc_id"), text)
    return _with_text(marked, line_dedup.kept_text(F.coalesce(text, F.lit("")), F.col("__dropped_words")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group the row with the smallest doc_id stays (of several, that with the
    smallest hash of all columns)."""
    found = simhash.near_duplicates(docs.select("doc_id", "text", *_row_key(docs)), carry=_KEY)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *_KEY)
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.__k1", "first.__k2")
    # rows equal to the first in all columns are left to the last step
    return docs.select(_whole(docs), *_row_key(docs)).join(first, _KEY, "left_semi").dropDuplicates(_KEY).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a document appears once for each epoch of its source, with the words that the mix takes of
    it in that epoch (all of them in a full epoch). Copies of a row are mixed as documents of their own."""
    sized = mixing.measured(docs, carry=_row_key(docs), block_words=MIX_BLOCK_WORDS)
    pieces = mixing.mix(sized, block_words=MIX_BLOCK_WORDS)
    taken = pieces.groupBy("row", "epoch").agg(F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("__pieces"))
    taken = taken.join(sized.select("row", *_KEY), "row").select(*_KEY, "__pieces")
    texts = docs.select(_whole(docs), *_row_key(docs)).dropDuplicates(_KEY)
    return _with_text(texts.join(taken, _KEY), mixing.pieces_text(F.col("doc.text"), F.col("__pieces")))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the token ids of each text, and the text as decoded from them."""
    ranks = public_tokenizers.path(TOKENIZER)
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    return encoded.withColumn("text", F.decode(bpe.decode(F.col("ids"), ranks), "UTF-8"))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: SQL has no XXH64 and none of the fitted or drawn decisions; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
