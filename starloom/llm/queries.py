"""Registered queries of the operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, conversations, decontamination, exact_dedup, language_id, line_dedup, mixing, ppm, quality_model, quality_rules, runs, simhash, warc
from starloom.llm.common import let, text_or_empty, words


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(modulus: int, remainder: int) -> Column:
    """crc32 of the id as text leaves this remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.measured(_table(spark, sf_dir, "documents"))
    taken = mixing.mix(sized).groupBy("row").agg(F.sum("n_words").alias("taken"))
    return sized.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source"
    )


def op2_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ppm.train(docs.filter(~_held_out(7, 2)))
    scored = ppm.score(docs, model, held_out=_held_out(7, 2))
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    languages, params = language_id.train(docs.filter(~_held_out(4, 2)))
    found = language_id.identify(docs, languages, params, held_out=_held_out(4, 2))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = warc.archive_root(spark)
    manifest = warc.write_warcs(_table(spark, sf_dir, "pages"), root)
    records = warc.read_warcs(manifest, root, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality_model.measured(_table(spark, sf_dir, "documents"))
    forest = quality_model.train(x.filter(~_held_out(3, 1)), _table(spark, sf_dir, "labels"))
    return quality_model.score(x, forest, held_out=_held_out(3, 1)).select("doc_id", "held_out", "score", "predicted")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def _periodic_ending(text: Column, doc_id: Column) -> Column:
    """The stand-in input of op11: one text in ten (by the hash of its id) repeats a stretch of its words up
    to its end. A null id leaves its text as it is."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rewritten(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))) + 1).cast("int")
        word = lambda i: F.get(w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)))
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise("")

    return F.when(F.coalesce(F.pmod(h, F.lit(10)) == 0, F.lit(False)), let(words(text_or_empty(text)), rewritten)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", _periodic_ending(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.detect_runs(docs)
    # the greatest length, then the smallest start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """The stand-in input of op13: rows dropped, emptied, cut, repeated or given another role by a hash."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(h == 4, "user").otherwise(space("role"))
    times = F.explode(F.when(h == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.filter(h != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times).drop("col")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    repaired = conversations.repair(_damaged(rows))
    key = F.struct("conv_id").alias("c")
    ordered = lambda value, *by: F.array_sort(F.collect_list(F.struct(*by, value.alias("value"))))["value"]
    audits = repaired.pieces.groupBy(key).agg(F.array_join(ordered(F.col("audit"), "block"), "").alias("audit"))
    lines = repaired.edits.filter("edit <> 'D'").groupBy(key).agg(
        F.array_join(ordered(F.concat("role", F.lit(":"), "text"), "block", "step"), "\n").alias("lines")
    )
    found = rows.select(key).distinct().join(repaired.conversations.withColumn("c", key).drop("conv_id"), "c", "left").join(audits, "c", "left").join(lines, "c", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "c.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce("lines", F.lit("")).cast("binary"), 256).alias("repaired_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_ppm_scoring, op3_exact_dedup, op4_language_id, op5_warc, op6_line_dedup, op7_quality_classifier,
        op8_byte_bpe, op9_quality_rules, op10_simhash_near_dedup, op11_periodic_runs,
        op12_decontamination, op13_conversation_repair,
    )
}

def _repair_sql() -> str:
    """Conversation repair as a recursion over the rows from the last to the first: for each state the least
    (cost, audit) of what is left, as a struct."""
    edit = lambda letter, cost, to: f"{{'c': d.s{to}.c + {cost}, 'a': '{letter}' || d.s{to}.a}}"
    after = (2, 2, 3, 2)  # the state behind an inserted or reroled row
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    best = []
    for state in range(4):
        options = [edit("D", 2, state), f"CASE WHEN r.free THEN {edit('R', '1 + r.extra', after[state])} END"]
        options += [f"CASE WHEN r.free AND r.initial = '{c}' THEN {edit('K', 'r.extra', to)} END" for c, to in kept[state].items()]
        best.append(f"list_min([{', '.join(options)}]) AS b{state}")
    insert = lambda state, n: f"{{'c': b{state}.c + {5 * n}, 'a': '{'I' * n}' || b{state}.a}}"
    closed = [f"list_min([b{s}, {insert(after[s], 1)}, {insert(after[after[s]], 2)}]) AS s{s}" for s in range(4)]
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
        WITH RECURSIVE source AS (
            SELECT dense_rank() OVER (ORDER BY conv_id) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ), hashed AS (  -- CRC-32, bit by bit: each byte comes in, then eight shifts
            SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(key, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda x, e: CASE WHEN e >= 0 THEN xor(CAST(x AS BIGINT), CAST(e AS BIGINT))
                                     ELSE xor(CAST(x AS BIGINT) >> 1, 3988292384 * (CAST(x AS BIGINT) & 1)) END), 4294967295) % 20 AS h
            FROM source
        ), damaged AS (
            SELECT g, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM hashed WHERE h <> 0
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, copy) - 1 AS i, rtrim(text, {white}) AS bare, substr(role, 1, 1) AS initial
            FROM damaged
        ), marked AS (
            SELECT *, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS duplicate,
                   lag(initial) OVER (PARTITION BY g ORDER BY i) || initial AS pair
            FROM numbered
        ), rows AS (
            SELECT *, NOT blank AND NOT duplicate AS free, NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
                   CASE WHEN NOT blank AND NOT duplicate AND right(bare, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra
            FROM marked
        ), plan AS (
            SELECT g, count(*) AS i, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s0, {{'c': CAST(10 AS BIGINT), 'a': 'II'}} AS s1,
                   {{'c': CAST(5 AS BIGINT), 'a': 'I'}} AS s2, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s3
            FROM rows GROUP BY g
            UNION ALL
            SELECT g, i, {', '.join(closed)}
            FROM (SELECT d.g, r.i AS i, {', '.join(best)} FROM plan d JOIN rows r ON r.g = d.g AND r.i = d.i - 1)
        ), chosen AS (
            SELECT g, s0.c AS cost, s0.a AS audit FROM plan WHERE i = 0
        ), letters AS (
            SELECT g, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS pos FROM chosen
        ), placed AS (
            SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY g ORDER BY pos) - 1 AS i,
                   count(*) FILTER (letter <> 'D') OVER (PARTITION BY g ORDER BY pos) - 1 AS place
            FROM letters
        ), made AS (
            SELECT p.*, r.role, r.text, max(CASE WHEN place = 0 AND letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.g) AS system
            FROM placed p LEFT JOIN rows r ON r.g = p.g AND r.i = p.i AND letter <> 'I'
        ), texts AS (
            SELECT g, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                        || ':' || coalesce(text, ''), chr(10) ORDER BY pos)) AS digest
            FROM made WHERE letter <> 'D' GROUP BY g
        ), counts AS (
            SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                   count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY g
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT g, conv_id FROM source) LEFT JOIN counts USING (g) LEFT JOIN chosen USING (g) LEFT JOIN texts USING (g)
    """


ORACLE_SQL = {
    "op13_conversation_repair": _repair_sql(),
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    # base 32 takes 5 bits a character, so 5 hexadecimal digits give 4 characters
    "op5_warc": """
        WITH digests AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
        ), grouped AS (
            SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first,
                   list_transform(range(8), lambda i: ('0x' || substr(hex, CAST(5 * i + 1 AS INTEGER), 5))::INTEGER) AS bits
            FROM digests
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(1 + ((bits[CAST(1 + i // 4 AS INTEGER)] >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM grouped
    """,
    "op6_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), marked AS (
            SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS dropped FROM keyed
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    # an occurrence is a stretch of as many document words as a window of any item has, equal to one
    "op12_decontamination": r"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS row,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), places AS (
            SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, w[i + 1 : i + 10] AS words FROM places
        ), sizes AS (
            SELECT DISTINCT len(words) AS n FROM windows
        ), starts AS (
            SELECT row, w, n, unnest(range(len(w) - n + 1)) AS i FROM split, sizes WHERE len(w) >= n
        ), found AS (
            SELECT row, i, n, item_id FROM (SELECT row, i, n, w[i + 1 : i + n] AS words FROM starts) JOIN windows USING (words)
        ), hit AS (
            SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS place FROM found) GROUP BY row
        ), listed AS (
            SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM found GROUP BY row
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM split LEFT JOIN hit USING (row) LEFT JOIN listed USING (row)
    """,
}
