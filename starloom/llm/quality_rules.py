"""Quality rules by weak supervision.

Each rule looks at document statistics and votes good (1), bad (-1) or abstains (0). The rules'
accuracies and the share of good documents are unknown; expectation-maximisation estimates them from
the agreement of the votes over all documents, and a document stays if its posterior probability of
being good is at least one half. No single rule decides.

Everything is built-in functions. The statistics are computed once and written; the EM sees only the
distinct vote patterns and their counts (at most 3 ** rules rows, whatever the input's size), folded
in one SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, WS_CLASS, checkpointed, let, text_or_empty, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
#: What remains when runs of letters, digits, white space and common punctuation are removed.
ODD_CHARS = r"""[\p{L}\p{M}\p{N}\s.,;:!?'"()-]+"""

EM_ROUNDS = 30
#: Where EM starts: the share of good documents, and how often a rule that votes is right on a good
#: and on a bad document. The latter two also count as pseudo votes, PRIOR_SHARE of all documents (a
#: share, so that they weigh the same at any size).
START_GOOD = 0.85
START_PASSES = 0.98
START_CATCHES = 0.4
PRIOR_SHARE = 0.002
PASSES_RANGE = (0.6, 0.999)
CATCHES_RANGE = (0.05, 0.95)

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines", "n_distinct_words", "n_capitals", "n_exclaimed", "n_odd_chars", "n_symbol_ends")


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows of WINDOW words that occur twice or more in the text."""
    def covered(windows: Column) -> Column:
        def positions(ordered: Column) -> Column:
            same = lambda i, j: F.get(ordered, i)["h"] == F.get(ordered, j)["h"]
            hit = lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))
            return F.sort_array(F.transform(F.filter(ordered, hit), lambda x: x["i"]))

        def total(starts: Column) -> Column:
            zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            step = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + (i + WINDOW) - F.greatest(a["end"], i)).alias("n"))
            return F.aggregate(starts, zero, step, lambda a: a["n"])

        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(let(ordered, positions), total))

    starts = F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, F.lit(WINDOW))))
    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(let(windows, covered))


def text_stats(text: Column) -> Column:
    """A struct of the counts in STATS (all bigint) for one whole text; null counts as empty."""
    text = text_or_empty(text)

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(_repeat_words(h).alias("repeated"), F.size(F.array_distinct(h)).alias("distinct"))).alias("h"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    both = F.struct(let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"))
    return let(both, lambda b: F.struct(
        b["w"]["n_words"].cast("long").alias("n_words"),
        b["w"]["word_chars"].cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (b["l"]["n"] - b["l"]["distinct"]).cast("long").alias("n_dup_lines"),
        b["w"]["h"]["repeated"].cast("long").alias("n_repeat_words"),
        b["l"]["n"].cast("long").alias("n_text_lines"),
        b["w"]["h"]["distinct"].cast("long").alias("n_distinct_words"),
        F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit(rf"[!?]{{2,}}(?=[{WS_CLASS}]|$)")).cast("long").alias("n_exclaimed"),
        F.char_length(F.regexp_replace(text, ODD_CHARS, "")).cast("long").alias("n_odd_chars"),
        F.regexp_count(text, F.lit(rf"{SYMBOLS}(?=[{WS_CLASS}]|$)")).cast("long").alias("n_symbol_ends"),
    ))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def votes() -> dict[str, Column]:
    """The rules, over the columns of STATS. A rule that cannot judge (no words) abstains."""
    n = F.col("n_words")
    per_word = lambda c: F.col(c) / F.greatest(n, F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_text_lines"), F.lit(1))
    capitals = F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))
    odd = F.col("n_odd_chars") / F.greatest(F.col("word_chars"), F.lit(1))
    variety = F.log(F.greatest(F.col("n_distinct_words"), F.lit(1)).cast("double")) / F.log(F.greatest(n, F.lit(2)).cast("double"))
    return {
        "length": _vote(n >= 50, n < MIN_WORDS),
        "word_length": _vote(per_word("word_chars").between(3, 12), (n > 0) & ~per_word("word_chars").between(2, 20)),
        "symbols": _vote(per_word("n_symbols") <= 0.02, per_word("n_symbols") > 0.1),
        "odd_chars": _vote(odd <= 0.005, odd > 0.03),
        "symbol_ends": _vote(per_word("n_symbol_ends") <= 0.01, per_word("n_symbol_ends") > 0.1),
        "line_copies": _vote(lines <= 0.05, lines > 0.3),
        "window_copies": _vote(per_word("n_repeat_words") <= 0.05, per_word("n_repeat_words") > 0.2),
        "variety": _vote((n > 0) & (variety >= 0.75), (n >= MIN_WORDS) & (variety < 0.5)),
        "capitals": _vote(capitals <= 0.15, capitals > 0.5),
        "exclaimed": _vote(per_word("n_exclaimed") <= 0.02, per_word("n_exclaimed") > 0.1),
    }


def posterior(vote: Column, good: Column, passes: Column, catches: Column) -> Column:
    """P(good | votes) for rules that are independent given the class; an abstention says nothing.

    ``passes[j]`` is P(rule j votes good | good document, it votes), ``catches[j]`` is P(rule j votes
    bad | bad document, it votes).
    """
    def move(j: Column) -> Column:
        a, c, v = F.get(passes, j), F.get(catches, j), F.get(vote, j)
        return F.when(v == 1, F.log(a / (1 - c))).when(v == -1, F.log((1 - a) / c)).otherwise(F.lit(0.0))

    moves = F.transform(F.sequence(F.lit(0), F.size(vote) - 1), move)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.aggregate(moves, F.log(good / (F.lit(1.0) - good)), lambda s, x: s + x)))


def estimate(patterns: DataFrame, n_rules: int, rounds: int = EM_ROUNDS) -> DataFrame:
    """EM over ``(vote array<int>, n bigint)``: one row ``good double, passes, catches array<double>``.

    Most rules vote good on most documents, bad ones too, so a good vote says little and a bad vote
    much: each rule has one accuracy for each class. The patterns are at most 3 ** n_rules rows,
    gathered into one ordered array, so the sums are the same on every run. Without any pattern the
    start values are returned.
    """
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("vote", F.col("n").cast("double").alias("n")))).alias("t"))
    start = F.struct(
        F.lit(START_GOOD).alias("good"),
        F.array_repeat(F.lit(START_PASSES), n_rules).alias("passes"), F.array_repeat(F.lit(START_CATCHES), n_rules).alias("catches"),
    )
    add = lambda items, value: F.aggregate(items, F.lit(0.0), lambda s, x: s + value(x))
    clip = lambda p, low, high: F.least(F.greatest(p, F.lit(low)), F.lit(high))

    def round_(model: Column, _: Column) -> Column:
        expected = F.transform(F.col("t"), lambda p: F.struct(
            p["vote"].alias("vote"), p["n"].alias("n"), posterior(p["vote"], model["good"], model["passes"], model["catches"]).alias("q"),
        ))

        def maximise(e: Column) -> Column:
            total = add(e, lambda x: x["n"])
            prior = F.lit(PRIOR_SHARE) * total

            def accuracy(right: int, weight, begin: float, limits: tuple[float, float]):
                def of(j: Column) -> Column:
                    v = lambda x: F.get(x["vote"], j)
                    hits = add(e, lambda x: F.when(v(x) == right, x["n"] * weight(x)).otherwise(0.0))
                    cast = add(e, lambda x: F.when(v(x) != 0, x["n"] * weight(x)).otherwise(0.0))
                    return clip((hits + prior * begin) / (cast + prior), *limits)

                return F.transform(F.sequence(F.lit(0), F.lit(n_rules - 1)), of)

            return F.struct(
                clip(add(e, lambda x: x["n"] * x["q"]) / total, 0.01, 0.99).alias("good"),
                accuracy(1, lambda x: x["q"], START_PASSES, PASSES_RANGE).alias("passes"),
                accuracy(-1, lambda x: 1 - x["q"], START_CATCHES, CATCHES_RANGE).alias("catches"),
            )

        return F.when(F.size("t") == 0, model).otherwise(let(expected, maximise))

    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, round_).alias("m")).select("m.*")


def judge(stats: DataFrame) -> DataFrame:
    """Add ``base_failed, p_good, kept`` to a table that holds the columns of STATS.

    ``stats`` is read twice (votes, verdicts), so pass a written or checkpointed table. The fitted
    model, two numbers per rule and one more, goes through the driver.
    """
    vote = F.array(*votes().values())
    patterns = stats.groupBy(vote.alias("vote")).agg(F.count(F.lit(1)).alias("n"))
    model = estimate(patterns, len(votes())).first()
    p = posterior(vote, F.lit(model["good"]), F.array(*map(F.lit, model["passes"])), F.array(*map(F.lit, model["catches"])))
    return stats.withColumns({"base_failed": base_failed(), "p_good": p}).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the columns of STATS, ``base_failed, p_good, kept``.

    Edge cases: a null or empty text has no words, so ``base_failed`` is true and ``kept`` false.
    Very long texts are counted whole. Repeated rows and null ids are judged like any other row. A tie, a
    posterior of exactly one half, is kept. An empty table gives an empty result. Other columns are ignored.
    """
    stats = docs.select(F.col(id_col).alias("doc_id"), text_stats(F.col(text_col)).alias("s")).select("doc_id", "s.*")
    return judge(checkpointed(stats))
