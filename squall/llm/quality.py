"""Quality rules under weak supervision, in DataFrame expressions only.

Rules vote good (1), bad (-1) or abstain (0). Expectation-maximisation over the table of vote
patterns estimates how often each rule is right for good and for bad documents; a document's
posterior probability of being good replaces "all rules must pass".
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.common import words
from squall.storage import materialise

HAS_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """`bad` and `good` are conditions over the statistics; when neither holds the rule abstains."""

    name: str
    bad: str
    good: str = "false"


RULES = (
    Rule("length", "n_words < 20", "n_words >= 80"),
    Rule("symbols", "n_symbols > 0.2 * n_words"),
    Rule("dense_symbols", "n_symbols > 0.03 * word_chars"),
    Rule("shouting", "n_upper > 0.4 * n_letters"),
    Rule("marks", "n_marks > 0.3 * n_words"),
    Rule("same_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("repeated_words", "n_repeat_words > 0.3 * n_words"),
    Rule("word_length", "word_chars > 15 * n_words or word_chars < 2 * n_words"),
    Rule("sentences", "n_words > 100 and n_stops < 0.005 * n_words", "n_stops >= 0.02 * n_words"),
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """`(doc_id, n_words, …)`: counts over the whole text of each row; null text counts as empty.

    Three-word windows are compared by their 64-bit hash within one text. Only a text that has a
    repeated window is sorted to find the words it covers.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD))
    hashes = F.when(
        F.size("words") >= 3,
        F.expr("transform(sequence(0, size(words) - 3), "
               "i -> xxhash64(words[i], words[i + 1], words[i + 2]))"),
    ).otherwise(F.expr("array()").cast("array<bigint>"))
    first = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), r"[#*$%&|<>]").alias("n_symbols"),
        _count(F.col("text"), r"\p{Lu}").alias("n_upper"),
        _count(F.col("text"), r"\p{L}").alias("n_letters"),
        _count(F.col("text"), r"[!?|]").alias("n_marks"),
        _count(F.col("text"), r"[.;:](?=[\x20\x09-\x0D]|$)").alias("n_stops"),
        lines.alias("lines"),
        hashes.alias("hashes"),
    )
    second = first.withColumn("n_lines", F.size("lines").cast("long")).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    )
    placed = F.expr(
        "if(size(array_distinct(hashes)) = size(hashes), "
        "   cast(array() as array<struct<h: bigint, i: int>>), "
        "   sort_array(transform(hashes, (h, i) -> struct(h, i))))"
    )
    third = second.withColumn("placed", placed).drop("hashes", "lines")
    starts = F.expr(
        "sort_array(transform(filter(placed, (e, k) -> "
        "  (k > 0 and placed[k - 1].h = e.h) or "
        "  (k < size(placed) - 1 and placed[k + 1].h = e.h)), e -> e.i))"
    )
    covered = F.expr(
        "aggregate(transform(starts, (s, k) -> "
        "  if(k = size(starts) - 1, 3, least(3, starts[k + 1] - s))), 0L, (a, x) -> a + x)"
    )
    fourth = third.withColumn("starts", starts).drop("placed")
    return fourth.withColumn("n_repeat_words", covered).drop("starts")


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes of all rules as one string: `+`, `-` or `0` for each rule."""
    return F.concat(
        *[F.expr(f"case when {r.bad} then '-' when {r.good} then '+' else '0' end") for r in rules]
    )


MAX_WRONG = 0.01  # a rule is taken to reject at most this share of the good documents


@dataclass(frozen=True)
class Accuracies:
    """Prior of good, and for each rule how often it votes `+` and `-` on good and on bad documents."""

    prior: float
    on_good: tuple[tuple[float, float], ...]
    on_bad: tuple[tuple[float, float], ...]

    def log_odds(self, pattern: Column) -> Column:
        """Log odds of good, given the votes. Abstentions count as well: bad documents make fewer.

        The weights come as one array, so that every iteration has the same code to compile.
        """
        weights = [math.log(self.prior / (1 - self.prior))]
        for good, bad in zip(self.on_good, self.on_bad):
            weights += [math.log(g / b) for g, b in zip((*good, 1 - sum(good)), (*bad, 1 - sum(bad)))]
        array = F.lit(weights)
        total = F.get(array, F.lit(0))
        for k in range(len(self.on_good)):
            vote = F.substring(pattern, k + 1, 1)
            at = 3 * k + F.when(vote == "+", 1).when(vote == "-", 2).otherwise(3)
            total = total + F.get(array, at)
        return total

    def posterior(self, pattern: Column) -> Column:
        return 1 / (1 + F.exp(-self.log_odds(pattern)))


def estimate(patterns: DataFrame, n_rules: int, iterations: int = 12) -> Accuracies:
    """Expectation-maximisation over `(votes, n)`, at most 3 ** rules rows however many documents.

    An iteration is one aggregate that returns one row. Pseudo-counts of a tenth of the documents hold
    the start: good documents rarely get a bad vote, bad ones often do; the bound on wrong votes tells
    which of the two classes is the good one. Without documents the start stays.
    """
    start_good, start_bad = (0.6, MAX_WRONG), (0.4, 0.3)
    state = Accuracies(0.85, (start_good,) * n_rules, (start_bad,) * n_rules)
    for _ in range(iterations):
        p = patterns.withColumn("p", state.posterior(F.col("votes")))
        sums = [F.sum(F.col("n") * F.col("p")), F.sum("n")]
        for k in range(1, n_rules + 1):
            vote = F.substring("votes", k, 1)
            for sign in "+-":
                voted = F.when(vote == sign, F.col("n")).otherwise(0)
                sums += [F.sum(voted * F.col("p")), F.sum(voted * (1 - F.col("p")))]
        row = p.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        if not row[1]:
            return state
        n_good, n_bad, extra = row[0], row[1] - row[0], 0.1 * row[1]

        def rate(votes: float, of: float, start: float) -> float:
            return (votes + extra * start) / (of + extra)

        good, bad = [], []
        for k in range(n_rules):
            plus_good, plus_bad, minus_good, minus_bad = row[2 + 4 * k : 6 + 4 * k]
            wrong = min(MAX_WRONG, rate(minus_good, n_good, start_good[1]))
            good.append((rate(plus_good, n_good, start_good[0]), wrong))
            bad.append((rate(plus_bad, n_bad, start_bad[0]), rate(minus_bad, n_bad, start_bad[1])))
        state = Accuracies(min(max(row[0] / row[1], 0.05), 0.95), tuple(good), tuple(bad))
    return state


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Statistics, votes, posterior and verdict of each row of `docs (doc_id, text, …)`.

    `kept` is false if the base rules fail (under 50 words, or over half of the words in repeated
    three-word windows) and else posterior >= 0.5. Rows with equal ids are judged each for itself; an
    empty table gives no rows; other columns are ignored.
    """
    measured = materialise(statistics(docs).withColumn("votes", votes(rules)), "quality")
    patterns = materialise(
        measured.groupBy("votes").agg(F.count("*").alias("n")).coalesce(1), "votes"
    )
    found = estimate(patterns, len(rules))
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("posterior", found.posterior(F.col("votes")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    )
