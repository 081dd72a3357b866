"""Operator 10: quality rules combined by weak supervision (built-in functions only).

Each rule reads one statistic of the whole text and votes *keep* (1), *reject*
(0) or abstains (2).  No vote is final: an expectation-maximisation over all
documents estimates how each rule votes on good and on bad texts (its class-wise
accuracies), and a document is kept when the posterior probability that it is
good reaches the threshold.

The expectation-maximisation needs only how often each pattern of votes occurs
(at most ``3 ** number of rules`` rows, whatever the size of the corpus), so it
runs as small aggregations over that pattern table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import materialise, table, text_or_empty, words_of

KEEP, REJECT, ABSTAIN = 1, 0, 2
SYMBOLS = "#*$%&|<>"  # as a regular character class
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes by the value of one statistic: reject at or beyond ``bad``, keep at
    or within ``good``, abstain between the two (``low``: small values are bad)."""

    name: str
    stat: str
    good: float
    bad: float
    low: bool = False

    def vote(self) -> Column:
        c = F.col(self.stat)
        bad, good = (c <= self.bad, c >= self.good) if self.low else (c >= self.bad, c <= self.good)
        return (F.when(F.col("n_words") == 0, F.lit(ABSTAIN)).when(bad, F.lit(REJECT))
                .when(good, F.lit(KEEP)).otherwise(F.lit(ABSTAIN)).cast("int"))


#: Thresholds in the manner of published web-corpus heuristics.  The model takes
#: rules as independent given the class, so each looks at another trait.
RULES = (
    Rule("symbols", "symbol_ratio", good=0.01, bad=0.05),
    Rule("capitals", "upper_ratio", good=0.20, bad=0.50),
    Rule("long_words", "mean_word", good=9.0, bad=14.0),
    Rule("short_words", "mean_word", good=3.0, bad=2.0, low=True),
    Rule("duplicate_lines", "dup_line_ratio", good=0.10, bad=0.30),
    Rule("repeated_windows", "repeat_ratio", good=0.10, bad=0.30),
)


def _count_of(text: Column, kind: str) -> Column:
    """Characters of the regular character class ``kind`` (whole other runs go at once)."""
    return F.char_length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of the whole text: ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_words`` and the
    ratios that the rules read.  All ratios of a text without words are 0."""
    keep = [c for c in docs.columns if not c.startswith("__q_")]
    t = docs.select(*keep, text_or_empty(text).alias("__q_t"))
    lines = F.filter(F.split("__q_t", "\n"), lambda s: s.rlike(r"[^ \t\x0B\f\r]"))
    t = t.withColumns({"__q_w": words_of(F.col("__q_t")), "__q_l": lines})
    t = t.withColumn("__q_n", F.size("__q_w"))
    # one 64-bit hash per window of three words
    t = t.withColumn("__q_h", F.when(F.col("__q_n") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("__q_n") - 3),
        lambda i: F.xxhash64(F.get("__q_w", i), F.get("__q_w", i + 1), F.get("__q_w", i + 2)))))
    # windows sorted by hash, so equal ones are neighbours; only where some repeat
    t = t.withColumn("__q_s", F.when(
        F.size(F.array_distinct("__q_h")) < F.size("__q_h"),
        F.sort_array(F.transform("__q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twin(x: Column, i: Column) -> Column:
        s = F.col("__q_s")
        return ((F.get(s, i - 1)["h"] == x["h"]) & (i > 0)) | F.coalesce(
            F.get(s, i + 1)["h"] == x["h"], F.lit(False))

    t = t.withColumn("__q_p", F.sort_array(F.transform(F.filter("__q_s", twin), lambda x: x["i"])))
    # words covered by the repeated windows: each adds what the one before left open
    covered = F.aggregate(
        "__q_p", F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("at"), (a["n"] + F.least(F.lit(3), i - a["at"])).alias("n")),
        lambda a: a["n"])
    text_c = F.col("__q_t")
    n = F.col("__q_n").cast("long")
    t = t.withColumns({
        "__q_cover": F.coalesce(covered, F.lit(0).cast("long")),
        "__q_dups": (F.size("__q_l") - F.size(F.array_distinct("__q_l"))).cast("long"),
        "__q_lines": F.size("__q_l"),
        "__q_chars": F.char_length(F.array_join("__q_w", "")).cast("long"),
        "__q_up": _count_of(text_c, r"\p{Lu}"),
        "__q_marks": F.regexp_replace(text_c, r"[\p{L}\p{N}\s]+", ""),
    })
    t = t.withColumns({
        "__q_sym": _count_of(F.col("__q_marks"), SYMBOLS),
        "__q_letters": F.col("__q_chars") - F.char_length("__q_marks"),  # and digits
    })

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    out = {"n_words": n, "word_chars": F.col("__q_chars"), "n_symbols": F.col("__q_sym"),
           "n_dup_lines": F.col("__q_dups"), "n_repeat_words": F.col("__q_cover"),
           "symbol_ratio": ratio("__q_sym", "__q_chars"),
           "upper_ratio": ratio("__q_up", "__q_letters"),
           "mean_word": ratio("__q_chars", "__q_n"),
           "dup_line_ratio": ratio("__q_dups", "__q_lines"),
           "repeat_ratio": ratio("__q_cover", "__q_n")}
    return t.select(*[c for c in keep if c not in out], *[v.alias(k) for k, v in out.items()])


def _pattern(rules: tuple[Rule, ...]) -> Column:
    return F.concat(*[F.col(f"vote_{r.name}").cast("string") for r in rules])


@dataclass
class VoteModel:
    """``prior`` of a good text and ``table[rule][vote] = (P(vote | bad, voted),
    P(vote | good, voted))`` for the votes reject and keep; abstaining says nothing."""

    rules: tuple[Rule, ...]
    prior: float
    table: list[list[tuple[float, float]]]

    def log_odds(self) -> Column:
        import math
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for r, probs in zip(self.rules, self.table):
            v = F.col(f"vote_{r.name}")
            w = [math.log(good / bad) for bad, good in probs]
            total = total + F.when(v == REJECT, F.lit(w[REJECT])).when(
                v == KEEP, F.lit(w[KEEP])).otherwise(F.lit(0.0))
        return total

    def posterior(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def fit_votes(voted: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 15,
              tolerance: float = 1e-4, max_false_reject: float = 0.005) -> VoteModel:
    """Expectation-maximisation over the counts of vote patterns.

    Starts from rules that reject one good text in 200 and one bad text in
    five (a bad text mostly shows one trait, so the other rules still vote
    keep), with four good texts in five; smoothing by one document keeps every
    probability inside (0, 1).  ``max_false_reject`` bounds the estimate of how
    often a rule rejects good texts: without it, a kind of bad text that only one
    rule sees is explained as that rule's error.  An empty table leaves the start."""
    start = [[(0.20, 0.005), (0.80, 0.995)] for _ in rules]
    model = VoteModel(rules, 0.8, start)
    names = [f"vote_{r.name}" for r in rules]
    # bounded: at most 3 ** len(rules) patterns
    patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n"))
    patterns = materialise(patterns.coalesce(1), "vote-patterns")
    for _ in range(rounds):
        p = patterns.select("*", model.posterior().alias("p"))
        sums = [F.sum("n").alias("all"), F.sum(F.col("n") * F.col("p")).alias("good")]
        for name in names:
            for v in (REJECT, KEEP):
                hit = F.when(F.col(name) == v, F.col("n")).otherwise(F.lit(0.0))
                sums += [F.sum(hit).alias(f"{name}_{v}"),
                         F.sum(hit * F.col("p")).alias(f"{name}_{v}_good")]
        got = p.agg(*sums).first()
        if not got["all"]:
            return model
        n, good = got["all"], got["good"]
        fitted = []
        for name in names:
            r, k = got[f"{name}_{REJECT}"], got[f"{name}_{KEEP}"]
            rg, kg = got[f"{name}_{REJECT}_good"], got[f"{name}_{KEEP}_good"]
            good_r = min((rg + 1.0) / (rg + kg + 2.0), max_false_reject)
            bad_r = (r - rg + 1.0) / (r - rg + k - kg + 2.0)
            fitted.append([(bad_r, good_r), (1.0 - bad_r, 1.0 - good_r)])
        prior = (good + 1.0) / (n + 2.0)
        moved = abs(prior - model.prior)
        model = VoteModel(rules, prior, fitted)
        if moved < tolerance:
            break
    return model


def weak_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
                 threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs`` without the text: its other columns, the
    statistics, one ``vote_<rule>`` per rule, ``quality`` (posterior probability
    of a good text), ``base_failed`` and ``kept``.

    A text without words (or null) has all votes abstaining and fails the base
    rule.  The statistics are computed once and written to the shared folder."""
    slim = [c for c in docs.columns if c != text]
    stats = text_statistics(docs, text).drop(text)
    voted = stats.withColumns({f"vote_{r.name}": r.vote() for r in rules})
    voted = materialise(voted, "quality")
    model = fit_votes(voted, rules)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = voted.withColumn("quality", model.posterior()).withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    added = [c for c in out.columns if c not in slim]
    return out.select(*[c for c in slim if c in out.columns], *added)


def op10_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rule and verdict of all documents.  A text without words (or null)
    fails the base rule; an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols",
                                     "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                                     "quality")
