"""Quality rules as weak supervision.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0). A generative model
says: a text is good with probability ``prior``; given that, rules that don't abstain vote on their
own, each with its own accuracy on good and on bad texts. Expectation maximisation estimates them
from the votes alone. The posterior of "good" decides whether a text is
kept, instead of asking that every rule passes. A short list of hard limits (``base_failed``) remains.

The model sees only how often each combination of votes occurs, at most 3 to the number of rules. So
one pass over all texts collects the data, whatever their number, and the posterior of a text is a
lookup by its combination.

Defined results: a null or empty text has counts 0 and base_failed; repeated rows get equal results;
an empty table gives an empty result (the model keeps its starting point). Input columns with the
names of result columns are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WordHash, annotate, chain

COUNTS = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, "
          "n_upper long, n_alpha long, n_digits long, n_distinct long, n_short long, n_bare long, n_end_lines long")
GRAM = 5
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _covered(hashes: np.ndarray, width: int) -> int:
    """Words in windows of ``width`` words that occur twice or more."""
    grams = chain(hashes, width)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    repeated = np.zeros(len(grams) + 1, np.int64)
    repeated[order[1:][same]] = 1
    repeated[order[:-1][same]] = 1
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return int((np.cumsum(edge) > 0).sum())


def _bytes(*ranges) -> np.ndarray:
    wanted = np.zeros(256, bool)
    for first, last in ranges:
        wanted[first:last + 1] = True
    return wanted


SPACE = _bytes((9, 13), (32, 32))
CONTINUED = _bytes((0x80, 0xBF))  # all but the first byte of a character
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
UPPER, LOWER, DIGIT, BEYOND = _bytes((65, 90)), _bytes((97, 122)), _bytes((48, 57)), _bytes((0xC2, 0xF4))


def text_counts():
    """A function from texts to the columns of ``COUNTS``."""
    hashes = WordHash()

    def one(text: str | None) -> tuple:
        if not text:
            return (0,) * 13
        raw = text.encode()
        words = raw.split()
        h = hashes.of(words)
        lines = [line for line in raw.split(b"\n") if line.strip()]
        seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        return (len(words), int(seen[~CONTINUED & ~SPACE].sum()), int(seen[SYMBOL].sum()), len(lines),
                len(lines) - len(set(lines)), _covered(h, GRAM), int(seen[UPPER].sum()),
                int(seen[UPPER | LOWER | BEYOND].sum()), int(seen[DIGIT].sum()), len(np.unique(h)),
                sum(1 for w in words if len(w) <= 3),
                sum(1 for w in words if len(w) <= 3 and not w.strip(PUNCTUATION)), sum(1 for line in lines if line.rstrip()[-1:] in b".!?\"'"))

    return lambda texts: list(map(list, zip(*map(one, texts))))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), -1).when(F.coalesce(good, F.lit(False)), 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Name to vote. Shares are of words, characters or lines of the text."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    enough = F.col("n_words") >= 30
    return {
        "symbols": _vote(F.col("n_symbols") > 0.1 * words, F.col("n_symbols") < 0.02 * words),
        "word_length": _vote((chars < 2.5 * words) | (chars > 11 * words), chars.between(3 * words, 9 * words)),
        "repeated_words": _vote(F.col("n_repeat_words") > 0.2 * words, enough & (F.col("n_repeat_words") < 0.05 * words)),
        "repeated_lines": _vote(F.col("n_dup_lines") > 0.3 * lines,
                                (F.col("n_lines") >= 3) & (F.col("n_dup_lines") < 0.1 * lines)),
        "capitals": _vote(F.col("n_upper") > 0.3 * F.greatest(F.col("n_alpha"), F.lit(1)),
                          F.col("n_upper").between(0.002 * F.col("n_alpha"), 0.12 * F.col("n_alpha"))),
        "letters": _vote(F.col("n_alpha") < 0.7 * chars, F.col("n_alpha") > 0.85 * chars),
        "variety": _vote(enough & (F.col("n_distinct") < 0.25 * F.least(words, F.lit(400))),
                         enough & (F.col("n_distinct") > 0.4 * F.least(words, F.lit(400)))),
        "short_words": _vote(enough & (F.col("n_short") < 0.08 * words),
                             enough & F.col("n_short").between(0.15 * words, 0.75 * words)),
        "bare_symbols": _vote(F.col("n_bare") > 0.1 * words, F.col("n_bare") < 0.02 * words),
        "line_ends": _vote(enough & (F.col("n_end_lines") < 0.1 * lines), F.col("n_end_lines") > 0.5 * lines),
    }


def fit(patterns: np.ndarray, weights: np.ndarray, rounds: int = 60, strength: float = 0.02) -> tuple[float, np.ndarray]:
    """Prior and p[class, rule] = P(rule votes good | class, it votes) by expectation maximisation.

    An abstention says nothing: what decides whether a rule applies, as the length of a text, isn't
    quality. The starting point also serves as ``strength`` times the texts of pseudo-votes; it says
    that a bad vote is rare on a good text, which fixes which class is the good one.
    """
    start = np.array([[0.6], [0.98]]).repeat(patterns.shape[1], axis=1)
    table, prior, total = start.copy(), 0.9, weights.sum()
    if not total:
        return prior, table
    up, voted = (patterns == 1).astype(float), (patterns != 0).astype(float)
    for _ in range(rounds):
        good = posterior(patterns, prior, table)
        for c, share in enumerate(((1 - good) * weights, good * weights)):
            pseudo = strength * total * (prior if c else 1 - prior) + 1
            table[c] = (share @ up + pseudo * start[c]) / (share @ voted + pseudo)
        prior = float(np.clip((good * weights).sum() / total, 0.01, 0.99))
    return prior, table


def posterior(patterns: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    up, down = patterns == 1, patterns == -1
    log = [up @ np.log(table[c]) + down @ np.log1p(-table[c]) for c in (0, 1)]
    return 1 / (1 + (1 - prior) / prior * np.exp(np.clip(log[0] - log[1], -500, 500)))


def weak_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without their text, with the counts, base_failed, the votes, quality and kept."""
    counted = annotate(docs, COUNTS, text_counts)
    votes = rules()
    names = list(votes)
    code = sum(((F.col(f"vote_{n}") + 1) * 3 ** i for i, n in enumerate(names)), F.lit(0))
    drop = [c for c in counted.columns if c.lower() in {*(f"vote_{n}" for n in names), "quality", "kept", "base_failed", "__code"}]
    voted = (counted.drop(*drop).withColumns({f"vote_{n}": v.cast("int") for n, v in votes.items()})
             .withColumn("__code", code.cast("int")))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    voted = cut_lineage(voted.withColumn("base_failed", base), "rule-votes")
    # At most 3 ** len(rules) rows. The model explains the texts that are left to it.
    seen = voted.groupBy("__code").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("count")).collect()
    codes = np.array([r["__code"] for r in seen], np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(len(names)) % 3 - 1).astype(int).reshape(-1, len(names))
    prior, table = fit(patterns, np.array([r["count"] for r in seen], float))
    good = posterior(patterns, prior, table) if len(seen) else np.empty(0)
    lookup = voted.sparkSession.createDataFrame(
        [(int(c), float(q)) for c, q in zip(codes, good)], "__code int, quality double")
    return (voted.join(F.broadcast(lookup), "__code").drop("__code")
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
