"""Quality classifier by positive-unlabelled learning.

The classifier is linear in text statistics and is trained without any negative label. With logistic
loss, class prior q, trusted positives P and unlabelled web text U, the risk is::

    q E_P[loss(g)]  +  max(0, E_U[loss(-g)] - q E_P[loss(-g)])

The second part estimates the risk on negatives and is held at zero from below; where it would go
under zero the step goes back. Each round is one pass over the written features of all of P and U:
tasks send sums of losses, gradients and curvatures, a few kilobytes whatever the data, and the next
Newton step is taken from them, with several step lengths tried in one pass.

The class prior is estimated from the data. Among texts that score above t, U holds at least q times
the share that P holds, so the smallest ratio of the two shares bounds q; it is read off histograms of
the scores of a first fit.

Defined results: a null or empty text has zero statistics and a score like any other; without trusted
positives or without unlabelled texts nothing can be learnt, and all scores are 0.5; a null doc_id has no label
and is not held out; repeated rows get equal scores; labels repeated for a doc_id count once, as
positive if all of them are; an empty table gives an empty result. Result columns replace input
columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import annotate, crc_fold
from .weak_rules import text_counts

ROUNDS = 10
BINS = 2000
STEPS = (1.0, 0.5, 0.2, 0.05)
#: Ridge: a constant, and a part that fades as trusted positives get more.
RIDGE, RIDGE_ROWS = 1e-4, 3.0


def features(counts: list[list[int]]) -> np.ndarray:
    """Shares and their logarithms from the counts of ``text_counts``."""
    (words, chars, symbols, lines, dup_lines, repeats, upper, alpha, digits, distinct, short, bare,
     end_lines) = np.array(counts, np.float64).reshape(13, -1)
    w, c, n = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    shares = np.stack([
        symbols / w, symbols / c, upper / np.maximum(alpha, 1), alpha / c, digits / c, dup_lines / n, repeats / w,
        distinct / w, short / w, bare / w, end_lines / n, (c - alpha - digits) / c], axis=1)
    sizes = np.stack([np.log1p(words), np.log1p(words / n), chars / w, np.log1p(distinct) - 0.7 * np.log1p(words)], axis=1)
    steps = np.stack([symbols > 0.1 * w, repeats > 0.1 * w, repeats > 0.5 * w, dup_lines > 0.3 * n, upper > 0.3 * alpha,
                      bare > 0.05 * w, alpha < 0.75 * c, distinct < 0.3 * w], axis=1)
    return np.hstack([shares, np.log(shares + 1e-3), sizes, steps]).astype(np.float32)


def _build():
    count = text_counts()

    def work(texts):
        return [list(features(count(texts)))]

    return work


def _sums(table: DataFrame, wanted, size: int) -> np.ndarray:
    """The sum over all rows of ``wanted(x, positive)``, a vector of ``size`` numbers."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                total += wanted(x.astype(np.float64), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    rows = (table.select("features", "positive").mapInArrow(run, "i long, v double")
            .groupBy("i").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(size)
    for row in rows:
        out[row["i"]] = row["v"]
    return out


def _softplus(z):
    return np.logaddexp(0, z)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _design(x, mean, scale):
    return np.hstack([np.clip((x - mean) / scale, -6, 6), np.ones((len(x), 1))])


def fit(table: DataFrame, prior: float, mean, scale, counts, start: np.ndarray, rounds: int) -> np.ndarray:
    """Weights of least non-negative risk. ``counts``: rows of U and P."""
    n_u, n_p = counts
    strength = RIDGE + RIDGE_ROWS / n_p
    d = len(mean) + 1
    per = 3 + 2 * d + d * d  # losses on P, on -P and on -U; gradients on -U and on -P; curvature

    def terms(candidates):
        def wanted(x, positive):
            a = _design(x, mean, scale)
            u, p = a[~positive], a[positive]
            out = []
            for w in candidates:
                gu, gp = u @ w, p @ w
                su = _sigmoid(gu)
                out += [[_softplus(-gp).sum(), _softplus(gp).sum(), _softplus(gu).sum()], su @ u, _sigmoid(gp) @ p,
                        ((u * (su * (1 - su))[:, None]).T @ u).ravel()]
            return np.concatenate([np.ravel(o) for o in out])

        return _sums(table, wanted, per * len(candidates)).reshape(len(candidates), per)

    sum_p = _sums(table, lambda x, positive: _design(x[positive], mean, scale).sum(axis=0), d) / n_p
    candidates, best = [start], None
    for _ in range(rounds):
        for w, t in zip(candidates, terms(candidates)):
            negative = t[2] / n_u - prior * t[1] / n_p
            risk = prior * t[0] / n_p + max(0.0, negative) + strength * w[:-1] @ w[:-1]
            if best is None or risk < best[0]:
                best = (risk, w, negative, t)
        _, w, negative, t = best
        grad_u, grad_p = t[3:3 + d] / n_u, t[3 + d:3 + 2 * d] / n_p
        ridge = np.append(np.full(d - 1, 2 * strength), 1e-9)
        curve = t[3 + 2 * d:].reshape(d, d) / n_u + np.diag(ridge)
        if negative < 0:  # go back: raise the risk on negatives
            step = np.linalg.solve(curve, grad_u - prior * grad_p)
        else:
            step = -np.linalg.solve(curve, grad_u - prior * sum_p + ridge * w)
        candidates = [w + s * step for s in STEPS]
    return best[1]


def estimate_prior(table: DataFrame, w, mean, scale, counts) -> float:
    """The least ratio of U's to P's share above a score, over scores that a tenth of P exceeds."""
    n_u, n_p = counts

    def wanted(x, positive):
        place = np.minimum((_sigmoid(_design(x, mean, scale) @ w) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(place[~positive], minlength=BINS), np.bincount(place[positive], minlength=BINS)])

    hist = _sums(table, wanted, 2 * BINS).reshape(2, BINS)
    above = np.cumsum(hist[:, ::-1], axis=1)
    share_u, share_p = above[0] / n_u, above[1] / n_p
    enough = share_p >= 0.1
    # The upper end of what counting noise allows: a bound should not fall by chance.
    noise = np.sqrt(share_u[enough] * (1 - share_u[enough]) / n_u) + np.sqrt(share_p[enough] * (1 - share_p[enough]) / n_p)
    ratio = (share_u[enough] + noise) / share_p[enough]
    return float(np.clip(ratio.min(), 0.05, 0.99))


def pu_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_fold: int = 0,
               rounds: int = ROUNDS, keep_text: bool = False) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted.

    Labels of rows in the held-out fold are never read, nor are their texts trained on.
    """
    names = ("held_out", "score", "predicted")
    plain = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]).withColumn(
        "held_out", F.coalesce(crc_fold("doc_id", folds) == held_fold, F.lit(False)))
    seen = (labels.where(crc_fold("doc_id", folds) != held_fold).groupBy("doc_id")
            .agg((F.min("quality") == 1).alias("positive")))
    # Only statistics are written; texts are read a second time to be scored.
    described = annotate(plain.where(~F.col("held_out")).select("doc_id", "text"), "features array<float>", _build)
    # Trusted positives, and texts without any label; known negatives take no part.
    table = (described.join(seen.withColumn("known", F.lit(True)), "doc_id", "left")
             .where("known is null or positive").select("features", F.coalesce("positive", F.lit(False)).alias("positive")))
    table = cut_lineage(table, "pu-table")
    n = table.groupBy("positive").count().collect()
    counts = tuple(next((r["count"] for r in n if r["positive"] is side), 0) for side in (False, True))
    if not all(counts):
        none = plain if keep_text else plain.drop("text")
        return none.withColumns({"score": F.lit(0.5), "predicted": F.lit(int(threshold <= 0.5))})
    d = len(features([[0]] * 13)[0])
    moments = _sums(table, lambda x, positive: np.concatenate([x[~positive].sum(axis=0), (x[~positive] ** 2).sum(axis=0)]), 2 * d)
    mean = moments[:d] / counts[0]
    scale = np.sqrt(np.maximum(moments[d:] / counts[0] - mean ** 2, 1e-12)) + 1e-3
    first = fit(table, 0.5, mean, scale, counts, np.zeros(d + 1), rounds // 2)
    prior = estimate_prior(table, first, mean, scale, counts)
    weights = fit(table, prior, mean, scale, counts, first, rounds)
    release(table)

    def build():
        count = text_counts()

        def work(texts):
            value = _sigmoid(_design(features(count(texts)).astype(np.float64), mean, scale) @ weights)
            return [value, (value >= threshold).astype(np.int32)]

        return work

    return annotate(plain, "score double, predicted int", build, keep_text=keep_text)
