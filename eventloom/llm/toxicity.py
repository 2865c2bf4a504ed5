"""Toxicity classifier with counterfactual regularisation.

A linear model over the distinct words of a text and their beginnings is fitted with logistic loss. For
every sentence of a training text that names a group of people, the group is swapped for each other
group of the same kind, and the squared change of the model's score is added to the loss. So words that
merely name a group get equal weights, and neutral mentions are not taken for toxicity because some
groups occur more often in toxic texts.

The model is fitted on the texts of at most ``sample`` labelled ids, those with the smallest hash. From
them tasks count in how many toxic and other texts each feature occurs; the ``vocabulary`` most
telling ones are kept, besides the names of groups. The encoded sample, a few numbers per text, is
fitted on the driver; rows that are encoded alike, as repeated rows are, meet in one with their number as
weight, so only different texts of an id add to it. All texts are scored whole, where they are, with the model sent to the tasks.

Defined results: a null or empty text is scored by the bias alone; without labelled texts of both
kinds all scores are the share of toxic ones, or 0; a null doc_id has no label and is not held out;
labels repeated for a doc_id count once, toxic if one says so; repeated rows get equal scores; an empty
table gives an empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import annotate, crc_fold, slices
from .decontaminate import TOKEN

#: Labelled ids whose texts the model is fitted on, at most.
SAMPLE = 50_000
VOCABULARY = 4096
#: Lengths in bytes of the beginnings of words that are features.
BEGINNINGS = range(5, 11)
# Names of groups of people, by kind and language.
IDENTITY: tuple[tuple[str, ...], ...] = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("germans", "french", "spaniards", "italians", "poles", "turks", "arabs", "mexicans", "americans", "chinese"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden", "hindus"),
    ("ausländer", "flüchtlinge", "deutsche"),
    ("femmes", "hommes"), ("femme", "homme"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "extranjeros"),
)
SENTENCE = re.compile(r"[.!?\n]+")


def _swaps(groups) -> dict[bytes, list[bytes]]:
    """Each name and those it can be swapped for; a name of two kinds has the names of both."""
    table: dict[bytes, set[bytes]] = {}
    for group in groups:
        names = {g.encode().lower() for g in group}
        for name in names:
            table.setdefault(name, set()).update(names - {name})
    return {k: sorted(v) for k, v in table.items()}


def features(words, names=frozenset()) -> set[bytes]:
    """Words and their beginnings; a group's name has none, as others may share them."""
    out = set(words)
    out.update([b"^" + w[:k] for w in out - names for k in BEGINNINGS if k < len(w)])
    return out


def _words(text: str | None) -> list[bytes]:
    return TOKEN.findall(text.encode().lower()) if text else []


def _labelled(docs: DataFrame, labels: DataFrame, sample: int, folds: int, held_fold: int) -> DataFrame:
    """Texts and labels of the sample. Its ids are broadcast: at most ``sample`` rows of two numbers."""
    usable = labels.where(crc_fold("doc_id", folds) != held_fold).where("toxic is not null")
    # A bound on the hash leaves little more than the sample to sort.
    share = min(1.0, 1.2 * sample / max(1, usable.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = (usable.where(place <= int(share * (1 << 30))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(place, "doc_id").limit(sample))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def _vocabulary(sample: DataFrame, size: int, groups) -> tuple[dict[bytes, int], int, int]:
    """Features by number, and the texts of the sample that are toxic and not."""
    names = frozenset(_swaps(groups))

    def count(batches):
        held: dict[bytes, list[int]] = {}
        texts = [0, 0]

        def report():
            keys = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), *(pa.array([held[k][i] for k in keys], pa.int64()) for i in (0, 1))],
                ["feature", "other", "toxic"])

        for piece in slices(batches, "text"):
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                side = int(toxic == 1)
                texts[side] += 1
                for f in features(_words(text), names):
                    held.setdefault(f, [0, 0])[side] += 1
            if len(held) > 300_000:
                yield report()
                held.clear()
        held[b""] = texts  # the number of texts
        yield report()

    sums = sample.mapInArrow(count, "feature binary, other long, toxic long").groupBy("feature").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).persist()
    totals = sums.where(F.octet_length("feature") == 0).first()
    n_other, n_toxic = (totals["other"], totals["toxic"]) if totals else (0, 0)
    odds = (F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("other") + 0.5) / F.lit(n_other + 1.0)))
    telling = F.abs(odds) * F.sqrt(F.col("toxic") + F.least("other", F.lit(1000)))
    top = (sums.where((F.octet_length("feature") > 0) & (F.col("toxic") + F.col("other") >= 3))
           .orderBy(telling.desc(), "feature").limit(size).select("feature").collect())
    sums.unpersist()
    kept = sorted({bytes(r["feature"]) for r in top} | names)
    return {f: i for i, f in enumerate(kept)}, n_toxic, n_other


def _encode(sample: DataFrame, vocabulary, groups):
    """Labels, feature numbers, (lost, gained) numbers of each swap, and how many texts are encoded so."""
    sent = sample.sparkSession.sparkContext.broadcast(vocabulary)
    swaps = _swaps(groups)
    names = frozenset(swaps)

    def run(batches):
        number = sent.value
        for piece in slices(batches, "text"):
            rows = []
            for text, toxic in zip(piece.column("text").to_pylist(), piece.column("toxic").to_pylist()):
                words = _words(text)
                pairs = set()
                if names & set(words):
                    for sentence in SENTENCE.split(text):
                        own = set(_words(sentence))
                        pairs |= {(number[name], number[other]) for name in own & names for other in swaps[name] if other not in own}
                rows.append((int(toxic == 1), sorted(number[f] for f in features(words, names) & number.keys()),
                             [x for p in sorted(pairs) for x in p]))
            if rows:
                kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                                                 ["toxic", "features", "pairs"])

    kind = "toxic int, features array<int>, pairs array<int>"
    table = sample.mapInArrow(run, kind).groupBy("toxic", "features", "pairs").agg(F.count("*").alias("times")).toArrow()
    return (table.column("toxic").to_numpy(), table.column("features").to_pylist(), table.column("pairs").to_pylist(),
            table.column("times").to_numpy())


def fit(label: np.ndarray, rows: list[list[int]], pairs: list[list[int]], size: int, strength: float,
        rounds: int = 300, ridge: float = 2e-4, rate: float = 0.1, toxic_weight: float = 3.0,
        times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias: mean logistic loss, ``strength`` times the mean squared change under swaps, and ridge.

    Toxic texts are rarer and count ``toxic_weight`` times. Row i stands for ``times[i]`` equal ones.
    """
    n = len(rows)
    times = np.ones(n) if times is None else times
    per = np.where(label == 1, toxic_weight, 1.0) * times
    per = per / per.sum()
    col = np.fromiter(chain.from_iterable(rows), np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    swap = np.fromiter(chain.from_iterable(pairs), np.int64).reshape(-1, 2)
    often = np.repeat(times, [len(p) // 2 for p in pairs])
    n_toxic = (label * times).sum()
    w, bias = np.zeros(size), float(np.log((n_toxic + 1) / (times.sum() - n_toxic + 1)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, rounds + 1):
        z = bias + np.bincount(row, w[col], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * per
        grad = np.bincount(col, error[row], minlength=size) + 2 * ridge * w
        if len(swap):
            change = 2 * strength / often.sum() * often * (w[swap[:, 0]] - w[swap[:, 1]])
            grad += np.bincount(swap[:, 0], change, minlength=size) - np.bincount(swap[:, 1], change, minlength=size)
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w, bias


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, strength: float = 10.0, sample: int = SAMPLE,
             vocabulary: int = VOCABULARY, groups=IDENTITY, folds: int = 5, held_fold: int = 0,
             keep_text: bool = False) -> DataFrame:
    """``docs`` with held_out, score and predicted. Labels of the held-out fold are never read."""
    chosen = _labelled(docs, labels, sample, folds, held_fold)
    number, n_toxic, n_other = _vocabulary(chosen, vocabulary, groups)
    if n_toxic and n_other:
        label, rows, pairs, times = _encode(chosen, number, groups)
        weights, bias = fit(label, rows, pairs, len(number), strength, times=times)
        weight = {f: float(weights[i]) for f, i in number.items() if weights[i]}
    else:
        weight, bias = {}, 40.0 if n_toxic else -800.0
    sent = docs.sparkSession.sparkContext.broadcast(weight)
    names = frozenset(_swaps(groups))

    def build():
        known = sent.value

        def one(text):
            z = bias + sum(sorted(known[f] for f in features(_words(text), names) & known.keys()))
            return 1 / (1 + np.exp(-z)) if z > -700 else 0.0

        def work(texts):
            score = [float(one(t)) for t in texts]
            return [score, [int(s >= threshold) for s in score]]

        return work

    scored = annotate(docs, "score double, predicted int", build, keep_text=keep_text)
    return scored.withColumn("held_out", F.coalesce(crc_fold("doc_id", folds) == held_fold, F.lit(False)))
