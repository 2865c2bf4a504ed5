"""Hidden Markov language model, with a unigram model beside it.

Tokens are lower-cased words and one end per text. Words are counted over all training texts. A hidden
Markov chain of ``states`` latent states emits words. Training rounds know the ``symbols`` most frequent tokens
one by one, and any other word by its class (a hash of its last bytes). A last round then counts every
word in every state, so each training word, however rare, ends with emissions of its own: the state emits the
class, and within its class a word w of n occurrences has the share ``(n_c e(w, s) / e(c, s) + 0.5) / (n_c + 0.5 (v_c + 1))``,
where e are expected counts in state s and n_c and v_c the occurrences and words of the class. Averaged over states that is
the unigram formula; unknown words get 0.5 in place of the first term. So every text has a proper probability.

Baum-Welch: tasks run scaled forward and backward recursions over all training texts, each in whole,
and send expected counts of emissions, transitions and starts; Spark adds them up and the driver
normalises. Texts are dealt to ``PARTS`` parts by a hash of doc_id; a round takes one part after the other, and after each the
part's new counts replace its old ones in the sums that the next model comes from. Rounds end when one gains less than
``GAIN`` a token, or after ``rounds``. The first model is
the unigram model tilted at random; no sample of texts shapes it. The score of a text is the exact scaled
forward recursion over the whole text.

What is sent to tasks is bounded: the ``HEAD`` most frequent words with counts and emissions, and the model.
The table of emissions has a row for every other training word; these meet the texts in a join, once per text and word.

Defined results: texts of any length are one sequence each, worked on in blocks; a null or empty text is the end alone; without training tokens all probabilities are
those of the unigram formula and score equals base_score; a null doc_id is not held out; repeated rows
get equal scores; an empty table gives an empty result. Other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import brief_shuffles, cut_lineage, release
from .common import crc_fold, most_frequent, slices

HEAD = 1 << 18
SYMBOLS = 1 << 14
CLASSES = 256
STATES = 8
#: Training ends when a round gains less log likelihood a token, or after so many rounds.
GAIN, ROUNDS = 1e-3, 50
#: Parts of the training texts after which the model is renewed.
PARTS = 4
#: Precision of forward and backward values while training; counts are added up in double precision.
PRECISION = np.float32
#: Texts worked on at once, the steps whose forward values are kept, and about how many tokens these hold.
BATCH, BLOCK, HELD = 2048, 1024, 1 << 19
#: Steps after which forward values are scaled, by precision, so that none gets too small. Divide ``BLOCK``.
SCALE = {"float32": 2, "float64": 8}
#: Rare words a task holds before it reports them.
LOCAL = 1 << 16
#: Training tokens a task of the last round counts at least: each task reports most frequent words once.
TASK_TOKENS = 1 << 22
#: The end of a text; words hold no line end.
END = b"\n"


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def _tokens(text: str | None) -> list[bytes]:
    return [*(text.encode().lower().split() if text else ()), END]


def count_words(texts: DataFrame) -> DataFrame:
    """word and n of all tokens of ``text``."""

    def run(batches):
        held: Counter = Counter()

        def report():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
                                              ["word", "n"])

        for piece in slices(batches, "text"):
            for text in piece.column("text").to_pylist():
                held.update(_tokens(text))
            if len(held) > 500_000:
                yield report()
                held.clear()
        yield report()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Counts of the frequent words, their symbols, and the size of each class."""

    def __init__(self, words: list[bytes], counts: np.ndarray, class_n: np.ndarray, class_v: np.ndarray,
                 total: int, distinct: int, symbols: int):
        self.number = {w: i for i, w in enumerate(words)}
        self.total, self.distinct = total, distinct
        self.share = total + 0.5 * (distinct + 1)
        own = min(symbols, len(words))
        self.own = own
        self.class_n, self.class_size = class_n, class_n + 0.5 * (class_v + 1)
        self.classes = np.array([class_of(w) for w in words[own:]], np.int64)
        self.symbol = np.concatenate([np.arange(own), own + self.classes]).astype(np.uint16)
        self.log = np.log10(counts + 0.5)
        #: Expected share of each symbol among training tokens.
        self.unigram = np.concatenate([counts[:own] + 0.5, self.class_size])
        self.unigram /= self.unigram.sum()


def build_vocabulary(words: DataFrame, head: int, symbols: int) -> Vocabulary:
    top = most_frequent(words, "n", head).toArrow()
    found = sorted(zip(top.column("n").to_pylist(), map(bytes, top.column("word").to_pylist())), key=lambda x: (-x[0], x[1]))
    kept = [word for _, word in found]
    counts = np.array([n for n, _ in found], np.float64)
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    own = set(kept[:symbols])

    def run(batches):
        n, v = np.zeros(CLASSES), np.zeros(CLASSES)
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if word not in own:
                    k = class_of(word)
                    n[k] += c
                    v[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(v)], ["k", "n", "v"])

    classes = (words.mapInArrow(run, "k long, n double, v double").groupBy("k")
               .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in classes:
        class_n[row["k"]], class_v[row["k"]] = row["n"], row["v"]
    return Vocabulary(kept, counts, class_n, class_v, sums["n"] or 0, sums["v"], symbols)


def encode(docs: DataFrame, vocabulary) -> DataFrame:
    """Symbols of each text, what its frequent words add to the unigram score, and its other words with counts.

    ``rest`` tells the words behind the symbols of classes: a place in the head, or behind it in ``others``.
    """

    def run(batches):
        v = vocabulary.value
        get, log_share, head = v.number.get, np.log10(v.share), len(v.number)
        for piece in slices(batches, "text"):
            rows = []
            for text in piece.column("text").to_pylist():
                tokens = _tokens(text)
                ids = np.fromiter((get(w, -1) for w in tokens), np.int64, len(tokens))
                known, tail = ids[ids >= 0], np.flatnonzero(ids < 0)
                symbol = v.symbol[ids] if head else np.zeros(len(ids), np.uint16)
                other: dict[bytes, int] = {}
                at = np.array([other.setdefault(tokens[i], len(other)) for i in tail.tolist()], np.int64)
                classes = np.array([class_of(w) for w in other], np.int64)
                symbol[tail] = v.own + classes[at]
                ids[tail] = head + at
                base = v.log[known].sum() - len(tokens) * log_share
                rows.append((len(tokens), len(known), float(base), symbol.tobytes(),
                             ids[symbol >= v.own].astype(np.uint32).tobytes(), list(other), np.bincount(at)))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            new = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), *new], names)

    names = ["doc_id", "held_out", "n_tokens", "head_known", "head_base", "symbols", "rest", "others", "times"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, head_known long, head_base double, "
             "symbols binary, rest binary, others array<binary>, times array<long>")


class Model:
    """start[state]; move[from, to]; emit[symbol, state]."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit


def _groups(texts: list[np.ndarray]):
    """Texts of like length, as many as are worked on at once."""
    part, held = [], 0
    for text in sorted(texts, key=lambda s: -len(s)):
        part.append(text)
        held += min(len(text), BLOCK)
        if len(part) == BATCH or held >= HELD:
            yield part
            part, held = [], 0
    if part:
        yield part


def _block(part: list[np.ndarray], length: np.ndarray, begin: int):
    """Texts active at each step, where each step begins, and the symbols step by step."""
    active = np.searchsorted(-length, -np.arange(begin, min(begin + BLOCK, length[0])), side="left")
    place = np.cumsum(active) - active
    symbol = np.empty(active.sum(), np.int64)
    for i in range(active[0]):
        s = part[i][begin:begin + BLOCK]
        symbol[place[:len(s)] + i] = s
    return active.tolist(), place.tolist(), symbol


def expected_counts(model: Model, texts: list[np.ndarray]):
    """Starts, moves, emissions and log likelihood, by scaled forward and backward recursion.

    Texts run side by side, the longest first, in the precision of ``model.emit``. Emissions are taken relative to
    the symbol's largest, and forward values scaled every few steps. They are kept for ``BLOCK`` steps; longer texts
    keep those between blocks, and compute a block again on the way back.
    """
    k, size, kind = model.move.shape[0], len(model.emit), model.emit.dtype
    starts, moves, emitted, loglik = np.zeros(k), np.zeros((k, k)), np.zeros((k, size)), 0.0
    level, every, ones = model.emit.max(axis=1), SCALE[kind.name], np.ones(k, kind)
    emit, start, move = model.emit / level[:, None], model.start.astype(kind), model.move.astype(kind)
    back, room = np.ascontiguousarray(move.T), np.empty((2, 0, k), kind)
    for part in _groups(texts):
        length = np.array([len(s) for s in part])

        def run_forward(active, place, symbol, last):
            nonlocal room
            if room.shape[1] < len(symbol):
                room = np.empty((2, len(symbol), k), kind)
            seen, alpha, scale = room[0, :len(symbol)], room[1, :len(symbol)], {}
            np.take(emit, symbol, axis=0, out=seen, mode="clip")
            for t, (n, at) in enumerate(zip(active, place)):
                a = alpha[at:at + n]
                if last is None:
                    np.multiply(seen[at:at + n], start, out=a)
                else:
                    np.matmul(last[:n], move, out=a)
                    a *= seen[at:at + n]
                if t % every == every - 1:
                    scale[t] = (a @ ones)[:, None]
                    a /= scale[t]
                last = a
            return seen, alpha, scale, last.copy()

        begins, entry = range(0, length[0], BLOCK), [None]
        for begin in begins:
            steps = _block(part, length, begin)
            seen, alpha, scale, last = run_forward(*steps, entry[-1])
            entry.append(last)
            loglik += float(np.log(np.concatenate([*scale.values(), np.ones((1, 1))]), dtype=np.float64).sum())
        beta, ahead = np.ones((len(part), k), kind), None
        for number in reversed(range(len(begins))):
            if number + 1 < len(begins):
                steps = _block(part, length, begins[number])
                seen, alpha, scale, _ = run_forward(*steps, entry[number])
            active, place, symbol = steps
            for t in reversed(range(len(active))):
                n, at = active[t], place[t]
                here, m = alpha[at:at + n], 0
                if ahead is not None:
                    m = len(ahead)
                    moves += here[:m].T @ ahead
                    np.matmul(ahead, back, out=beta[:m])
                if m < n:  # texts that end here
                    total = (here[m:] @ ones)[:, None]
                    loglik += float(np.log(total, dtype=np.float64).sum())
                    beta[m:n] = 1 / total
                ahead = seen[at:at + n]
                ahead *= beta[:n]
                if t in scale:
                    ahead /= scale[t]
                here *= beta[:n]  # now the posterior of states
            ahead = ahead.copy()  # its block is about to be written over
            for s in range(k):
                emitted[s] += np.bincount(symbol, alpha[:, s], minlength=size)
        starts += alpha[:len(part)].sum(axis=0, dtype=np.float64)
    loglik += float(emitted.sum(axis=0) @ np.log(level))
    return starts, moves * model.move, emitted.T, loglik


def normalise(starts, moves, emitted, unigram, smooth: float = 200.0) -> Model:
    """The next model: expected counts with a little of the unigram model."""
    k = len(moves)
    start = (starts + 0.1) / (starts + 0.1).sum()
    move = (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)
    emit = emitted + smooth * unigram[:, None]
    return Model(start, move, emit / emit.sum(axis=0, keepdims=True)) if k else None


def start_model(unigram: np.ndarray, states: int, seed: int = 7) -> Model:
    """A starting point that no text shapes: the unigram model, tilted at random in each state."""
    rng = np.random.default_rng(seed)
    emit = unigram[:, None] * np.exp(rng.normal(0, 0.7, (len(unigram), states)))
    return Model(np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states),
                 emit / emit.sum(axis=0))


def part_counts(train: DataFrame, model: Model):
    """Expected counts and log likelihood of all rows of ``train`` (column symbols); None without rows."""
    model = Model(model.start, model.move, model.emit.astype(PRECISION))
    sent = train.sparkSession.sparkContext.broadcast(model)
    k, size, kind = model.move.shape[0], len(model.emit), model.emit.dtype
    states = [f"s{i}" for i in range(k)]

    def run(batches):
        total = None
        held, tokens = [], 0

        def work(total):
            new = expected_counts(sent.value, held)
            return new if total is None else tuple(a + b for a, b in zip(total, new))

        for batch in batches:
            for symbols in batch.column("symbols").to_pylist():
                held.append(np.frombuffer(symbols, np.uint16))
                tokens += len(symbols) // 2
                if tokens + 64 * len(held) > 4 * HELD:
                    total = work(total)
                    held, tokens = [], 0
        if held:
            total = work(total)
        if total is not None:
            starts, moves, emitted, loglik = total
            # One table: symbols, then moves, starts and the log likelihood.
            table = np.vstack([emitted, moves, starts[None], np.full((1, k), loglik)])
            used = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(table[used, i].astype(kind)) for i in range(k))], ["i", *states])

    named = {"float32": "float", "float64": "double"}[kind.name]
    with brief_shuffles(train.sparkSession):
        sums = (train.select("symbols").mapInArrow(run, "i long, " + ", ".join(f"{s} {named}" for s in states))
                .groupBy("i").agg(*[F.sum(s).alias(s) for s in states]).toArrow())
    sent.unpersist()
    if not sums.num_rows:
        return None
    table = np.zeros((size + k + 2, k))
    place = sums.column("i").to_numpy()
    for i, s in enumerate(states):
        table[place, i] = sums.column(s).to_numpy()
    return table[size + k], table[size:size + k], table[:size], float(table[-1, 0])


def fit(train: DataFrame, vocabulary: Vocabulary, states: int, rounds: int) -> Model:
    """Rounds of Baum-Welch over all rows of ``train`` (columns symbols and part)."""
    model, before, kept = start_model(vocabulary.unigram, states), -np.inf, {}
    for _ in range(rounds):
        loglik = 0.0
        for part in range(PARTS):
            found = part_counts(train.where(F.col("part") == part), model)
            if found is not None:
                *kept[part], gained = found
                loglik += gained
                model = normalise(*(sum(of) for of in zip(*kept.values())), vocabulary.unigram)
        if loglik - before < GAIN * vocabulary.total:
            break
        before = loglik
    return model


def word_counts(train: DataFrame, model: Model, vocabulary) -> DataFrame:
    """Counts of every word that shares its symbol: class, i (place in the head) or word, n, and in the states s0, s1, ..."""
    sent = train.sparkSession.sparkContext.broadcast(model)
    k = len(model.move)
    states = [f"s{i}" for i in range(k)]

    def run(batches):
        v, model = vocabulary.value, sent.value
        head, own = len(v.number), v.own
        sums, held, tokens, local = np.zeros((head - own, k)), [], 0, {}

        def rows(i, word, c, e):
            return pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int64()), pa.array(word, pa.binary()), pa.array(c, pa.int64()),
                 pa.array(np.rint(e.sum(axis=1)).astype(np.int64)),  # states of a token add up to 1
                 *(pa.array(e[:, s].astype(np.float32)) for s in range(k))], ["i", "word", "class", "n", *states])

        def work():
            classes = np.array([class_of(w) for w in local], np.int64)
            symbol = np.concatenate([v.symbol.astype(np.int64), own + classes])
            # Only words that these texts hold get a row of emissions.
            number = np.zeros(len(symbol), np.int64)
            for x in held:
                number[x] = 1
            used = np.flatnonzero(number)
            number[used] = np.arange(len(used))
            emitted = expected_counts(Model(model.start, model.move, model.emit[symbol[used]]), [number[x] for x in held])[2]
            begin, end = np.searchsorted(used, [own, head])
            sums[used[begin:end] - own] += emitted[begin:end]
            return rows([None] * len(local), list(local), classes, emitted[end:])

        for batch in slices(batches, "symbols"):
            for symbols, rest, others in zip(*(batch.column(c).to_pylist() for c in ("symbols", "rest", "others"))):
                x = np.frombuffer(symbols, np.uint16).astype(np.int64)
                new = [local.setdefault(w, head + len(local)) for w in others]
                held.append(_wide(x, rest, own, head, np.array(new, np.int64)))
                tokens += len(x)
                if tokens > 4 * HELD or len(local) > LOCAL:
                    yield work()
                    held, tokens, local = [], 0, {}
        if held:
            yield work()
        used = np.flatnonzero(sums.any(axis=1))
        yield rows(own + used, [None] * len(used), v.classes[used], sums[used])

    return (train.select("symbols", "rest", "others").coalesce(-(-vocabulary.value.total // TASK_TOKENS))
            .mapInArrow(run, "i long, word binary, class long, n long, " + ", ".join(f"{s} float" for s in states))
            .groupBy("i", "word", "class").agg(*[F.sum(s).alias(s) for s in ("n", *states)]))


def _wide(symbols: np.ndarray, rest: bytes, own: int, head: int, others: np.ndarray) -> np.ndarray:
    """``symbols`` with those of classes replaced by their words: places in the head, or numbers of ``others``."""
    ids = np.frombuffer(rest, np.uint32).astype(np.int64)
    far = ids >= head
    ids[far] = others[ids[far] - head]
    symbols[symbols >= own] = ids
    return symbols


class Emissions:
    """The model with the share of every frequent word within its class, state by state."""

    def __init__(self, model: Model, vocabulary: Vocabulary, counts: DataFrame):
        k = len(model.move)
        states = [f"s{i}" for i in range(k)]
        self.model, self.own, self.head = model, vocabulary.own, len(vocabulary.number)
        self.class_n, self.class_size = vocabulary.class_n, vocabulary.class_size
        self.of_class = np.zeros((CLASSES, k))
        for row in counts.groupBy("class").agg(*[F.sum(s).alias(s) for s in states]).collect():
            self.of_class[row["class"]] = [row[s] for s in states]
        self.classes = vocabulary.classes
        found = counts.where("i is not null").select("i", *states).toArrow()
        counted = np.zeros((self.head - self.own, k))
        place = found.column("i").to_numpy() - self.own
        for i, s in enumerate(states):
            counted[place, i] = found.column(s).to_numpy()
        self.within = self.share(counted, self.classes).astype(np.float32)

    def share(self, counted: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Share of words in their classes, by state. A word counted nowhere is an unknown one."""
        part = counted / np.maximum(self.of_class[classes], 1e-300)
        return (part * self.class_n[classes, None] + 0.5) / self.class_size[classes, None]

    def known(self) -> np.ndarray:
        """Emissions of the head."""
        emit = self.model.emit
        return np.concatenate([emit[:self.own], emit[self.own + self.classes] * self.within])

    def others(self, counted: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return self.model.emit[self.own + classes] * self.share(counted, classes)


def relative(emit: np.ndarray):
    """Emissions relative to the symbol's largest, and the logarithm of that."""
    level = emit.max(axis=1)
    return emit / level[:, None], np.log(level)


def forward(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each symbol sequence: one scaled forward recursion, texts side by side."""
    return _forward(model, *relative(model.emit), texts)


def _forward(model: Model, emit: np.ndarray, log_level: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out, done = np.zeros(len(texts)), 0
    for part in _groups([texts[i] for i in order]):
        length, last, total = np.array([len(s) for s in part]), None, np.zeros(len(part))
        for begin in range(0, length[0], BLOCK):
            active, place, symbol = _block(part, length, begin)
            seen = emit.take(symbol, axis=0)
            for t, (n, at) in enumerate(zip(active, place)):
                if last is not None and n < len(last):
                    total[n:len(last)] += np.log(last[n:].sum(axis=1))
                a = seen[at:at + n]
                a *= model.start if last is None else last[:n] @ model.move
                if t % 8 == 7:
                    scale = a.sum(axis=1)
                    total[:n] += np.log(scale)
                    a /= scale[:, None]
                last = a
        total[:len(last)] += np.log(last.sum(axis=1))
        total += [log_level[s].sum() for s in part]
        out[order[done:done + len(part)]] = total
        done += len(part)
    return out / np.log(10)


def _met(batch: pa.RecordBatch, emissions: Emissions, states: int):
    """Sequences of words, those beyond the head numbered behind it text by text, and their counts by state and classes."""
    own, head = emissions.own, emissions.head
    symbols, rest, met = (batch.column(c) for c in ("symbols", "rest", "met"))
    x = np.frombuffer(b"".join(symbols.to_pylist()), np.uint16).astype(np.int64)
    ids = np.frombuffer(b"".join(rest.to_pylist()), np.uint32).astype(np.int64)
    text = np.repeat(np.arange(len(batch)), pc.binary_length(rest).to_numpy() // 4)
    far = np.flatnonzero(ids >= head)
    size = np.zeros(len(batch), np.int64)
    np.maximum.at(size, text[far], ids[far] - head + 1)
    begin = np.cumsum(size) - size
    ids[far] += begin[text[far]]
    classed = np.flatnonzero(x >= own)
    classes = np.zeros(size.sum(), np.int64)
    classes[ids[far] - head] = x[classed[far]] - own
    x[classed] = ids
    counted = np.zeros((len(classes), states))
    place, e = met.flatten().flatten()
    text = np.repeat(np.arange(len(batch)), pc.fill_null(pc.list_value_length(met), 0).to_numpy())
    counted[begin[text] + place.to_numpy()] = e.flatten().to_numpy().reshape(-1, states)
    return np.split(x, np.cumsum(pc.binary_length(symbols).to_numpy()[:-1] // 2)), counted, classes


def score_texts(docs: DataFrame, folds: int = 5, held_fold: int = 1, states: int = STATES, rounds: int = ROUNDS,
                head: int = HEAD, symbols: int = SYMBOLS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each text."""
    context = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", F.coalesce(crc_fold("doc_id", folds) == held_fold, F.lit(False)).alias("held_out"),
                        F.col("text").cast("string").alias("text"))
    words = cut_lineage(count_words(texts.where("not held_out")), "words")
    vocabulary = build_vocabulary(words, head, symbols)
    release(words)
    sent = context.broadcast(vocabulary)
    # Written once: row numbers and everything else below come from the written table.
    encoded = cut_lineage(encode(texts, sent).select(
        "*", F.monotonically_increasing_id().alias("row"), F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part")),
        "encoded", by="part")
    total = F.lit(vocabulary.total).cast("long").alias("train_tokens")
    if not vocabulary.total:
        # No word is known, so all have the count 0.
        base = F.col("head_base") + (F.col("n_tokens") - F.col("head_known")) * F.log10(F.lit(0.5))
        return encoded.select("doc_id", "held_out", "n_tokens", F.lit(0).cast("long").alias("n_known"), total,
                              base.alias("base_score"), base.alias("score"))
    train = encoded.where("not held_out")
    model = fit(train, vocabulary, states, rounds)
    counts = cut_lineage(word_counts(train, model, sent), "emissions")
    emissions = context.broadcast(Emissions(model, vocabulary, counts))
    # Words beyond the head meet their counts and emissions.
    names = [f"s{i}" for i in range(states)]
    rare = counts.where("word is not null").select("word", "n", F.array(*[F.col(s).cast("float") for s in names]).alias("e"))
    others = (encoded.select("row", F.posexplode(F.arrays_zip("others", "times")).alias("place", "o"))
              .select("row", "place", F.col("o.others").alias("word"), F.col("o.times").alias("times")))
    seen = F.when(F.col("n").isNotNull(), F.struct("place", "e"))
    # Written, so that the words' shuffles and the table of emissions go before whole texts move.
    found = cut_lineage(others.join(rare, "word", "left").select("row", "place", "times", "n", "e"), "met")
    release(counts)
    met = found.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("tail_known"),
        F.collect_list(seen).alias("met"))

    def likelihood(batches):
        m = emissions.value
        emit, level = relative(m.known())
        for batch in slices(batches, "symbols"):
            sequences, counted, classes = _met(batch, m, states)
            if len(emit) < m.head + len(classes):
                room = np.empty((m.head + 2 * len(classes), states))
                room[:m.head], emit = emit[:m.head], room
                level = np.append(level[:m.head], np.empty(2 * len(classes)))
            there = slice(m.head, m.head + len(classes))
            emit[there], level[there] = relative(m.others(counted, classes))
            score = _forward(m.model, emit, level, sequences)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(score)], [*carried, "score"])

    carried = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    kind = encoded.schema["doc_id"].dataType.simpleString()
    scored = encoded.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("head_base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"), "symbols", "rest", "met").mapInArrow(
        likelihood, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", total, "base_score", "score")
