"""Operator 8: language-model scores of a hidden Markov model.

Training is Baum-Welch: every task runs the scaled forward-backward recursion over its documents and hands out
expected counts per state (of words, transitions, starts); Spark adds them up over all training documents, and the
re-estimated model goes back to the tasks.  Every round runs over the whole corpus, from a seeded model until the
corpus likelihood stops rising or for ``ROUNDS`` rounds.  A score is the exact likelihood of the whole sequence by the scaled
forward recursion.

Word counts cover all training documents and are a distributed table.  During the rounds the states emit the
``STATE_WORDS`` most frequent words and one class of all others.  A last round over all training documents tells
every word apart: its expected counts by state, a distributed table of all training words, say how far each state
favours it within the class (``learn_words``), so what the states learn grows with the corpus.  Counts and factors of
the ``KNOWN_WORDS`` most frequent words (at most) travel to the tasks (a bounded table), those of rarer words by a join.
"""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base
from .crossparse_lang import held_out

STATES = 8
STATE_WORDS = 20_000
KNOWN_WORDS = 200_000
#: Rounds over the whole corpus: at most, at least, and the gain (natural log likelihood a token) of one that goes on.
ROUNDS, LEAST_ROUNDS = 30, 8
LEAST_GAIN = 1e-3
#: Weight, in tokens, of the plain word distribution in each state's.
SMOOTHING = 50.0
SEED = 11
TOKENS_AT_ONCE = 750_000
SCALED = 2  # steps of a recursion from one scaling to the next
STRETCH_TOKENS = 1 << 15  # summed at once in a round
SLICE_BYTES = 2_000_000  # of text, split into words at once
#: Share of a rarer word's own states in its probability within the class of other words.
OWN = 0.9
END = ""  # the end of a text, counted as a word; no word is empty


def tokens(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case, then the end."""
    return [*text.encode().lower().split(), END.encode()]


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The ``tokens`` of all texts in one array, and where each text's begin and the last one's end."""
    # what follows the last blank, nothing, is the end
    words = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(pc.binary_join_element_wise(pc.ascii_lower(texts), "", " ")))
    return words.flatten(), words.offsets.to_numpy()


class Model:
    """start (K), move (K x K), emit (K x V): the last of the V emitted symbols is the class of other words."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, states: int, plain: np.ndarray) -> Model:
        rng = np.random.default_rng(SEED)
        emit = plain * np.exp(rng.standard_normal((states, len(plain))))
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))

    def estimated(self, counts: Counts, plain: np.ndarray) -> Model:
        """The model that the expected counts make likeliest, smoothed."""
        emit = counts.emit + SMOOTHING * plain
        move = counts.move + 0.1
        start = counts.start + 0.1
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True),
                     emit / emit.sum(axis=1, keepdims=True))


class Counts:
    def __init__(self, states: int, symbols: int):
        self.start = np.zeros(states)
        self.move = np.zeros((states, states))
        self.emit = np.zeros((states, symbols))


class Room:
    """Memory that serves one recursion after the other; fresh pages are dear."""

    def __init__(self):
        self.kept = np.empty(0, np.uint8)

    def array(self, shape: tuple[int, ...], kind: type) -> np.ndarray:
        size = math.prod(shape) * np.dtype(kind).itemsize
        if size > len(self.kept):
            self.kept = None  # given back before more is taken
            self.kept = np.empty(size, np.uint8)
        return self.kept[:size].view(kind).reshape(shape)


def _laid_out(sequences: list[np.ndarray]):
    """Sequences side by side, longest first: (order, symbols by time, sequences at each time, offsets by time)."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    offsets = np.concatenate([[0], np.cumsum(alive)])
    symbols = np.empty(offsets[-1], np.intp)
    for lane, i in enumerate(order.tolist()):
        symbols[offsets[:sizes[lane]] + lane] = sequences[i]
    return order, symbols, alive.tolist(), offsets.tolist()


def _ratios(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(V x K emission over the mean of the states, log of that mean): of a size near 1, so that the recursions are
    scaled every few steps only."""
    mean = model.emit.mean(axis=0)
    return np.ascontiguousarray((model.emit / mean).T), np.log(mean)


def forward(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each sequence (one symbol at least)."""
    order, symbols, alive, offsets = _laid_out(sequences)
    ratio, log_mean = _ratios(model)
    logs, ones = np.zeros(len(sequences)), np.ones(len(model.start))
    state = np.repeat(model.start[None, :], alive[0], axis=0)
    for t, n in enumerate(alive):
        if n < len(state):
            logs[n:len(state)] += np.log(state[n:] @ ones)
        at = symbols[offsets[t]:offsets[t + 1]]
        state = (state[:n] @ model.move if t else state) * ratio.take(at, axis=0)
        logs[:n] += log_mean[at]
        if t % SCALED == SCALED - 1:
            c = state @ ones
            state /= c[:, None]
            logs[:n] += np.log(c)
    logs[:len(state)] += np.log(state @ ones)
    out = np.empty(len(sequences))
    out[order] = logs
    return out


def _stretches(alive: list[int]):
    """(first time, time after the last) of runs of times with equally many sequences, of at most STRETCH_TOKENS."""
    at = 0
    for t in range(1, len(alive) + 1):
        if t == len(alive) or alive[t] != alive[at] or (t + 1 - at) * alive[at] > STRETCH_TOKENS:
            yield at, t
            at = t


def expect(model: Model, sequences: list[np.ndarray], counts: Counts, kind: type = np.float64, room: Room | None = None) -> float:
    """Add the expected counts of the sequences by the backward recursion; their log likelihood.  Every state emits
    every symbol; those beyond the model's are emitted as its last one and counted apart.  Keeps two numbers of the
    ``kind`` a token and state (in ``room``), one block (states x sequences) a time; the sums are double.  What is not
    a step of the recursion is done for a stretch of times at once."""
    _, symbols, alive, offsets = _laid_out(sequences)
    ratio, log_mean = _ratios(model)
    ratio, move, start = ratio.astype(kind), model.move.astype(kind), model.start.astype(kind)
    states, n_symbols = counts.emit.shape
    ones, moves = np.ones(states, kind), np.ascontiguousarray(move.T)
    flat = (room or Room()).array((2, states * len(symbols)), kind)
    stretches = [(a, b, alive[a], *(x[states * offsets[a]:states * offsets[b]].reshape(b - a, states, -1) for x in flat))
                 for a, b in _stretches(alive)]
    cuts, logs, state = {}, 0.0, None
    for a, b, n, seen, ahead in stretches:
        seen[:] = ratio.take(symbols[offsets[a]:offsets[b]], axis=0, mode="clip").reshape(b - a, n, states).transpose(0, 2, 1)
        for t, emitted, here in zip(range(a, b), seen, ahead):
            if t:
                np.dot(moves, state[:, :n], out=here)
                here *= emitted
            else:
                np.multiply(start[:, None], emitted, out=here)
            if t % SCALED == SCALED - 1:
                cuts[t] = np.dot(ones, here)
                here /= cuts[t]
            state = here
    if cuts:
        logs += np.log(np.concatenate(list(cuts.values()))).sum(dtype=np.float64)
    # back: what follows each token given its state; shares: of the states in tokens, summed by symbol when it is full
    shares = np.empty((states, max(STRETCH_TOKENS, 2 * alive[0], n_symbols)), kind)
    moved, low, m = np.zeros_like(model.move), shares.shape[1], 0

    def add_up(first):
        for k, own in enumerate(shares[:, low:]):
            counts.emit[k] += np.bincount(symbols[first:first + len(own)], weights=own, minlength=n_symbols)

    for i in range(len(stretches) - 1, -1, -1):
        a, b, n, seen, ahead = stretches[i]
        back, after = np.empty_like(ahead), np.empty_like(ahead)
        for j in range(b - a - 1, -1, -1):
            here = back[j]
            if m == n:
                np.dot(move, state, out=here)
            else:
                here[:, m:] = 1
                if m:
                    here[:, :m] = np.dot(move, state)
                logs += np.log(np.dot(ones, ahead[j][:, m:])).sum(dtype=np.float64)
            if m and (a + j) % SCALED == 0:
                here[:, :m] /= np.dot(ones, here[:, :m])
            state = np.multiply(here, seen[j], out=after[j])
            m = n
        back *= ahead
        whole = back.sum(axis=1)
        back /= whole[:, None]
        size = n * (b - a)
        if low < size:
            add_up(offsets[b])
            low = shares.shape[1]
        low -= size
        shares[:, low:low + size].reshape(states, b - a, n)[:] = back.transpose(1, 0, 2)
        for t in range(a, b):
            if t in cuts:
                whole[t - a] *= cuts[t]
        if a:
            moved += np.dot(stretches[i - 1][4][-1][:, :n] / whole[0], after[0].T)
        if b - a > 1:
            ahead[:-1] /= whole[1:, None]
            moved += np.dot(ahead[:-1].transpose(1, 0, 2).reshape(states, -1), after[1:].transpose(1, 0, 2).reshape(states, -1).T)
    add_up(0)
    counts.move += moved * model.move
    counts.start += back[0].sum(axis=1, dtype=np.float64)
    return float(logs + log_mean.take(symbols, mode="clip").sum())


def _groups(batches, column: str, at_once: int = TOKENS_AT_ONCE):
    """(rows, sequences) of about ``at_once`` symbols; a batch's rows by length, so that sequences side by side end
    together."""
    for batch in batches:
        sizes = pc.divide(pc.binary_length(batch.column(column)), 2).to_numpy(zero_copy_only=False)
        order = np.argsort(-sizes, kind="stable")
        batch, sizes = batch.take(pa.array(order)), sizes[order].tolist()
        at = total = 0
        for i in range(len(sizes) + 1):
            if i == len(sizes) or total and total + sizes[i] > at_once:
                if i > at:
                    part = batch.slice(at, i - at)
                    yield part, [np.frombuffer(x, "<u2") for x in part.column(column).to_pylist()]
                at, total = i, 0
            if i < len(sizes):
                total += sizes[i]


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all rows of (text): tasks add up their own words first."""
    def run(batches):
        found: list[pa.Table] = []

        def added() -> pa.Table:
            return pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

        for batch in batches:
            for part in base.slices(batch, SLICE_BYTES):
                words = _split(part.column("text"))[0].value_counts()
                found.append(pa.table({"word": words.field("values"), "n": words.field("counts")}))
                if sum(map(len, found)) > 1_000_000:
                    found = [added()]
                    if len(found[0]) > 500_000:
                        yield {c: found[0].column(c).combine_chunks() for c in ("word", "n")}
                        found = []
        if found:
            last = added()
            yield {c: last.column(c).combine_chunks() for c in ("word", "n")}

    return base.arrow_map(training, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, at_most: int) -> list:
    """Rows (word, n) of the most frequent words, most frequent first, ``at_most`` in all; words of one frequency
    class (equal counts, or counts within a 16th of a power of two from 4096 on) are all in or all out.  The class
    sizes decide, a table of a few thousand rows at most, so no task sends more words than are wanted."""
    size = F.col("n").cast("double")
    ranked = counts.withColumn("class", F.when(size < 4096, size).otherwise(4096 + F.floor(F.log2(size / 4096) * 16)).cast("int"))
    least, total = None, 0
    for row in sorted(ranked.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        total += row["count"]
        if total > at_most:
            break
        least = row["class"]
    if least is None:
        return []
    return sorted(ranked.filter(F.col("class") >= least).select("word", "n").collect(), key=lambda r: (-r["n"], r["word"]))


def _encode(known, n_state_words: int):
    """Arrow function: (doc_id, held_out, text) -> symbols, sums over words of known count, and the words of the class
    in order: index of a known word, or the number of known words and the place in ``rare``, the text's other words."""
    def run(batches):
        words, n = known.value
        known_words = pa.array(words, pa.string())
        logs = np.log10(np.array([*n, 0.0]) + 0.5)
        logs[-1] = 0.0  # not here: comes with the join
        for batch in batches:
            for part in base.slices(batch, SLICE_BYTES):
                flat, ends = _split(part.column("text"))
                flat = flat.dictionary_encode()
                word = flat.indices.to_numpy()
                place = pc.index_in(flat.dictionary, value_set=known_words.cast(flat.dictionary.type)).fill_null(-1).to_numpy()
                at = place.astype(np.int64)[word]
                row = np.repeat(np.arange(len(part)), np.diff(ends))
                other = (at < 0) | (at >= n_state_words)
                unknown = np.flatnonzero(at < 0)

                def added(which, rows):
                    return np.bincount(rows, weights=logs[which], minlength=len(part))

                def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
                    offsets = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
                    return pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])

                log_known, log_other = added(at, row), added(at[other], row[other])
                # each row's unknown words once
                rare, own = np.unique(row[unknown] * len(flat.dictionary) + word[unknown], return_inverse=True)
                rare_row, rare_word = np.divmod(rare, len(flat.dictionary))
                first = np.searchsorted(rare_row, np.arange(len(part) + 1))
                at[unknown] = len(words) + own - first[row[unknown]]
                yield {"rid": part.column("rid"), "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                       "symbols": lists(np.where(other, n_state_words, at).astype("<u2"), np.diff(ends)),
                       "others": lists(at[other].astype("<u4"), np.bincount(row[other], minlength=len(part))),
                       "rare": pa.ListArray.from_arrays(pa.array(first, pa.int32()), flat.dictionary.take(pa.array(rare_word))),
                       "log_known": log_known, "log_other": log_other, "n_tokens": np.diff(ends).astype(np.int64),
                       "n_known": np.diff(ends) - np.bincount(row[unknown], minlength=len(part))}

    return run


def _told_apart(part, sequences: list[np.ndarray], symbol: int, known: int, n_rare: np.ndarray):
    """Sequences in which each word of the class has a symbol of its own, from ``symbol`` on; what these are (index of
    a known word, or ``known`` and a place in the rare words of all rows); and each row's words of the class, so."""
    words = part.column("others").to_pylist()
    ends = np.cumsum([0] + [len(w) // 4 for w in words])
    own = np.frombuffer(b"".join(words), "<u4").astype(np.int64)
    own += np.where(own >= known, np.repeat(np.cumsum(n_rare) - n_rare, np.diff(ends)), 0)
    used = np.zeros(known + int(n_rare.sum()), bool)
    used[own] = True
    flat = np.concatenate(sequences).astype(np.int32)
    flat[flat == symbol] = symbol - 1 + np.cumsum(used)[own]
    out = [flat[a:b] for a, b in pairwise(np.cumsum([0] + [len(s) for s in sequences]).tolist())]
    return out, np.flatnonzero(used), [own[a:b] for a, b in pairwise(ends.tolist())]


def _with_others(model: Model, affinity: np.ndarray) -> Model:
    """The model whose last symbol is replaced by words of the class, given (words x K) factors of its emission."""
    return Model(model.start, model.move, np.concatenate([model.emit[:, :-1], model.emit[:, -1:] * affinity.T], axis=1))


def _expected(model, symbols: int):
    """Arrow function: sequences -> rows of expected counts; symbol -1 is the start, -2 - i the moves from state i,
    and the one below has the log likelihood in its first column."""
    def run(batches):
        now = model.value
        states = len(now.start)
        counts, any_rows, logs, room = Counts(states, symbols), False, np.zeros(states), Room()
        for _, sequences in _groups(batches, "symbols"):
            logs[0] += expect(now, sequences, counts, np.float32, room)
            any_rows = True
        if any_rows:
            used = np.flatnonzero(counts.emit.any(axis=0))
            table = np.concatenate([counts.emit[:, used].T, counts.start[None, :], counts.move, logs[None, :]])
            yield {"symbol": np.concatenate([used, [-1], -2 - np.arange(states + 1)]),
                   **{f"s{k}": table[:, k] for k in range(states)}}

    return run


def train(spark: SparkSession, sequences: DataFrame, plain: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """sequences: (symbols binary) of all training texts, each in every round; ``rounds`` at most.  Per round the
    driver gets one row a symbol, and a task sends one: there are two tasks a core, however large the table, and what
    they send is single precision (its sums are double)."""
    model = Model.initial(states, plain)
    n = sequences.agg(F.sum(F.length("symbols") / 2)).first()[0]  # tokens
    schema = "symbol int, " + ", ".join(f"s{k} float" for k in range(states))
    sequences = sequences.coalesce(2 * spark.sparkContext.defaultParallelism)
    before = -math.inf
    for done in range(rounds if n else 0):
        sent = spark.sparkContext.broadcast(model)
        found = (base.arrow_map(sequences, _expected(sent, len(plain)), schema).groupBy("symbol")
                 .agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)])).toPandas()
        sent.unpersist()
        symbol, table = found["symbol"].to_numpy(), found.drop(columns="symbol").to_numpy()
        counts = Counts(states, len(plain))
        counts.emit[:, symbol[symbol >= 0]] = table[symbol >= 0].T
        counts.start = table[symbol == -1].sum(axis=0)
        moves = (symbol < -1) & (symbol >= -1 - states)
        counts.move[-2 - symbol[moves]] = table[moves]
        logs = table[symbol == -2 - states][0, 0]
        model = model.estimated(counts, plain)
        if done >= LEAST_ROUNDS and logs - before < LEAST_GAIN * n:
            break
        before = logs
    return model


def _expected_words(model, known: int):
    """Arrow function: sequences -> rows of expected counts with every word told apart: (symbol) of a known word, -1 of
    the start, -2 - i of the moves from state i, ``known`` of the whole class; (word) of any other word."""
    def run(batches):
        now = model.value
        states, symbol = len(now.start), now.emit.shape[1] - 1
        total, dense, n_dense, room = Counts(states, 0), np.zeros((known + 1, states)), np.zeros(known + 1, np.int64), Room()

        def rows(symbols, words, n, table):
            return {"symbol": symbols, "word": words, "n": n, **{f"s{k}": table[:, k] for k in range(states)}}

        for part, sequences in _groups(batches, "symbols", TOKENS_AT_ONCE // 2):  # in double precision, so half as many
            rare = part.column("rare")
            told, which, _ = _told_apart(part, sequences, symbol, known, pc.list_value_length(rare).to_numpy())
            counts = Counts(states, symbol + len(which))
            expect(now, told, counts, room=room)
            n = np.bincount(np.concatenate(told), minlength=symbol + len(which))
            emit, own = counts.emit.T, which < known
            total.start += counts.start
            total.move += counts.move
            dense[:symbol] += emit[:symbol]
            n_dense[:symbol] += n[:symbol]
            dense[which[own]] += emit[symbol:][own]
            n_dense[which[own]] += n[symbol:][own]
            dense[known] += emit[symbol:].sum(axis=0)
            yield rows(pa.nulls(int((~own).sum()), pa.int32()), rare.flatten().take(pa.array(which[~own] - known)), n[symbol:][~own], emit[symbol:][~own])
        if n_dense.any():
            used = np.append(np.flatnonzero(n_dense[:known]), known)
            yield rows(np.concatenate([used, -1 - np.arange(states + 1)]), pa.nulls(len(used) + 1 + states, pa.string()),
                       np.concatenate([n_dense[used], np.zeros(states + 1, np.int64)]), np.concatenate([dense[used], total.start[None, :], total.move]))

    return run


def learn_words(spark: SparkSession, sequences: DataFrame, model: Model, plain: np.ndarray, known: int):
    """One more round in which every training word has expected counts of its own: (the model after it, (known x K)
    factors of known words, (word, n, factor) of all others).

    A word's factor is what its states make of the class's emission: (1 - OWN) + OWN * (its count in the state
    + half a token by the class's states) / (the same for a word of the class with as many tokens).  Words not seen
    have factor 1, and the probabilities of all words still add up to 1.  The driver has a row a known word.
    """
    states = len(model.start)
    each = [f"s{k}" for k in range(states)]
    sent = spark.sparkContext.broadcast(model)
    found = base.written(spark, base.arrow_map(
        sequences, _expected_words(sent, known), "symbol int, word string, n bigint, " + ", ".join(f"{s} float" for s in each))
        .groupBy("symbol", "word").agg(F.sum("n").alias("n"), *[F.sum(s).cast("float").alias(s) for s in each]), "word-states")
    table = found.filter("symbol is not null").toArrow()
    symbol = table.column("symbol").to_numpy()
    values = np.stack([table.column(s).to_numpy() for s in each], axis=1).astype(np.float64)
    dense, n = np.zeros((known + 1, states)), np.zeros(known + 1)
    dense[symbol[symbol >= 0]], n[symbol[symbol >= 0]] = values[symbol >= 0], table.column("n").to_numpy()[symbol >= 0]
    counts = Counts(states, len(plain))
    last = len(plain) - 1
    counts.emit[:, :last], counts.emit[:, last] = dense[:last].T, dense[known]
    counts.start = values[symbol == -1].sum(axis=0)
    moves = symbol < -1
    counts.move[-2 - symbol[moves]] = values[moves]
    prior = np.maximum(dense[known], 1e-9)
    prior /= prior.sum()
    factors = (1 - OWN) + OWN * (dense[:known] + 0.5 * prior) / (prior * (n[:known, None] + 0.5))
    factor = F.array(*[(F.lit(1 - OWN) + F.lit(OWN) * (F.col(s) + 0.5 * float(p)) / (F.lit(float(p)) * (F.col("n") + 0.5))).cast("float")
                       for s, p in zip(each, prior)])
    others = found.filter("word is not null").select("word", "n", factor.alias("factor"))
    return model.estimated(counts, plain), factors.astype(np.float32), others


def _scored(sent, known: int):
    """Arrow function: encoded rows with (place, n, factor) of their rare words that have been learned -> log
    likelihoods."""
    def run(batches):
        model, factors = sent.value
        states, symbol = len(model.start), model.emit.shape[1] - 1
        kept = ("doc_id", "held_out", "n_tokens", "n_known", "log_known", "log_other")
        for part, sequences in _groups(batches, "symbols"):
            n_rare = part.column("n_rare").to_numpy()
            learned = part.column("learned")
            flat = pc.list_flatten(learned)
            start = np.concatenate([[0], np.cumsum(n_rare)])
            at = start[pc.list_parent_indices(learned).to_numpy()] + pc.struct_field(flat, "place").to_numpy()
            n, own = np.zeros(start[-1]), np.ones((start[-1], states), np.float32)
            n[at] = pc.struct_field(flat, "n").to_numpy()
            own[at] = pc.list_flatten(pc.struct_field(flat, "factor")).to_numpy().reshape(-1, states)
            told, which, words = _told_apart(part, sequences, symbol, known, n_rare)
            affinity = np.empty((len(which), states))
            affinity[which < known] = factors[which[which < known]]
            affinity[which >= known] = own[which[which >= known] - known]
            rare = [n[w[w >= known] - known] for w in words]
            yield {**{c: part.column(c) for c in kept}, "n_other": [len(w) for w in words],
                   "n_learned": [int((r > 0).sum()) for r in rare], "log_rare": [float(np.log10(r + 0.5).sum()) for r in rare],
                   "log_states": forward(_with_others(model, affinity), told)}

    return run


def scores(spark: SparkSession, docs: DataFrame, states: int = STATES, state_words: int = STATE_WORDS,
           known_words: int = KNOWN_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Rows whose CRC-32 of the id as text leaves remainder 1 by 5 are held out, all others teach (a null id counts as
    the empty text).  A null text counts as empty: its one token is the end.  Without training rows no token is
    known and every probability is that of the smoothing alone.  Repeated rows are rows of their own; an empty
    table gives no rows.
    """
    rows = base.texts(docs).select("doc_id", held_out(mod=5).alias("held_out"), "text")
    counts = base.written(spark, word_counts(rows.filter(~F.col("held_out")).select("text")), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = most_frequent(counts, known_words)
    n_top = np.array([r["n"] for r in top], np.float64)
    known = spark.sparkContext.broadcast(([r["word"] for r in top], n_top.tolist()))
    state_words = min(state_words, len(top), 65_535)
    others = total["n"] - n_top[:state_words].sum(), total["v"] - state_words
    plain = np.append(n_top[:state_words] + 0.5, others[0] + 0.5 * (others[1] + 1)) / (total["n"] + 0.5 * (total["v"] + 1))
    encoded = base.written(spark, base.arrow_map(
        rows.withColumn("rid", F.monotonically_increasing_id()), _encode(known, state_words),
        "rid bigint, doc_id bigint, held_out boolean, symbols binary, others binary, rare array<string>, "
        "log_known double, log_other double, n_tokens bigint, n_known bigint"), "encoded")
    training = encoded.filter(~F.col("held_out"))
    model = train(spark, training.select("symbols"), plain, states, rounds)
    model, factors, words = learn_words(spark, training.select("symbols", "others", "rare"), model, plain, len(top))
    learned = (encoded.select("rid", F.posexplode("rare").alias("place", "word")).join(words, "word").groupBy("rid")
               .agg(F.collect_list(F.struct("place", "n", "factor")).alias("learned")))
    sent = spark.sparkContext.broadcast((model, factors))
    scored = base.arrow_map(
        encoded.withColumn("n_rare", F.size("rare")).drop("rare").join(learned, "rid", "left"), _scored(sent, len(top)),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_known double, log_other double, "
        "n_other bigint, n_learned bigint, log_rare double, log_states double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("n_learned")).alias("n_known"),
        F.lit(int(total["n"])).cast("bigint").alias("train_tokens"),
        (F.col("log_known") + F.col("log_rare") - F.col("n_tokens") * math.log10(total["n"] + 0.5 * (total["v"] + 1))).alias("base_score"),
        (F.col("log_states") / math.log(10) + F.col("log_other") + F.col("log_rare")
         - F.col("n_other") * math.log10(others[0] + 0.5 * (others[1] + 1))).alias("score"))


@base.register("op8_hmm_scores")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, base.table(spark, sf_dir, "documents"))
