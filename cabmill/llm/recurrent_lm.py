"""Gated recurrent language model with a class-factored softmax, for whole documents.

Every word is one of the outcomes of the network: frequent words are one each, the rest of a table
of known words one per word ending, all words beyond the table one of their own. The outcomes are
dealt to classes, the most frequent first. A GRU in numpy, fitted by back-propagation cut at
windows, reads the outcomes before; from its state one softmax gives the next class and another the
outcome within that class. The state is carried from window to window to the end of a document. It
is fitted in rounds on every training document: each task learns from its own documents of the
round, and the tasks' parameters meet as a mean by tokens. Words that share an outcome have their
shares of its tokens in the training corpus; beyond the table absolute discounting leaves a share
to the one event of a word never seen.

Counts cover the whole corpus. Words travel as 64-bit hashes: tasks count theirs, sums meet by
hash. The table of frequent words has a fixed size and is sent to all tasks; counts of the other
words are joined to the documents' rare words, and nothing but sums returns to a document.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import Work, chosen, collected, crc_remainder, read
from cabmill.llm.shingles import word_hashes

#: Words of the table: those with the highest counts, at least LEAST. 16 MB at most.
TABLE, LEAST = 1_000_000, 3
#: Words that are an outcome of their own, and outcomes for word endings.
OWN, ENDINGS = 128, 48
#: Size of the state and of an outcome's vector; steps of a window.
HIDDEN, EMBED, WINDOW = 32, 24, 16
#: Steps of a window while scoring, and most lanes of documents read side by side.
SCORE_WINDOW, LANES = 64, 512
#: Rounds of one pass over the training documents, and a round's tokens per task (at least, where
#: the corpus has them).
ROUNDS, TASK_TOKENS = 8, 200_000
#: Tokens of whole documents that a task lays out in lanes at a time, and its lanes.
BATCH_TOKENS, FIT_LANES, RATE = 2_000_000, 128, 0.015
_CHUNK = 4_000_000  # words counted at a time in a task
_TOGETHER = 250_000  # tokens looked up at a time
END = np.int64(-1)  # in place of a word's hash: the end of a document


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, endings, size = [], [], 0

    def counted():
        words, first, n = np.unique(np.concatenate(held), return_index=True, return_counts=True)
        ending = np.concatenate(endings)[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(ending.astype(np.int32)), pa.array(n.astype(np.int64))], ["w", "e", "n"]
        )

    for batch in batches:
        for hashes, ending in word_hashes(_texts(batch.column(0))):
            held += [hashes, [END]]
            endings += [ending, [0]]
            size += len(hashes) + 1
            if size >= _CHUNK:
                yield counted()
                held, endings, size = [], [], 0
    if held:
        yield counted()


@dataclass
class Vocabulary:
    """The table of known words, and what is known of the words beyond it."""

    hashes: np.ndarray  # ascending
    counts: np.ndarray
    endings: np.ndarray
    tokens: int  # N
    words: int  # V
    rare_tokens: int
    rare_words: int
    discount: float
    own: np.ndarray = field(init=False)  # places in the table, most frequent first
    slots: np.ndarray = field(init=False)  # place of the most frequent word with these last bits

    def __post_init__(self):
        order = np.lexsort((self.hashes, -self.counts))
        self.own = order[:OWN]
        self._own_class = np.full(len(self.hashes), -1, np.int32)
        self._own_class[self.own] = np.arange(len(self.own))
        self.slots = np.zeros(1 << (2 * len(self.hashes)).bit_length(), np.int32)
        # From the rarest on, so that the most frequent word is the last to take its slot.
        self.slots[self.hashes[order[::-1]] & (len(self.slots) - 1)] = order[::-1]

    def totals(self) -> np.ndarray:
        """Training tokens of each class."""
        cls, _ = self.look_up(self.hashes, self.endings)
        return np.append(np.bincount(cls, self.counts, self.classes - 1)[: self.classes - 1], self.rare_tokens)

    @property
    def classes(self) -> int:
        return OWN + ENDINGS + 1

    def look_up(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and count of every word; the count of one beyond the table is -1."""
        if not len(self.hashes):
            return np.full(len(hashes), OWN + ENDINGS), np.full(len(hashes), -1)
        at = self.slots[hashes & (len(self.slots) - 1)]
        known = self.hashes[at] == hashes
        others = np.flatnonzero(~known)
        at[others] = np.minimum(np.searchsorted(self.hashes, hashes[others]), len(self.hashes) - 1)
        known[others] = self.hashes[at[others]] == hashes[others]
        own = self._own_class[at]
        cls = np.where(own >= 0, own, OWN + endings % ENDINGS)
        return np.where(known, cls, OWN + ENDINGS), np.where(known, self.counts[at], -1)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + 1)))


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(-1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(-1, keepdims=True))


def _softmax_at(logits: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of one row of each column, and the probabilities of all, in place."""
    logits -= logits.max(0)
    chosen_logits = logits[at]
    np.exp(logits, out=logits)
    total = logits.sum(0)
    logits /= total
    return chosen_logits - np.log(total), logits


def _by_gate(weights: np.ndarray) -> np.ndarray:
    """A matrix each for the sums of the reset gate, the update gate and the candidate; those of the
    gates are halved, as the logistic function is (1 + tanh(x / 2)) / 2."""
    parts = weights.reshape(len(weights), 3, HIDDEN).swapaxes(0, 1).copy()
    parts[:2] *= 0.5
    return parts


def _advanced(given: np.ndarray, h: np.ndarray, wh: np.ndarray, sums: np.ndarray, n: np.ndarray, new: np.ndarray):
    """One step of lanes that are rows, ``given`` and ``wh`` by gate. ``new`` takes the states after
    it, ``sums`` the gates and what the candidate ``n`` takes from the state."""
    np.matmul(h, wh, out=sums)
    gates = sums[:2]
    gates += given[:2]
    np.tanh(gates, out=gates)
    gates *= 0.5
    gates += 0.5
    np.multiply(sums[0], sums[2], out=n)
    n += given[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=new)
    new *= sums[1]
    new += n


def _by_value(numbers: np.ndarray, below: int) -> np.ndarray:
    """A stable order of small whole numbers."""
    return np.argsort(numbers.astype(np.min_scalar_type(below)), kind="stable")


def _rows(x: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.take(x, places, axis=-2, mode="clip")  # all lie inside; the check costs more than the copy


def members(outcomes: int) -> int:
    """Outcomes of a class: as many as there are classes, about."""
    return math.ceil(math.sqrt(outcomes))


@dataclass
class Gru:
    """Gated recurrent unit over outcomes. Parameters: outcome vectors, input and state weights
    (for reset, update, candidate), weights of the classes and, by class, of its outcomes; biases
    are the last rows."""

    embed: np.ndarray
    wx: np.ndarray
    wh: np.ndarray
    wc: np.ndarray
    wm: np.ndarray

    @staticmethod
    def new(outcomes: int, frequencies: np.ndarray, seed: int = 11) -> Gru:
        rng, size = np.random.default_rng(seed), members(outcomes)
        classes = -(-outcomes // size)
        dealt = np.zeros(classes * size)
        dealt[:outcomes] = frequencies
        dealt = dealt.reshape(classes, size)
        wc = rng.normal(0, 0.1, (HIDDEN + 1, classes))
        wc[-1] = np.log(dealt.sum(1))
        wm = rng.normal(0, 0.1, (classes, HIDDEN + 1, size))
        wm[:, -1] = np.log(np.where(dealt > 0, dealt, 1) / dealt.sum(1, keepdims=True))
        return Gru(
            rng.normal(0, 0.3, (outcomes + 1, EMBED)), rng.normal(0, 0.2, (EMBED + 1, 3 * HIDDEN)),
            rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)), wc, wm,
        )

    @property
    def parameters(self) -> tuple[np.ndarray, ...]:
        return self.embed, self.wx, self.wh, self.wc, self.wm

    def inputs(self) -> np.ndarray:
        """What each outcome, as the token before, adds to the gates; the last row is the start."""
        return self.embed @ self.wx[:-1] + self.wx[-1]

    def step(self, given: np.ndarray, h: np.ndarray):
        """One step of lanes that are rows."""
        sums, n, new = np.empty((3, *h.shape), h.dtype), np.empty_like(h), np.empty_like(h)
        _advanced(_by_gate(given), h, _by_gate(self.wh), sums, n, new)
        return new, (sums, n)

    def run(self, before: np.ndarray, h: np.ndarray, alive: np.ndarray | None = None, keep: bool = False):
        """States (steps x lanes x size) of a window; with ``keep`` also the sums and candidates of
        every step, for the gradients. ``alive`` is 0 where a lane's state begins anew."""
        steps, lanes = before.shape
        given, wh = _rows(_by_gate(self.inputs()), before), _by_gate(self.wh)
        states, kept = np.empty((steps, lanes, HIDDEN), h.dtype), steps if keep else 1
        sums, n = np.empty((3, kept, lanes, HIDDEN), h.dtype), np.empty((kept, lanes, HIDDEN), h.dtype)
        for t in range(steps):
            at = t if keep else 0
            h = h if alive is None else h * alive[t, :, None]
            _advanced(given[:, t], h, wh, sums[:, at], n[at], states[t])
            h = states[t]
        return states, sums, n

    def _class_members(self, k: int) -> np.ndarray:
        """Weights of the outcomes of a class; the last class may have fewer."""
        size = self.wm.shape[2]
        return self.wm[k][:, : min(size, len(self.embed) - 1 - k * size)]

    def log_outcomes(self, states: np.ndarray) -> np.ndarray:
        """Log-probabilities of all outcomes: that of the class plus that within the class."""
        of_class = _log_softmax(states @ self.wc[:-1] + self.wc[-1])
        parts = []
        for k in range(self.wc.shape[1]):
            w = self._class_members(k)
            parts.append(of_class[..., k, None] + _log_softmax(states @ w[:-1] + w[-1]))
        return np.concatenate(parts, -1)

    def output(self, states: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None):
        """Log-probability of each state's target: only the members of the target's class are
        looked at. With weights, also the gradients of the weighted loss by states, wc and wm."""
        size = self.wm.shape[2]
        classes, place = np.divmod(target, size)
        rows = np.arange(len(target))
        logp, d = _softmax_at(self.wc[:-1].T @ states.T + self.wc[-1][:, None], (classes, rows))
        order = _by_value(classes, self.wc.shape[1])
        cuts = np.append(0, np.cumsum(np.bincount(classes, minlength=self.wc.shape[1])))
        sorted_x, sorted_place, within = _rows(states, order), place[order], np.empty_like(logp)
        if weight is not None:
            d[classes, rows] -= 1
            d *= weight
            g_wc = np.concatenate([states.T @ d.T, d.sum(1)[None]])
            d_x, g_wm = d.T @ self.wc[:-1].T, np.zeros_like(self.wm)
            sorted_weight, d_within = weight[order], np.empty_like(sorted_x)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            own, w = slice(cuts[k], cuts[k + 1]), self._class_members(k)
            at = sorted_place[own], rows[: cuts[k + 1] - cuts[k]]
            within[own], d = _softmax_at(w[:-1].T @ sorted_x[own].T + w[-1][:, None], at)
            if weight is not None:
                d[at] -= 1
                d *= sorted_weight[own]
                g_wm[k, :-1, : w.shape[1]], g_wm[k, -1, : w.shape[1]] = sorted_x[own].T @ d.T, d.sum(1)
                d_within[own] = d.T @ w[:-1].T
        logp[order] += within
        if weight is None:
            return logp
        back = np.empty_like(order)
        back[order] = rows
        d_x += _rows(d_within, back)
        return logp, d_x, g_wc, g_wm

    def window(self, before: np.ndarray, target: np.ndarray, h: np.ndarray, inside: np.ndarray | None = None):
        """Loss, gradients and last state of one window (steps x lanes); ``inside`` marks tokens."""
        steps, lanes = before.shape
        weight = np.full(target.shape, 1 / target.size, h.dtype) if inside is None else inside.astype(h.dtype) / inside.sum()
        states, (r, z, s), n = self.run(before, h, keep=True)
        weights = weight.ravel()
        logp, d_states, g_wc, g_wm = self.output(states.reshape(-1, HIDDEN), target.ravel(), weights)
        loss = -(logp * weights).sum()
        d_states = d_states.reshape(states.shape)
        old = np.concatenate([h[None], states[:-1]])
        # What a change of the new state does to the three sums of a step, but for its own factor.
        of_n = (1 - z) * (1 - n * n)
        of_z, of_r = (old - n) * z * (1 - z), s * r * (1 - r)
        d_sums, d_n = np.empty((steps, lanes, 3 * HIDDEN), h.dtype), np.empty_like(states)
        dh, wh = np.zeros((lanes, HIDDEN), h.dtype), self.wh.T.copy()
        for t in range(steps - 1, -1, -1):
            dh += d_states[t]
            d, dn = d_sums[t], np.multiply(dh, of_n[t], out=d_n[t])
            np.multiply(dn, of_r[t], out=d[:, :HIDDEN])
            np.multiply(dh, of_z[t], out=d[:, HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[t], out=d[:, 2 * HIDDEN :])
            dh *= z[t]
            dh += d @ wh
        flat = d_sums.reshape(-1, 3 * HIDDEN)
        g_wh = old.reshape(-1, HIDDEN).T @ flat
        d_sums[..., 2 * HIDDEN :] = d_n  # the reset gate touches only what comes from the state
        per_class = np.zeros((len(self.embed), 3 * HIDDEN), h.dtype)
        times = np.bincount(before.ravel(), minlength=len(self.embed))
        seen = np.flatnonzero(times)
        by_outcome = _rows(flat, _by_value(before.ravel(), len(self.embed)))
        per_class[seen] = np.add.reduceat(by_outcome, (np.cumsum(times) - times)[seen], axis=0)
        g_wx = np.concatenate([self.embed.T @ per_class, per_class.sum(0)[None]])
        return loss, (per_class @ self.wx[:-1].T, g_wx, g_wh, g_wc, g_wm), states[-1]


class Fitting:
    """Adam over the windows of some documents, from given parameters."""

    def __init__(self, flat: np.ndarray, classes: int, rate: float):
        self.flat = flat.astype(np.float32)
        self.model, self.classes, self.rate = unpacked(self.flat, classes), classes, rate
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.steps, self.tokens = 0, 0
        self._rng = np.random.default_rng(12)

    def learn(self, documents: list[np.ndarray]) -> None:
        """From every token: documents follow each other in every lane, and the state goes on from
        one window to the next (a start mark is what precedes a document)."""
        documents = [documents[i] for i in self._rng.permutation(len(documents))]
        target = np.concatenate(documents).astype(np.intp)
        before = np.concatenate([[self.classes], target[:-1]])
        before[np.cumsum([len(d) for d in documents])[:-1]] = self.classes
        size = len(target)
        lanes = FIT_LANES if size >= FIT_LANES else 1
        length = -(-size // lanes)
        # Only the last lanes are filled up, with tokens that weigh nothing.
        lay = lambda a, fill: np.append(a, np.full(lanes * length - size, fill, a.dtype)).reshape(lanes, length).T
        target, before, inside = lay(target, 0), lay(before, self.classes), lay(np.ones(size, bool), False)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for at in range(0, length, WINDOW):
            cut = slice(at, at + WINDOW)
            _, grads, h = self.model.window(before[cut], target[cut], h, inside[cut])
            grad = np.concatenate([(g * min(1.0, 1.0 / (np.sqrt((g**2).sum()) + 1e-9))).ravel() for g in grads])
            self.steps += 1
            self.m += 0.1 * (grad - self.m)
            self.v += 0.001 * (grad**2 - self.v)
            self.flat -= self.rate * (self.m / (1 - 0.9**self.steps)) / (np.sqrt(self.v / (1 - 0.999**self.steps)) + 1e-8)
        self.tokens += size


def packed(model: Gru) -> np.ndarray:
    return np.concatenate([p.ravel() for p in model.parameters])


def unpacked(flat: np.ndarray, outcomes: int) -> Gru:
    """The network whose parameters are views of ``flat``."""
    size = members(outcomes)
    classes = -(-outcomes // size)
    shapes = [
        (outcomes + 1, EMBED), (EMBED + 1, 3 * HIDDEN), (HIDDEN, 3 * HIDDEN), (HIDDEN + 1, classes),
        (classes, HIDDEN + 1, size),
    ]
    ends = np.cumsum([math.prod(shape) for shape in shapes])
    return Gru(*(p.reshape(shape) for p, shape in zip(np.split(flat, ends[:-1]), shapes, strict=True)))


def _learned(flat, classes: int, rate: float):
    """A task's parameters after its documents, times its tokens; place -1 has the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitting, held, size = Fitting(flat.value, classes, rate), [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(np.frombuffer(text.as_buffer(), np.uint8))
                size += len(held[-1])
                if size >= BATCH_TOKENS:
                    fitting.learn(held)
                    held, size = [], 0
        if held:
            fitting.learn(held)
        if fitting.tokens:
            out = np.append(fitting.flat.astype(np.float64), 1.0) * fitting.tokens
            place = np.append(np.arange(len(fitting.flat)), -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(out)], ["place", "x"])

    return run


def fit_gru(sequences: DataFrame, tokens: int, totals: np.ndarray) -> Gru:
    """Learns from the classes (a byte each) of all training documents, uid and classes.

    A round covers the documents whose uid falls to it; its tasks start from the mean of the
    round before, by tokens. Nothing but parameters, of a fixed size, leaves a task.
    """
    classes, context = len(totals), sequences.sparkSession.sparkContext
    flat = packed(Gru.new(classes, (totals + 0.5) / (totals + 0.5).sum()))
    tasks = max(1, tokens // (ROUNDS * TASK_TOKENS))
    for i in range(ROUNDS):
        some = sequences.where(F.pmod(F.xxhash64("uid"), F.lit(ROUNDS)) == i)
        given = context.broadcast(flat)
        learned = some.select("classes").coalesce(tasks).mapInArrow(
            _learned(given, classes, RATE * (1 - 0.9 * i / ROUNDS)), "place int, x double"
        )
        sums = np.zeros(len(flat) + 1)
        for place, x in learned.groupBy("place").agg(F.sum("x")).collect():
            sums[place] = x  # -1 is the last
        if sums[-1]:
            flat = sums[:-1] / sums[-1]
        given.destroy()
    return unpacked(flat, classes)


def class_scores(model: Gru, documents: list[np.ndarray]) -> np.ndarray:
    """Natural-log likelihood of each document's classes, its state carried to its end.

    Documents follow each other in lanes of about equal length, the longest first; the state
    begins anew with each.
    """
    out, classes = np.zeros(len(documents)), len(model.embed) - 1
    sizes = np.array([len(d) for d in documents], np.int64)
    if not sizes.any():
        return out
    lanes = int(np.clip(sizes.sum() // sizes.max(), 1, LANES))
    free, place = [(0, lane) for lane in range(lanes)], []
    for i in np.argsort(-sizes, kind="stable").tolist():
        at, lane = free[0]
        heapq.heapreplace(free, (at + int(sizes[i]), lane))
        place.append((i, lane, at, at + int(sizes[i])))
    length = max(end for end, _ in free)
    target, before = np.zeros((lanes, length), np.uint8), np.full((lanes, length), classes, np.uint8)
    for i, lane, at, end in place:
        target[lane, at:end] = documents[i]
        before[lane, at + 1 : end] = documents[i][:-1]
    target, before, logp = target.T, before.T, np.empty((lanes, length), np.float32)
    small = Gru(*(p.astype(np.float32) for p in model.parameters))
    h = np.zeros((lanes, HIDDEN), np.float32)
    for at in range(0, length, SCORE_WINDOW):
        cut = slice(at, at + SCORE_WINDOW)
        states, _, _ = small.run(before[cut], h, (before[cut] != classes).astype(np.float32))
        h = states[-1]
        of_target = small.output(states.reshape(-1, HIDDEN), target[cut].ravel())
        logp[:, cut] = of_target.reshape(-1, lanes).T
    for i, lane, at, end in place:
        out[i] = logp[lane, at:end].sum(dtype=np.float64)
    return out


def _encoded(vocabulary, totals):
    """Per document its classes, a byte each, its sums over the words of the table, and its rare
    words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of_class = vocabulary.value, totals.value
        log_total = np.log10(np.maximum(of_class, 1))
        uid = TaskContext.get().partitionId() << 40

        def rows(ids: pa.RecordBatch, words: list[np.ndarray], endings: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(w) for w in words[::2]], np.int64) + 1  # the end too
            starts = np.cumsum(sizes) - sizes
            words = np.concatenate(words)
            cls, count = known.look_up(words, np.concatenate(endings))
            table = count > 0
            total = lambda of: np.add.reduceat(np.where(table, of, 0), starts)
            # Rare words: once per document, by document and hash.
            doc, rare = np.repeat(np.arange(len(sizes)), sizes)[~table], words[~table]
            order = np.lexsort((rare, doc))
            doc, rare = doc[order], rare[order]
            first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1]))[: len(doc)])
            times = np.diff(np.append(first, len(doc)))
            cuts = pa.array(np.searchsorted(doc[first], np.arange(len(sizes) + 1)).astype(np.int32))
            classes = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(sizes),
                [None, pa.py_buffer(np.append(0, np.cumsum(sizes))), pa.py_buffer(cls.astype(np.uint8))],
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(uid + np.arange(len(sizes))), ids.column(0), ids.column(1), pa.array(sizes),
                 pa.array(total(1)), pa.array(total(known.base(np.maximum(count, 0)))),
                 pa.array(total(np.log10(np.maximum(count, 1)) - log_total[cls])),
                 pa.ListArray.from_arrays(cuts, pa.array(rare[first])),
                 pa.ListArray.from_arrays(cuts, pa.array(times)), classes.cast(pa.binary())],
                ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times", "classes"],
            )

        for batch in batches:
            at, words, endings, size = 0, [], [], 0
            for i, (hashes, ending) in enumerate(word_hashes(_texts(batch.column(2))), 1):
                words += [hashes, [END]]
                endings += [ending, [0]]
                size += len(hashes) + 1
                if size >= _TOGETHER or i == batch.num_rows:
                    yield rows(batch.slice(at, i - at), words, endings)
                    uid += i - at
                    at, words, endings, size = i, [], [], 0

    return run


def _likelihoods(model):
    def scored(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sequences = [np.frombuffer(c.as_buffer(), np.uint8) for batch in held for c in batch.column(1)]
        score = class_scores(model.value, sequences) / math.log(10)
        uid = pa.concat_arrays([batch.column(0) for batch in held])
        return pa.RecordBatch.from_arrays([uid, pa.array(score)], ["uid", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                held.append(batch.slice(at, LANES))
                size += sum(len(c.as_buffer()) for c in held[-1].column(1))
                if size >= BATCH_TOKENS:
                    yield scored(held)
                    held, size = [], 0
        if held:
            yield scored(held)

    return run


def _vocabulary(work: Work, counts: DataFrame) -> Vocabulary:
    power = F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("long")
    level = F.when(F.col("n") < 1000, F.col("n")).otherwise(power)
    # At most 1000 rows and one for each power of two.
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    rows = sorted(rows, key=lambda r: -r["level"])
    least, taken = None, 0
    for r in rows:
        if r["level"] < LEAST or taken + r["words"] > TABLE:
            break
        least, taken = r["level"], taken + r["words"]
    words, tokens = sum(r["words"] for r in rows), sum(r["tokens"] for r in rows)
    once = {r["level"]: r["words"] for r in rows}
    n1, n2 = once.get(1, 0), once.get(2, 0)
    if least is None:
        hashes = n = endings = np.empty(0, np.int64)
    else:
        top = collected(counts.where(F.col("n") >= least).select("w", "n", "e"))
        order = np.argsort(top[0])
        hashes, n, endings = (column[order] for column in top)
    return Vocabulary(
        hashes, n, endings, tokens, words, tokens - int(n.sum()), words - len(n), (n1 + 1) / (n1 + 2 * n2 + 2)
    )


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from documents whose crc32(doc_id as text) mod 5 is not 1. A null text is empty: one
    token, the end. Repeated rows count and are scored each; a null doc_id stays null and is not
    held out; without training documents both scores are 0; an empty table gives no rows; further
    columns are ignored.
    """
    spark = documents.sparkSession
    docs = chosen(documents, doc_id="long", text="string").select(
        "doc_id", (crc_remainder("doc_id", 5) == 1).alias("held_out"), F.col("text").cast("binary")
    )
    train = docs.where(~F.col("held_out"))
    with Work(spark, "lm") as work:
        counts = work.write(
            train.select("text").mapInArrow(_word_counts, "w long, e int, n long")
            .groupBy("w").agg(F.sum("n").alias("n"), F.max("e").alias("e")),
            keep=True,
        )
        vocabulary = _vocabulary(work, counts)
        known = spark.sparkContext.broadcast(vocabulary)
        totals = vocabulary.totals()
        scored = work.write(
            docs.mapInArrow(
                _encoded(known, spark.sparkContext.broadcast(totals)),
                "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
                "score double, rare array<long>, times array<long>, classes binary",
            ),
            keep=True,
        )
        likely = None
        if vocabulary.tokens:
            model = fit_gru(scored.where(~F.col("held_out")).select("uid", "classes"), vocabulary.tokens, totals)
            likely = work.write(
                scored.select("uid", "classes").mapInArrow(
                    _likelihoods(spark.sparkContext.broadcast(model)), "uid long, score double"
                ),
                keep=True,
            )
    # The words beyond the table: their counts come by a join, and leave as sums.
    v = vocabulary
    unseen = v.discount * v.rare_words / v.rare_tokens if v.rare_tokens else 1.0
    of_rare = F.coalesce("n", F.lit(0))
    base = F.log10((of_rare + 0.5) / (v.tokens + 0.5 * (v.words + 1)))
    within = F.when(F.col("n").isNull(), F.lit(math.log10(unseen))).otherwise(
        F.log10((F.col("n") - v.discount) / max(1, v.rare_tokens))
    )
    each = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "uid", F.col("x.rare").alias("w"), F.col("x.times").alias("times")
    )
    table_least = int(v.counts.min()) if len(v.counts) else None
    others = counts.where(F.col("n") < table_least) if table_least is not None else counts
    sums = each.join(others, "w", "left").select(
        "uid", (F.col("times") * base).alias("base"), (F.col("times") * within).alias("score"),
        F.when(F.col("n").isNull(), 0).otherwise(F.col("times")).alias("n_known"),
    )
    trained = F.lit(likely is not None)
    rows = scored.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score").unionByName(
        sums, allowMissingColumns=True
    )
    if likely is not None:
        rows = rows.unionByName(likely, allowMissingColumns=True)
    return (
        rows.groupBy("uid").agg(
            *(F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens")),
            *(F.sum(c).alias(c) for c in ("n_known", "base", "score")),
        )
        .select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(v.tokens).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"),
            F.when(trained, F.col("score")).otherwise(F.col("base")).alias("score"),
        )
    )


def op3_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
