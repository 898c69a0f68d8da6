"""Toxicity classifier: a bidirectional gated recurrent network with attention.

Words (runs of letters, digits and underscores of the lower-cased text) are the
time steps. A step's input has a word part, the embedding of the word if the
training sample holds it in ``MIN_DOCUMENTS`` documents or more, and a character
part, the squashed sum of embeddings of the word's character n-grams (3 to 5
characters, word edges marked, hashed), so that words never seen in training
have an input as well. A gated recurrent unit runs over the steps from either
side; attention weighs the joint states of a window's steps, and a linear layer
gives the window's log odds.

A text is read in windows of ``WINDOW`` words, ``STRIDE`` words apart, the last
one ending with the text; every word is in one window at least and all windows
are scored. The document's log odds are the windows' mean weighted by
exp(log odds), a smooth maximum that one toxic passage can lift and that the
number of harmless windows can't, scaled and shifted to read as a probability.

Training (numpy, on the driver) takes a bounded sample of labelled rows: of each
class the ``max_documents`` ids first in hash order, of each document at most
``MAX_WINDOWS`` windows spread over its text, so the driver holds no more than
2 * max_documents * MAX_WINDOWS * WINDOW words. Gradients go back through the
windows' smooth maximum, the attention, time, and both kinds of embeddings
(Adam; a step leaves a fifth of the words empty, so that no single one decides). Scale and shift are then fitted on the sample's documents scored over
all their windows, classes weighted as they occur.

Defined results: null text is empty text; a text without words is one empty
window and gets a score like any other; where the labels hold one class or none,
every score is the share of label 1 (0 without labels); an id that is given
several texts is represented in training by the one of least hash; ids with
contradicting labels and null ids aren't trained on; a null id is scored and is
not held out; rows are never dropped or merged; an empty table gives no rows.
Only the id and text columns are read, so other columns can't clash. Long texts
are read in pieces of ``PIECE_CHARS`` characters, so memory doesn't grow with
a text beyond the text itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import map_batches

MAX_DOCUMENTS = 1200
MAX_WINDOWS = 16
MIN_DOCUMENTS = 3
MAX_VOCABULARY = 20_000
WINDOW = 48
STRIDE = 32
HIDDEN = 12
WORD_DIM = 8
CHAR_DIM = 12
ATTENTION = 8
CHAR_ROWS = 1 << 16
#: Share of the words that a training step leaves empty.
DROPPED = 0.2
GRAMS = (3, 4, 5)
#: Distinct words whose inputs a worker keeps (bounds memory, not results).
CACHE_WORDS = 100_000
PIECE_CHARS = 1 << 20
#: Windows that go through the network together.
BATCH_WINDOWS = 1024
#: Text bytes scored together.
GROUP_BYTES = 4 << 20

_WORD = re.compile(r"\w+")
F32 = np.float32


# --- inputs -------------------------------------------------------------------


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, piece by piece (a piece ends between two words)."""
    at = 0
    while True:
        end = min(at + PIECE_CHARS, len(text))
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        yield _WORD.findall(text[at:end].lower())
        if end >= len(text):
            return
        at = end


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of n words: every STRIDE words, as long as words
    are left that no earlier window holds; one window where n is small."""
    return STRIDE * np.arange(1 + max(0, -(-(n - WINDOW) // STRIDE)))


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row of the character table, word) of all n-grams of the words."""
    text = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(codes))  # characters to the word's end
    h = np.zeros(len(codes), np.uint64)
    rows: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    for n in range(1, max(GRAMS) + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            inside = left[:m] >= n
            x = h[inside]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            rows.append((x >> np.uint64(64 - CHAR_ROWS.bit_length() + 1)).astype(np.int64))
            owners.append(word[:m][inside])
    return np.concatenate(rows), np.concatenate(owners)


# --- the network --------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + F32(0.5)


@dataclass
class Network:
    """Weights by name, the vocabulary, and the document score's scale and shift."""

    weights: dict[str, np.ndarray]
    vocabulary: dict[str, int]
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None  # the score where nothing could be learned

    @classmethod
    def fresh(cls, vocabulary: dict[str, int], seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        draw = lambda *shape, s: (s * rng.standard_normal(shape)).astype(F32)
        return cls(
            {
                "word": draw(len(vocabulary) + 1, WORD_DIM, s=0.1),
                "char": draw(CHAR_ROWS, CHAR_DIM, s=0.1),
                "in": draw(d, 6 * h, s=d**-0.5),
                "in_bias": np.zeros(6 * h, F32),
                "step": draw(2, h, 3 * h, s=h**-0.5),
                "focus": draw(2 * h, ATTENTION, s=(2 * h) ** -0.5),
                "focus_out": draw(ATTENTION, s=ATTENTION**-0.5),
                "out": draw(2 * h, s=(2 * h) ** -0.5),
                "out_bias": np.zeros(1, F32),
            },
            vocabulary,
        )

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """(words x inputs); what the backward pass needs."""
        place = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        chars = np.zeros((len(words), CHAR_DIM), F32)
        rows, owner = _grams(words) if words else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        rows, owner = rows[order], owner[order]
        for a in range(0, len(rows), 1 << 20):  # a word may be as long as a text
            part = owner[a : a + (1 << 20)]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            chars[part[first]] += np.add.reduceat(self.weights["char"][rows[a : a + (1 << 20)]], first)
        per = np.maximum(np.bincount(owner, minlength=len(words)), 1).astype(F32) ** F32(-0.5)
        chars = np.tanh(chars * per[:, None])
        word = self.weights["word"][place] * (place > 0)[:, None]
        return np.hstack((word, chars)), (place, rows, owner, per, chars)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """(2 directions, words, 3 gates of HIDDEN)."""
        p = x @ self.weights["in"] + self.weights["in_bias"]
        return np.ascontiguousarray(p.reshape(len(x), 2, 3 * HIDDEN).transpose(1, 0, 2))

    def run(self, p: np.ndarray, at: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Joint states (step, window, 2 * HIDDEN) of windows given as places in
        the projected words; place -1 (the last one) is the empty step."""
        n, steps, h = len(at), at.shape[1], HIDDEN
        u = self.weights["step"]
        states = np.empty((steps, n, 2 * h), F32)
        state = np.zeros((2, n, h), F32)
        for t in range(steps):
            g = np.stack((p[0].take(at[:, t], 0, mode="wrap"), p[1].take(at[:, steps - 1 - t], 0, mode="wrap")))
            m = np.matmul(state, u)
            gates = _sigmoid(g[..., : 2 * h] + m[..., : 2 * h])
            z, r = gates[..., :h], gates[..., h:]
            c = np.tanh(g[..., 2 * h :] + r * m[..., 2 * h :])
            if keep is not None:
                keep.append((state, z, r, c, m[..., 2 * h :]))
            state = state + z * (c - state)
            states[t, :, :h] = state[0]
            states[steps - 1 - t, :, h:] = state[1]
        return states

    def attend(self, states: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Log odds of each window; ``real`` (window, step) marks its words."""
        focus = np.tanh(states @ self.weights["focus"])
        e = np.where(real.T, focus @ self.weights["focus_out"], F32(-30))
        e = np.exp(e - e.max(0))
        share = e / e.sum(0)
        pooled = (share[..., None] * states).sum(0)
        return pooled @ self.weights["out"] + self.weights["out_bias"][0], (focus, share, pooled)


def smooth_maximum(odds: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each document's window log odds weighted by their exponentials,
    and the weights; ``first`` are the documents' first windows."""
    n = np.diff(np.concatenate((first, [len(odds)])))
    top = np.repeat(np.maximum.reduceat(odds, first), n)
    e = np.exp(odds - top)
    share = e / np.repeat(np.add.reduceat(e, first), n)
    return np.add.reduceat(share * odds, first), share


# --- training -----------------------------------------------------------------


def _gradients(net: Network, words: list[str], at: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean logistic loss of documents whose windows (places in
    ``words``, -1 for empty steps) begin at ``first``."""
    w, h = net.weights, HIDDEN
    x, (place, rows, owner, per, chars) = net.inputs([*words, ""])
    x[-1] = 0
    p = net.projected(x)
    kept: list = []
    states = net.run(p, at, kept)
    real = at >= 0
    real = real | (~real.any(1))[:, None]
    odds, (focus, share, pooled) = net.attend(states, real)
    doc, weight = smooth_maximum(odds, first)
    n = np.diff(np.concatenate((first, [len(odds)])))
    d_doc = (_sigmoid(doc) - y) / len(y)
    d_odds = (np.repeat(d_doc, n) * weight * (1 + odds - np.repeat(doc, n))).astype(F32)
    g: dict[str, np.ndarray] = {"out": d_odds @ pooled, "out_bias": d_odds.sum(keepdims=True)}
    d_pooled = d_odds[:, None] * w["out"]
    d_share = (states * d_pooled).sum(-1)
    d_e = share * (d_share - (share * d_share).sum(0))
    g["focus_out"] = np.tensordot(d_e, focus, 2)
    d_focus = d_e[..., None] * w["focus_out"] * (1 - focus * focus)
    g["focus"] = np.tensordot(states, d_focus, ((0, 1), (0, 1)))
    d_states = share[..., None] * d_pooled + d_focus @ w["focus"].T
    steps = len(states)
    d_gates = np.empty((2, steps, len(at), 3 * h), F32)
    g["step"] = np.zeros_like(w["step"])
    back = w["step"].transpose(0, 2, 1)
    carry = np.zeros((2, len(at), h), F32)
    for t in range(steps - 1, -1, -1):
        before, z, r, c, m = kept[t]
        d = carry + np.stack((d_states[t, :, :h], d_states[steps - 1 - t, :, h:]))
        d_z = d * (c - before) * z * (1 - z)
        d_c = d * z * (1 - c * c)
        d_r = d_c * m * r * (1 - r)
        d_m = np.concatenate((d_z, d_r, d_c * r), -1)
        g["step"] += np.matmul(before.transpose(0, 2, 1), d_m)
        carry = d * (1 - z) + np.matmul(d_m, back)
        d_gates[0, t] = np.concatenate((d_z[0], d_r[0], d_c[0]), -1)
        d_gates[1, steps - 1 - t] = np.concatenate((d_z[1], d_r[1], d_c[1]), -1)
    flat = (at.T % len(x)).ravel()
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    by_step = d_gates.transpose(1, 2, 0, 3).reshape(len(flat), 6 * h)[order]
    d_p = np.zeros((len(x), 6 * h), F32)
    d_p[s[cut]] = np.add.reduceat(by_step, cut)
    g["in"], g["in_bias"] = x.T @ d_p, d_p.sum(0)
    d_x = d_p @ w["in"].T
    d_x[-1] = 0
    g["word"] = np.zeros_like(w["word"])
    seen = place > 0
    g["word"][place[seen]] = d_x[seen, :WORD_DIM]
    d_chars = d_x[:, WORD_DIM:] * (1 - chars * chars) * per[:, None]
    g["char"] = np.stack([np.bincount(rows, weights=d_chars[owner, k], minlength=CHAR_ROWS) for k in range(CHAR_DIM)], 1).astype(F32)
    return g


@dataclass
class _Adam:
    rate: float
    decay: float
    m: dict[str, np.ndarray] = field(default_factory=dict)
    v: dict[str, np.ndarray] = field(default_factory=dict)
    t: int = 0

    def step(self, w: dict[str, np.ndarray], g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, x in g.items():
            m = self.m.setdefault(k, np.zeros_like(x))
            v = self.v.setdefault(k, np.zeros_like(x))
            m += F32(0.1) * (x - m)
            v += F32(0.01) * (x * x - v)
            by = (m / F32(1 - 0.9**self.t)) / (np.sqrt(v / F32(1 - 0.99**self.t)) + F32(1e-6))
            w[k] -= F32(rate) * (by + F32(self.decay) * w[k])


def fit(documents: list[list[list[str]]], y: np.ndarray, steps: int = 200, batch: int = 96, windows: int = 4, seed: int = 1) -> Network:
    """Train on documents given as windows of words; every step takes as many
    documents of each class and some windows of each."""
    rng = np.random.default_rng(seed)
    held: Counter[str] = Counter()
    for doc in documents:
        held.update({w for window in doc for w in window})
    often = sorted(((n, w) for w, n in held.items() if n >= MIN_DOCUMENTS), key=lambda x: (-x[0], x[1]))[:MAX_VOCABULARY]
    net = Network.fresh({w: i + 1 for i, (_, w) in enumerate(often)}, seed)
    sides = [np.flatnonzero(y == k) for k in (0, 1)]
    if not all(len(s) for s in sides):
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    adam = _Adam(rate=0.01, decay=0.01)
    for step in range(steps):
        chosen = np.concatenate([rng.choice(s, min(batch // 2, len(s)), replace=False) for s in sides])
        texts: list[list[str]] = []
        first: list[int] = []
        for k in chosen.tolist():
            first.append(len(texts))
            doc = documents[k]
            take = range(len(doc)) if len(doc) <= windows else rng.choice(len(doc), windows, replace=False)
            texts += [doc[i] for i in take]
        names = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        at = np.full((len(texts), WINDOW), -1, np.int64)
        for i, t in enumerate(texts):
            at[i, : len(t)] = [names[w] for w in t]
        at[rng.random(at.shape) < DROPPED] = -1
        g = _gradients(net, list(names), at, np.array(first), y[chosen].astype(F32))
        adam.step(net.weights, g, adam.rate * min(1.0, 2 * (1 - step / steps)))
    return net


def calibrate(net: Network, odds: np.ndarray, y: np.ndarray) -> None:
    """Logistic fit of the labels on the documents' log odds (Newton steps, a
    ridge towards slope 1)."""
    f = np.stack((odds, np.ones(len(odds))), 1)
    ridge = np.array([1.0, 0.01])
    start = np.array([1.0, 0.0])

    def loss(theta: np.ndarray) -> float:
        x = f @ theta
        return float((np.logaddexp(0, x) - y * x).sum() + 0.5 * (ridge * (theta - start) ** 2).sum())

    theta = start
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(f @ theta, -60, 60)))
        gradient = f.T @ (y - q) - ridge * (theta - start)
        move = np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + np.diag(ridge), gradient)
        while loss(theta + move) > loss(theta) and np.abs(move).max() > 1e-9:
            move = move / 2
        theta = theta + move
    net.slope, net.shift = max(float(theta[0]), 0.1), float(theta[1])


# --- scoring ------------------------------------------------------------------


class Scorer:
    """Document log odds over all windows; keeps the inputs of known words."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.known: dict[str, int] = {}
        self.table = np.zeros((2, 1024, 3 * HIDDEN), F32)
        self.empty = net.projected(np.zeros((1, WORD_DIM + CHAR_DIM), F32))[:, 0]

    def _places(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.known))
        if new and len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(set(words))
        if new:
            a, b = len(self.known), len(self.known) + len(new)
            if b + 1 > self.table.shape[1]:
                more = np.zeros((2, max(2 * b, 1024), 3 * HIDDEN), F32)
                more[:, :a] = self.table[:, :a]
                self.table = more
            for k in range(0, len(new), 8192):
                self.table[:, a + k : a + k + len(new[k : k + 8192])] = self.net.projected(self.net.inputs(new[k : k + 8192])[0])
            self.table[:, -1] = self.empty
            self.known.update(zip(new, range(a, b), strict=True))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def odds(self, texts: list[str]) -> np.ndarray:
        """Smooth maximum of the window log odds of each text."""
        total = np.zeros((len(texts), 3))  # reference, sum of weights, weighted sum
        total[:, 0] = -np.inf
        for owners, at in self._windows(texts):
            real = at >= 0
            real = real | (~real.any(1))[:, None]
            odds = self.net.attend(self.net.run(self.table, at), real)[0].astype(np.float64)
            first = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
            d = owners[first]
            n = np.diff(np.concatenate((first, [len(odds)])))
            top = np.maximum(total[d, 0], np.maximum.reduceat(odds, first))
            e = np.exp(odds - np.repeat(top, n))
            old = np.exp(total[d, 0] - top)
            total[d, 1] = total[d, 1] * old + np.add.reduceat(e, first)
            total[d, 2] = total[d, 2] * old + np.add.reduceat(e * odds, first)
            total[d, 0] = top
        return total[:, 2] / total[:, 1]

    def _windows(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, places of the words) of windows, BATCH_WINDOWS together;
        a document's windows follow each other."""
        owners: list[np.ndarray] = []
        flats: list[list[str]] = []
        starts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = base = 0

        def batches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            flat = np.concatenate((self._places([w for f in flats for w in f]), [-1]))
            of, s, z = np.concatenate(owners), np.concatenate(starts), np.concatenate(sizes)
            step = np.arange(WINDOW)
            for a in range(0, len(of), BATCH_WINDOWS):
                cut = slice(a, a + BATCH_WINDOWS)
                yield of[cut], flat[np.where(step < z[cut, None], s[cut, None] + step, len(flat) - 1)]

        for k, text in enumerate(texts):
            rest: list[str] = []
            pieces = words_of(text)
            piece = next(pieces)
            fresh = True  # no window of this text yet
            while piece is not None:
                following = next(pieces, None)
                words = rest + piece
                if following is None:
                    at = window_starts(len(words))
                    if not fresh and len(words) <= WINDOW - STRIDE:
                        at = at[:0]  # the last window held these words already
                    rest = []
                else:
                    at = STRIDE * np.arange(max(0, (len(words) - WINDOW) // STRIDE + 1))
                    rest = words[STRIDE * len(at) :]
                if len(at):
                    fresh = False
                    owners.append(np.full(len(at), k))
                    starts.append(base + at)
                    sizes.append(np.minimum(WINDOW, len(words) - at))
                    flats.append(words)
                    base += len(words)
                    held += len(at)
                piece = following
                if held >= 8 * BATCH_WINDOWS:
                    yield from batches()
                    owners, flats, starts, sizes = [], [], [], []
                    held = base = 0
        if held:
            yield from batches()

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.net.constant is not None:
            return np.full(len(texts), self.net.constant)
        return 1 / (1 + np.exp(-np.clip(self.net.slope * self.odds(texts) + self.net.shift, -60, 60)))


# --- tables -------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32(id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, max_documents: int) -> DataFrame:
    """(id, y, text): the bounded training sample, one text an id."""
    key = F.col(doc_id)
    clear = (
        labels.where(F.col(label).isin(0, 1) & key.isNotNull() & ~held_out(key))
        .groupBy(key.alias("id"))
        .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("__high"))
        .where(F.col("y") == F.col("__high"))
        .select("id", "y")
    )
    side = lambda k: clear.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(max_documents)
    rows = docs.select(key.alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # broadcast: 2 * max_documents rows of two numbers
    rows = rows.join(F.broadcast(side(0).unionAll(side(1))), "id")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("s")
    return rows.groupBy("id", "y").agg(least).select("id", "y", "s.text")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", max_documents: int = MAX_DOCUMENTS) -> Network:
    """Fit on the bounded sample (module text)."""
    sample = _sample(docs, labels, label, doc_id, text, max_documents)

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list[str]] = []
        for x in batch.column(2).to_pylist():
            words = [w for piece in words_of(x) for w in piece]
            at = window_starts(len(words))
            at = at[np.unique(np.linspace(0, len(at) - 1, MAX_WINDOWS).astype(int))]
            out.append([" ".join(words[a : a + WINDOW]) for a in at.tolist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.string()))], ["id", "y", "windows"])

    key = sample.schema["id"].dataType.simpleString()
    found = map_batches(sample, windows, f"id {key}, y int, windows array<string>").toPandas()
    found = found.assign(by=[zlib.crc32(str(i).encode()) for i in found.id]).sort_values(["by", "id"])
    net = fit([[w.split(" ") if w else [] for w in x] for x in found.windows], found.y.to_numpy(np.int64))
    if net.constant is None:

        def odds(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(Scorer(net).odds(batch.column(2).to_pylist()))], ["y", "odds"])

        whole = map_batches(sample, odds, "y int, odds double").toPandas()  # two numbers a sampled document
        calibrate(net, whole.odds.to_numpy(), whole.y.to_numpy())
    return net


def score(docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    scorers: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not scorers:
            scorers.append(Scorer(net))
        s = scorers[0].scores(["" if x is None else x for x in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    key = docs.schema[doc_id].dataType.simpleString()
    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {key}, score double", GROUP_BYTES)
