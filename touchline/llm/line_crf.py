"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a document is a node with two states, bad (0) and good (1). Node
potentials are linear in features of the line and of its two neighbours, edge
potentials are a 2 x 2 table. A document's score is the mean of the
forward-backward marginals P(good), weighted by line length, its log odds
scaled and shifted to read as a probability.

Training: the given labels are of documents, so lines inherit them; after the
first fit, lines of bad documents that the fitted node potentials alone call
good become good (the worst line stays bad), and the field is fitted again on
those line labels. The fit runs on a bounded sample: the ``max_documents``
labelled documents first in hash order, each with all its lines or, where it has
more, with ``max_lines`` consecutive ones whose place its id decides (their
features come from the whole text). Scoring covers every whole text.

Documents go through the recursions in groups of similar line counts (each group
holds counts within a factor of two), so memory is linear in the lines.

Defined results: null text is empty text; an empty text is one empty line and
gets a score like any other; with no training rows, or rows of one class only,
every score is 0.5; an id that is given several texts is represented in training
by the one of least hash; rows are never dropped or merged, so repeated rows and
ids come back as often as they came; a null id is scored and is not held out. Only
the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import PrefixHash, map_batches, text_bytes, words_between

MAX_DOCUMENTS = 2000
MAX_LINES = 128
#: Lines whose features stand together.
BLOCK_LINES = 1 << 15

_SYMBOLS = b"#$%&*@^~<>_=+\\/{}[]`"
_STOPS = b".!?"


def _lut(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_KINDS = [
    _lut(bytes(range(65, 91))),
    _lut(bytes(range(97, 123))),
    _lut(b"0123456789"),
    _lut(_SYMBOLS),
    _lut(b"!"),
    _lut(b"|"),
    _lut(b".,;:?'\"()-"),
    _lut(b" \t\r"),
    _lut(bytes(range(128, 256))),
]
_IS_SPACE = _lut(b" \t\n\x0b\x0c\r")
_IS_STOP = _lut(_STOPS)
N_OWN = len(_KINDS) + 6
N_FEATURES = 3 * N_OWN + 3


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x N_FEATURES), byte length of each line, number of lines
    of each text (at least one)."""
    own, length, n_lines = _own_features(texts)
    return _with_neighbours(own, n_lines, 0, len(own)), length, n_lines


def _own_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = b"".join(t + b"\n" for t in texts)
    buf = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    n_lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    length = ends - starts
    size = np.maximum(length, 1)

    own = np.zeros((len(starts), N_OWN), np.float32)
    for k, kind in enumerate(_KINDS):
        upto = np.concatenate(([0], np.cumsum(kind[buf], dtype=np.int64)))
        own[:, k] = (upto[ends] - upto[starts]) / size
    w0, w1 = words_between(_IS_SPACE[buf])
    k = len(_KINDS)
    if len(w0):
        h = PrefixHash(buf).of(w0, w1)
        line = np.searchsorted(ends, w0)
        words = np.bincount(line, minlength=len(starts))
        same = np.zeros(len(w0), bool)
        same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        own[:, k] = np.bincount(line, weights=same, minlength=len(starts)) / np.maximum(words, 1)
        own[:, k + 1] = np.minimum(np.bincount(line, weights=w1 - w0, minlength=len(starts)) / np.maximum(words, 1) / 10, 5)
        own[:, k + 2] = np.log1p(words) / 5
        stop = _IS_STOP[buf[w1 - 1]]
        own[:, k + 3] = np.bincount(line, weights=stop, minlength=len(starts)) / np.maximum(words, 1)
    own[:, k + 4] = length == 0
    last = np.maximum(ends - 1, 0)
    own[:, k + 5] = (length > 0) & _IS_STOP[buf[last]]

    return own, length, n_lines


def _with_neighbours(own: np.ndarray, n_lines: np.ndarray, a: int, b: int) -> np.ndarray:
    """Features of lines a..b-1: their own, those of the lines before and after
    (zero beyond a text's ends), which ends they are at, and a constant."""
    x = np.zeros((b - a, N_FEATURES), np.float32)
    last = np.cumsum(n_lines) - 1
    is_last = np.zeros(len(own) + 1, bool)
    is_last[last] = is_last[-1] = True
    first, end = is_last[np.arange(a, b) - 1], is_last[a:b]
    x[:, :N_OWN] = own[a:b]
    x[1:, N_OWN : 2 * N_OWN] = own[a : b - 1]
    x[0, N_OWN : 2 * N_OWN] = own[a - 1]
    x[first, N_OWN : 2 * N_OWN] = 0
    x[:-1, 2 * N_OWN : 3 * N_OWN] = own[a + 1 : b]
    x[-1, 2 * N_OWN : 3 * N_OWN] = own[b % len(own)]
    x[end, 2 * N_OWN : 3 * N_OWN] = 0
    x[:, -3], x[:, -2], x[:, -1] = first, end, 1
    return x


@dataclass
class LineCrf:
    weights: np.ndarray  # node potential of "good" for standardised features
    edges: np.ndarray  # 2 x 2: potential of (state, next state)
    mean: np.ndarray
    scale: np.ndarray
    slope: float = 1.0  # of the document score's log odds
    shift: float = 0.0

    def node(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def marginals(self, u: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        """P(good) of every line, given node potentials laid end to end."""
        p = np.empty(len(u))
        for docs, lines in _groups(n_lines):
            grid, order = _grid(u[lines], n_lines[docs])
            a, b = _messages(grid, n_lines[docs][order], self.edges)
            p[lines] = _flat(1 / (1 + np.exp(-np.clip(a + b, -60, 60))), n_lines[docs], order)
        return p

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, number of lines and number of lines more likely bad, by text."""
        own, length, n_lines = _own_features(texts)
        u = [self.node(_with_neighbours(own, n_lines, a, min(a + BLOCK_LINES, len(own)))) for a in range(0, len(own), BLOCK_LINES)]
        p = self.marginals(np.concatenate(u), n_lines)
        at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
        weight = np.maximum(length, 1).astype(np.float64)
        share = np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at)
        score = 1 / (1 + np.exp(-np.clip(self.slope * _log_odds(share) + self.shift, -60, 60)))
        return score, n_lines, np.add.reduceat((p < 0.5).astype(np.int64), at)


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _groups(n_lines: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(documents, their lines) by powers of two of the line count."""
    size = np.frexp(n_lines)[1]
    at = np.cumsum(n_lines) - n_lines
    for k in np.unique(size):
        docs = np.flatnonzero(size == k)
        n = n_lines[docs]
        yield docs, np.repeat(at[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _grid(u: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, document) layout, longest documents first."""
    order = np.argsort(-n_lines, kind="stable")
    grid = np.zeros((int(n_lines.max()), len(n_lines)))
    at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    row = np.arange(len(u)) - np.repeat(at, n_lines)
    grid[row, np.repeat(column, n_lines)] = u
    return grid, order


def _flat(grid: np.ndarray, n_lines: np.ndarray, order: np.ndarray) -> np.ndarray:
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
    return grid[np.arange(int(n_lines.sum())) - np.repeat(at, n_lines), np.repeat(column, n_lines)]


def _messages(u: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds good : bad from the left (own node included) and from the right
    (own node excluded). ``lengths`` fall, so the documents that reach a
    position are a prefix of the columns."""
    reach = np.searchsorted(-lengths, -np.arange(len(u)), side="left")  # documents longer than a position
    a, b = u.copy(), np.zeros_like(u)
    for i in range(1, len(u)):
        p = a[i - 1, : reach[i]]
        a[i, : reach[i]] += np.logaddexp(p + t[1, 1], t[0, 1]) - np.logaddexp(p + t[1, 0], t[0, 0])
    for i in range(len(u) - 2, -1, -1):
        q = u[i + 1, : reach[i + 1]] + b[i + 1, : reach[i + 1]]
        b[i, : reach[i + 1]] = np.logaddexp(q + t[1, 1], t[1, 0]) - np.logaddexp(q + t[0, 1], t[0, 0])
    return a, b


def fit(x: np.ndarray, length: np.ndarray, n_lines: np.ndarray, quality: np.ndarray, steps: int = 60, decay: float = 1e-3) -> LineCrf:
    """Fit on documents laid end to end (see the module text)."""
    d = x.shape[1]
    mean, scale = x.mean(0), x.std(0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    model = LineCrf(np.zeros(d), np.zeros((2, 2)), mean, scale)
    if len(np.unique(quality)) < 2:
        return model
    z = ((x - mean) / scale).astype(np.float64)
    y = np.repeat(quality, n_lines).astype(np.float64)
    # both classes weigh the same
    weight = np.where(quality == 1, 0.5 / (quality == 1).mean(), 0.5 / (quality == 0).mean())
    doc_line = np.repeat(np.arange(len(n_lines)), n_lines)
    _ascend(model, z, y, n_lines, weight, steps, decay)
    u = model.node(x)
    at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
    worst = np.minimum.reduceat(u, at)[doc_line]
    y = np.where((y == 0) & (u > 0) & (u > worst), 1.0, y)
    _ascend(model, z, y, n_lines, weight, steps, decay)
    _calibrate(model, x, length, n_lines, quality)
    return model


def _calibrate(model: LineCrf, x: np.ndarray, length: np.ndarray, n_lines: np.ndarray, quality: np.ndarray) -> None:
    """Logistic fit of the labels on the log odds of the weighted mean marginal
    (Newton steps, a small ridge), so that a score reads as a probability."""
    p = model.marginals(model.node(x), n_lines)
    at = np.concatenate(([0], np.cumsum(n_lines)[:-1]))
    weight = np.maximum(length, 1).astype(np.float64)
    f = np.stack((_log_odds(np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at)), np.ones(len(at))), 1)
    theta = np.array([1.0, 0.0])
    ridge = np.diag([1.0, 0.1])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(f @ theta, -30, 30)))
        g = f.T @ (quality - q) - ridge @ (theta - [1.0, 0.0])
        theta = theta + np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + ridge, g)
    model.slope, model.shift = max(float(theta[0]), 0.1), float(theta[1])


def _ascend(model: LineCrf, z: np.ndarray, y: np.ndarray, n_lines: np.ndarray, weight: np.ndarray, steps: int, decay: float) -> None:
    """Adam on the conditional log likelihood, full batch."""
    w_line = np.repeat(weight, n_lines)
    total = w_line.sum()
    parts = []
    for docs, lines in _groups(n_lines):
        n = n_lines[docs]
        y_grid, order = _grid(y[lines], n)
        inside = np.arange(len(y_grid))[1:, None] < n[order][None, :]
        w_doc = weight[docs][order]
        seen = np.array([(w_doc * inside * (y_grid[:-1] == i) * (y_grid[1:] == j)).sum() for i in (0, 1) for j in (0, 1)])
        parts.append((lines, n, order, inside, w_doc, seen))
    theta = np.concatenate((model.weights, model.edges.ravel()))
    m = np.zeros_like(theta)
    v = np.zeros_like(theta)
    for step in range(1, steps + 1):
        t = theta[-4:].reshape(2, 2)
        node = z @ theta[:-4]
        p = np.empty(len(y))
        g_edge = np.zeros(4)
        for lines, n, order, inside, w_doc, seen in parts:
            u, _ = _grid(node[lines], n)
            a, b = _messages(u, n[order], t)
            p[lines] = _flat(1 / (1 + np.exp(-np.clip(a + b, -60, 60))), n, order)
            q = u[1:] + b[1:]
            e = [t[0, 0] + 0 * q, t[0, 1] + q, a[:-1] + t[1, 0], a[:-1] + t[1, 1] + q]
            top = np.maximum.reduce(e) if len(q) else 0
            e = [np.exp(k - top) for k in e]
            norm = sum(e)
            g_edge += [seen[k] - (w_doc * inside * e[k] / norm).sum() for k in range(4)]
        g_node = z.T @ (w_line * (y - p))
        g = np.concatenate((g_node, g_edge)) / total - decay * theta
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        theta = theta + 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights, model.edges = theta[:-4].copy(), theta[-4:].reshape(2, 2).copy()


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32(id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_documents: int = MAX_DOCUMENTS, max_lines: int = MAX_LINES) -> LineCrf:
    """Fit on the bounded sample (module text). Ids whose labels contradict each
    other, and null ids or labels, are not used. Only the features of the
    sample reach the driver: at most max_documents x max_lines rows."""
    key = F.col(doc_id)
    chosen = (
        labels.where(F.col(label).isin(0, 1) & key.isNotNull() & ~held_out(key))
        .groupBy(key.alias("__id"))
        .agg(F.min(label).cast("int").alias("__low"), F.max(label).cast("int").alias("__high"))
        .where("__low = __high")
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(max_documents)
        .select("__id", F.col("__low").alias("__y"))
    )
    # broadcast: max_documents rows of two numbers
    rows = docs.select(key.alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text")).join(F.broadcast(chosen), "__id")
    one = F.min(F.struct(F.xxhash64("__text").alias("h"), F.col("__text").alias("__text"))).alias("s")
    rows = rows.groupBy("__id", "__y").agg(one).select("__id", "__y", "s.__text")

    def features(batch: pa.RecordBatch):
        x, length, n = line_features(text_bytes(batch.column(2)))
        x = np.hstack((x, length[:, None].astype(np.float32)))
        first = np.cumsum(n) - n
        spare = np.maximum(n - max_lines, 0)
        first += np.array([zlib.crc32(str(i).encode()) for i in batch.column(0).to_pylist()], np.int64) % (spare + 1)
        kept = n - spare
        blobs = [x[a:b].tobytes() for a, b in zip(first.tolist(), (first + kept).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.int32()), pa.array(blobs, pa.binary())], ["id", "y", "n", "x"])

    kind = rows.schema["__id"].dataType.simpleString()
    found = map_batches(rows, features, f"id {kind}, y int, n int, x binary").toPandas().sort_values("id")
    if not len(found):
        return LineCrf(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32))
    x = np.frombuffer(b"".join(found.x), np.float32).reshape(-1, N_FEATURES + 1)
    return fit(x[:, :-1].copy(), x[:, -1].astype(np.int64), found.n.to_numpy(np.int64), found.y.to_numpy(np.int64))


def score(docs: DataFrame, model: LineCrf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_lines, n_bad_lines) of every row."""
    key = docs.schema[doc_id].dataType.simpleString()

    def run(batch: pa.RecordBatch):
        s, n, bad = model.scores(text_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(n), pa.array(bad)], ["doc_id", "score", "n_lines", "n_bad_lines"])

    return map_batches(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {key}, score double, n_lines long, n_bad_lines long")


def accepted(docs: DataFrame, model: LineCrf, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch):
        yield batch.filter(pa.array(model.scores(text_bytes(batch.column(at)))[0] >= threshold))

    return map_batches(docs, run, docs.schema)
