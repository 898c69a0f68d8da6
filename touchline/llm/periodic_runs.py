"""Periodic runs of words, found with a dictionary of basic factors.

The basic factors of a word sequence are its factors of length 2**k, one
starting at every position. Level 0 names the words themselves; the name of the
factor of length 2L at i is the name of the pair (factor of length L at i,
factor of length L at i + L). A factor that stands nowhere else in its document
is dropped, as every longer factor that begins or ends with it stands nowhere
else either, so from the second level on only repeated passages are left.

At each level the successor of a factor is its next occurrence in the document.
Successors within twice the factor's length are progressions of occurrences:
consecutive positions with one and the same distance d to the successor say that
words d apart are equal, from the first of them up to the end of the last one's
successor. Level L proposes the periods in (L / 2, L] (level 1: period 1), so
every period has one level. A proposed stretch is extended to both sides while
words d apart agree, proposals that meet in one run are merged, and runs of
``min_length`` words and ``min_periods`` periods or more are kept. A run of four
periods or more holds factors of its level whose successors are one smallest
period away, so no run is missed and no multiple of a smallest period is
proposed for a whole run.

All documents of a batch go through the levels together (their words have names
of their own); memory grows with the words of one batch, a longer text being a
batch of its own, cut into words slice by slice.

Defined results: null text and a text without words have no runs and empty
digest inputs; repeated rows, repeated and null ids are handled row by row; an
empty table gives no rows. Only the id and text columns are read, so other
columns can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import map_batches, text_bytes

MIN_LENGTH = 6
MIN_PERIODS = 4
SLICE_BYTES = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


# --- words --------------------------------------------------------------------


def word_names(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and, for every word of the text, its place among them.
    Words are separated by ASCII white space."""
    names: dict[bytes, int] = {}
    parts: list[np.ndarray] = []
    at = 0
    while at < len(text):
        end = min(at + SLICE_BYTES, len(text))
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        words = text[at:end].split()
        for w in words:
            if w not in names:
                names[w] = len(names)
        parts.append(np.fromiter(map(names.__getitem__, words), np.int32, len(words)))
        at = end
    return list(names), np.concatenate(parts) if parts else np.zeros(0, np.int32)


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of the n words when the contract's rule
    makes the document's tail periodic; None where it doesn't."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


# --- basic factors ------------------------------------------------------------


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by key then place, first of its key in that order?)."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    return order, first


def find_runs(docs: list[np.ndarray], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of several sequences of word numbers: arrays (document, start,
    length, period) ordered by them."""
    if min_periods < 4:
        raise ValueError("the levels' bounds hold for runs of four periods or more")
    sizes = np.array([len(x) for x in docs], np.int64)
    n = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none, none, none
    base = np.concatenate(([0], np.cumsum(sizes)))
    doc = np.repeat(np.arange(len(docs)), sizes)
    offset = np.concatenate(([0], np.cumsum([int(x.max()) + 1 if len(x) else 0 for x in docs])))
    word = np.concatenate(docs).astype(np.int64) + offset[doc]
    end_of = base[1:][doc]

    name = np.full(n + 1, -1, np.int64)  # of the factor at each place; -1: it stands nowhere else
    place = np.arange(n)  # places whose factor may be repeated
    keys = word
    length = 1
    found: list[np.ndarray] = []
    while len(place):
        order, first = _named(keys)
        number = np.cumsum(first) - 1
        many = np.bincount(number)[number] > 1
        # successors: the next place of the same name
        p = place[order]
        follows = np.zeros(len(p), bool)
        follows[:-1] = ~first[1:]
        step = np.zeros(n + 1, np.int64)
        q = np.flatnonzero(follows)
        d = p[q + 1] - p[q]
        near = (d <= length) & (2 * d > length)
        step[p[q[near]]] = d[near]
        found.append(_stretches(step, length))
        name.fill(-1)
        name[p[many]] = number[many]
        # factors of twice the length, inside their document
        place = np.flatnonzero(name[:n] >= 0)
        place = place[place + 2 * length <= end_of[place]]
        right = name[place + length]
        place, right = place[right >= 0], right[right >= 0]
        # a period of the next level is at most its length and at least half of it plus one
        reach = min_periods * (length + 1) <= sizes[doc[place]]
        place, right = place[reach], right[reach]
        keys = name[place] * n + right
        length *= 2
    return _extended(np.concatenate(found), word, base, doc, min_length, min_periods)


def _stretches(step: np.ndarray, length: int) -> np.ndarray:
    """(first, past the end, period) where consecutive places share a step."""
    cut = np.flatnonzero(np.diff(step)) + 1
    a = np.concatenate(([0], cut))
    b = np.concatenate((cut, [len(step)]))
    d = step[a]
    some = d > 0
    a, b, d = a[some], b[some], d[some]
    return np.stack((a, b - 1 + length + d, d), 1)


def _extended(proposed: np.ndarray, word: np.ndarray, base: np.ndarray, doc: np.ndarray, min_length: int, min_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    # short stretches can't lie in a run that is long enough: see the module text
    runs: set[tuple[int, int, int]] = set()
    long_enough = proposed[:, 1] - proposed[:, 0] >= np.maximum(min_length, min_periods * proposed[:, 2])
    reach: dict[int, int] = {}
    for a, b, d in sorted(map(tuple, proposed[long_enough].tolist()), key=lambda x: (x[2], x[0])):
        if a < reach.get(d, -1) - d:  # inside the run found just before
            continue
        k = int(doc[a])
        a = _agree_left(word, a, d, int(base[k]))
        b = _agree_right(word, b, d, int(base[k + 1]))
        reach[d] = b
        runs.add((a, b, d))
    found = np.array(sorted(runs), np.int64).reshape(-1, 3)
    of = doc[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    order = np.lexsort((found[:, 2], found[:, 0]))
    found, of = found[order], of[order]
    return of, found[:, 0] - base[of], found[:, 1] - found[:, 0], found[:, 2]


def _agree_left(word: np.ndarray, a: int, d: int, low: int) -> int:
    """Smallest start from which words d apart agree up to ``a``."""
    width = 16
    while a > low:
        x = max(low, a - width)
        differ = np.flatnonzero(word[x:a] != word[x + d : a + d])
        if len(differ):
            return x + int(differ[-1]) + 1
        a, width = x, 2 * width
    return a


def _agree_right(word: np.ndarray, b: int, d: int, high: int) -> int:
    width = 16
    while b < high:
        x = min(high, b + width)
        differ = np.flatnonzero(word[b:x] != word[b - d : x - d])
        if len(differ):
            return b + int(differ[0])
        b, width = x, 2 * width
    return b


def strongest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> int:
    """Place of the run with the greatest length / period (ties: smallest
    start, then period); the runs are in that order."""
    ratio = length / period
    close = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-12))
    return int(min(close, key=lambda i: (-Fraction(int(length[i]), int(period[i])), int(start[i]), int(period[i]))))


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """True for words outside the repetitions: a run keeps its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:n] == 0


# --- tables -------------------------------------------------------------------

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs,
    collapsed): of every row its runs by start and period, the strongest one,
    and the text whose runs keep their first period (words joined by a space).
    ``plant`` applies the contract's periodic tail first."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_pylist()
        cut = [word_names(t) for t in text_bytes(batch.column(1))]
        places = [x[1] for x in cut]
        if plant:
            tails = [repeated_tail(i, len(x)) for i, x in zip(ids, places, strict=True)]
            places = [x if t is None else x[t] for x, t in zip(places, tails, strict=True)]
        of, start, length, period = find_runs(places, min_length, min_periods)
        at = np.searchsorted(of, np.arange(len(ids) + 1))
        best: list[tuple[int, int, int, int] | tuple[None, None, None, None]] = []
        collapsed: list[bytes] = []
        for k, (names, _) in enumerate(cut):
            a, b = at[k], at[k + 1]
            s, m, q = start[a:b], length[a:b], period[a:b]
            if a == b:
                best.append((None, None, None, None))
                kept = places[k]
            else:
                i = strongest(s, m, q)
                best.append((int(s[i]), int(m[i]), int(q[i]), 1000 * int(m[i]) // int(q[i])))
                kept = places[k][kept_words(len(places[k]), s, m, q)]
            collapsed.append(b" ".join(map(names.__getitem__, kept.tolist())))
        rows = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
        columns = [
            batch.column(0),
            pa.array([len(x) for x in places], pa.int64()),
            pa.array(np.diff(at), pa.int64()),
            *[pa.array([x[j] for x in best], pa.int64()) for j in range(4)],
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])

    key = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, run, f"doc_id {key}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<{RUN}>, collapsed string")
