"""Exact substring deduplication by content hashes of sampled anchors.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else. Two positions are the same if the ``length`` bytes from them are,
so positions are ranked by growing prefixes, and those whose rank is unique at
an offset drop out before the next.

Ranking all positions would shuffle many times the input, so the first rounds
rank anchors: the anchor of position p is the place of the least hash of ``GRAM``
bytes within the next ``window`` places (leftmost of equals). It depends only on
the ``length`` bytes from p, so equal strings have the same anchor at the same
distance, and about two in ``window`` positions are anchors.

 1. rank by the ``HEAD`` bytes from the anchor; unique ranks drop out;
 2. pair that rank with the whole stretch of text that the anchor's positions
    cover; a stretch met twice is decided for all its positions at once; if a
    rank has other stretches, one copy of each goes on;
 3. cut those into runs of ``RUN`` positions at fixed distances from the anchor
    and rank by the bytes that all positions of a run share; unique ranks drop
    out, runs whose stretch is met twice are decided, the others go on;
 4. rank what is left position by position by its ``length`` bytes.

This replaces prefix doubling: no pair of ranks is joined from (rank at p, rank
at p + offset), no offset grows and nothing is sorted; each round hashes the text
again. The doubling form isn't built and its shuffle and disk aren't measured.

Ranks are names given by a 64-bit hash of the bytes and brought together by
Spark's shuffle, not dense numbers from a total sort; in the last round the
name of the round before is part of the key (128 bits).

Defined results: null text is empty; texts shorter than ``length`` lose
nothing; repeated rows are each other's copies; null ids are kept; an empty
table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import PrefixHash, map_batches, mix, stored, text_bytes

GRAM = 16
HEAD = 32
RUN = 16
_U = np.uint64


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def anchors(texts: list[bytes], length: int, head: int) -> tuple[np.ndarray, ...]:
    """(text, first position, last position, anchor minus first position, rank
    of the head, rank of the whole stretch) of each anchor; positions are
    relative to the text."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),) * 2
    if not (sizes >= length).any():
        return none
    window = length - head + 1
    prefix = PrefixHash(buf)
    gram = min(GRAM, head)
    i = np.arange(len(buf) - gram + 1)
    place = _U((1 << 31) - 1)
    # place in the low bits: the leftmost of equals is the least
    key = (prefix.of(i, i + gram) & ~place) | i.astype(_U)
    pad = -len(key) % window
    key = np.concatenate((key, np.full(pad + window, _U(0xFFFFFFFFFFFFFFFF)))).reshape(-1, window)
    ahead = np.minimum.accumulate(key, axis=1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    # positions with ``length`` bytes left in their text
    starts = np.maximum(sizes - length + 1, 0)
    p = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts) + np.repeat(at[:-1], starts)
    text = np.repeat(np.arange(len(texts)), starts)
    anchor = (np.minimum(behind[p], ahead[p + window - 1]) & place).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(p)])) - 1
    lo, hi, a, text = p[first], p[last], anchor[first], text[first]
    h = prefix.of(a, a + head)
    whole = mix(prefix.of(lo, hi + length) ^ mix((a - lo).astype(_U) * _U(length + 1) + (hi - lo).astype(_U)))
    return text, lo - at[text], hi - at[text], a - lo, h, whole


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with a key that is never null and tells texts of one id apart."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("k"), F.xxhash64(t).alias("v"), t.alias("text"))


def repeated_spans(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """(k, v, starts array<struct<lo, hi>>): ranges of positions whose
    ``length`` bytes also start elsewhere, for every text that has some."""
    head = min(head, length)
    rows = _keyed(docs, doc_id, text)

    def sample(batch: pa.RecordBatch):
        t, lo, hi, back, h, whole = anchors(text_bytes(batch.column(2)), length, head)
        index = pa.array(t)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), _int(lo), _int(hi - lo), _int(back), pa.array(np.zeros(len(t), bool)), _signed(h), _signed(whole)], names)

    names = ["k", "v", "lo", "more", "back", "done", "rank", "stretch"]
    schema = "k long, v long, lo int, more int, back int, done boolean, rank long, stretch long"
    sampled = map_batches(rows.select("k", "v", "text"), sample, schema)
    shared = sampled.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank")
    kept = stored(sampled.join(shared, "rank"), "heads")
    decided, left = _settle(kept)

    def runs(batch: pa.RecordBatch):
        """Runs of positions at distances [RUN * s, RUN * s + RUN) from the anchor."""
        prefix, at, row, lo, more, back, done = _asked(batch)
        anchor = at[row] + lo + back
        low, high = (back - more) // RUN, back // RUN
        order = np.repeat(np.arange(len(row)), high - low + 1)
        run = low[order] + np.arange(len(order)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
        near = np.maximum(run * RUN, (back - more)[order])
        far = np.minimum(run * RUN + RUN - 1, back[order])
        a = anchor[order]
        common = mix(prefix.of(a - run * RUN, a - run * RUN - RUN + 1 + length) ^ mix(run.astype(_U) + _U(1)))
        stretch = mix(prefix.of(a - far, a - near + length) ^ mix(near.astype(_U) * _U(length + 1) + far.astype(_U)))
        index = pa.array(row[order])
        start = lo[order] + back[order] - far
        yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), _int(start), _int(far - near), _int(far), pa.array(done[order]), _signed(common), _signed(stretch)], names)

    runs_left = stored(map_batches(_with_texts(rows, left), runs, schema), "runs")
    more_decided, left = _settle(runs_left)

    def positions(batch: pa.RecordBatch):
        prefix, at, row, lo, more, back, done = _asked(batch)
        order = np.repeat(np.arange(len(row)), more + 1)
        step = np.arange(len(order)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
        p = lo[order] + step
        s = at[row[order]] + p
        index = pa.array(row[order])
        half = length // 2
        yield pa.RecordBatch.from_arrays([batch.column(0).take(index), batch.column(1).take(index), _int(p), pa.array(done[order]), _signed(prefix.of(s, s + half)), _signed(prefix.of(s + half, s + length))], ["k", "v", "lo", "done", "first", "second"])

    ranked = stored(map_batches(_with_texts(rows, left), positions, "k long, v long, lo int, done boolean, first long, second long"), "ranks")
    met = ranked.groupBy("first", "second").agg(F.count("*").alias("n")).where("n > 1").select("first", "second")
    single = ranked.where("not done").join(met, ["first", "second"], "left_semi").select("k", "v", "lo", F.col("lo").alias("hi"))
    return decided.unionByName(more_decided).unionByName(single).groupBy("k", "v").agg(F.collect_set(F.struct("lo", "hi")).alias("starts"))


def _int(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32))


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decided position ranges (k, v, lo, hi), and one row of each stretch of
    the ranks that have an undecided stretch beside others. ``done`` rows are
    there for comparison only."""
    stretches = rows.groupBy("rank", "stretch").agg(F.count("*").alias("n"), F.min(F.struct("k", "v", "lo", "more", "back", "done")).alias("one"))
    stretches = stored(stretches, "stretches")
    twice = stretches.where("n > 1").select("rank", "stretch")
    decided = rows.where("not done").join(twice, ["rank", "stretch"], "left_semi").select("k", "v", "lo", (F.col("lo") + F.col("more")).alias("hi"))
    known = F.col("one.done") | (F.col("n") > 1)
    mixed = stretches.groupBy("rank").agg(F.count("*").alias("m"), F.bool_and(known).alias("known")).where("m > 1 and not known").select("rank")
    left = stretches.join(mixed, "rank").select("one.k", "one.v", "one.lo", "one.more", "one.back", known.alias("done"))
    return decided, left


def _with_texts(rows: DataFrame, left: DataFrame) -> DataFrame:
    """The texts that ``left`` asks about, each with its list (no longer than
    the text)."""
    asked = left.groupBy("k", "v").agg(F.collect_list(F.struct("lo", "more", "back", "done")).alias("asked"))
    return rows.join(asked.hint("shuffle_hash"), ["k", "v"]).select("k", "v", "text", "asked")


def _asked(batch: pa.RecordBatch) -> tuple:
    texts = text_bytes(batch.column(2))
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    asked = batch.column(3)
    flat = asked.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(asked.offsets.to_numpy()))
    lo, more, back = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
    return PrefixHash(np.frombuffer(b"".join(texts), np.uint8)), at, row, lo, more, back, flat.field(3).to_numpy(zero_copy_only=False)


def remove_repeats(docs: DataFrame, length: int = 200, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row."""
    rows = _keyed(docs, doc_id, text)
    starts = stored(repeated_spans(docs, length, doc_id, text, head), "starts")
    both = rows.join(starts.hint("shuffle_hash"), ["k", "v"], "left").select("doc_id", "text", "starts")

    def cut(batch: pa.RecordBatch):
        out = []
        for raw, spans in zip(text_bytes(batch.column(1)), batch.column(2), strict=True):
            if not spans.is_valid:
                out.append((len(raw), 0, 0, raw))
                continue
            flat = spans.values
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, flat.field(0).to_numpy(), 1)
            np.add.at(edge, flat.field(1).to_numpy().astype(np.int64) + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            buf = np.frombuffer(raw, np.uint8)
            runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
            out.append((len(raw), int(gone.sum()), runs, buf[~gone].tobytes()))
        columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return map_batches(both, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
