"""Near-duplicate documents with HyperMinHash.

A document's set is its distinct shingles of ``shingle`` words. Each shingle
hash falls in one of ``BUCKETS`` buckets; a bucket keeps its least value as a
16-bit register: leading zeros (6 bits, plus one; 0 is empty) and the next
``MANTISSA`` bits. A bucket that no shingle of a small set falls in takes the
least of all its shingles under a hash of the bucket's own, as 16 bits: left
empty, a band of such a set would hold one shingle or two, and all small
documents with one common phrase would be candidates. So every register of two
sets agrees with the probability of their similarity, whatever their sizes.
Bands of ``ROWS`` registers are hashed; documents that agree on a band are
candidates. A pair at the threshold 0.8 misses all 48 bands with probability
(1 - 0.8**6)**48 < 1e-6.

Work stays linear in a group of copies. Documents with the same sequence of
words are one class. In a band shared by many classes a few hubs stand for the
others (``HUBS`` orders, dealt over the bands, so that a class meets several):
pass 1 compares members with hubs only and contracts the links found. Pass 2
covers the rest exactly: in every band whose members are still in several
components, the members outside its largest component are compared with all
members of other components. Bands of up to ``SMALL`` members do so by a join on
the band; larger ones bring the members of all bands with the same largest
component together once, in blocks of about ``BLOCK`` members or ``BLOCK_SHINGLES``
shingles, and compare blocks with blocks of outside members inside a task, so no
pair is shuffled. Candidates first pass the collision-corrected
estimate with a margin of six standard errors; links are confirmed on full sets.

Defined results: null and empty texts and texts without words have empty sets
and link with nothing; a text with fewer words than a shingle has its whole
sequence as its one shingle; repeated rows come back as often as they came and
share a class; an id that carries several texts is one document, so it joins
the groups of all its texts (but not of an empty one); rows of null id link like
others, take the smallest id of their group as component and aren't kept, unless
the group has no id at all (null component, kept); an empty table gives no rows.
Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import GROUP_BYTES, PrefixHash, map_batches, mix, stored, text_bytes
from touchline.llm.components import connected_components

BUCKETS = 288
ROWS = 6
BANDS = BUCKETS // ROWS
MANTISSA = 10
VALUE_BITS = 40
HUBS = 6
SMALL = 32
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21

_U = np.uint64
#: Odd multipliers, one for each bucket.
FILL = mix(np.arange(1, BUCKETS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)).astype(np.uint32) | np.uint32(1)


def normal_words(text: bytes) -> bytes:
    """A-Z in lower case, words joined by single spaces."""
    return b" ".join(text.lower().split())


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each normalised text."""
    raw = b" ".join(texts) + b" "
    buf = np.frombuffer(raw, np.uint8)
    starts = np.flatnonzero(np.concatenate(([True], buf[:-1] == 32)) & (buf != 32))
    ends = np.flatnonzero((buf == 32) & np.concatenate(([False], buf[:-1] != 32)))
    h = PrefixHash(buf).of(starts, ends)
    n = np.array([t.count(b" ") + 1 if t else 0 for t in texts])
    at = np.concatenate(([0], np.cumsum(n)))
    together = np.zeros(max(len(h) - shingle + 1, 0), _U)
    for i in range(shingle):
        together = together * _U(0xD6E8FEB86659FD93) + h[i : i + len(together)]
    together = mix(together)
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        if b - a >= shingle:
            out.append(np.unique(together[a : b - shingle + 1]))
        elif b > a:
            whole = np.array([b - a], _U)
            for i in range(a, b):
                whole = mix(whole * _U(0x9FB21C651E98DF25) + h[i : i + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, _U))
    return out


def sets_in_pieces(texts: list[bytes], shingle: int, group_bytes: int = GROUP_BYTES) -> list[np.ndarray]:
    """``shingle_sets`` of about ``group_bytes`` of text at a time: its work
    arrays take some 35 times the bytes that it gets at once."""
    size = np.array([len(t) for t in texts], np.int64)
    piece = (np.cumsum(size) - size) // group_bytes
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    return [s for a, b in zip(cuts, cuts[1:], strict=False) for s in shingle_sets(texts[a:b], shingle)]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, BUCKETS) HyperMinHash registers; only empty sets have empty ones."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), BUCKETS), np.uint16)
    if not sizes.sum():
        return out
    h = mix(np.concatenate(sets) ^ _U(0x5851F42D4C957F2D))
    bucket = ((h >> _U(32)) * _U(BUCKETS)) >> _U(32)
    value = mix(h ^ _U(0x2545F4914F6CDD1D)) >> _U(64 - VALUE_BITS)
    slot = np.repeat(np.arange(len(sets), dtype=_U), sizes) * _U(BUCKETS) + bucket
    packed = np.sort((slot << _U(VALUE_BITS)) | value)
    slot = packed >> _U(VALUE_BITS)
    first = np.concatenate(([True], slot[1:] != slot[:-1]))
    least = packed[first] & _U((1 << VALUE_BITS) - 1)
    bits = np.frexp(least.astype(np.float64))[1]  # bit length; 0 for 0
    zeros = VALUE_BITS - bits
    top = np.maximum(bits - 1, 0).astype(_U)
    rest = least & ~(_U(1) << top)  # below the leading one
    down = np.maximum(top.astype(np.int64) - MANTISSA, 0).astype(_U)
    up = np.maximum(MANTISSA - top.astype(np.int64), 0).astype(_U)
    out.ravel()[slot[first].astype(np.int64)] = ((zeros + 1) << MANTISSA) | ((rest >> down) << up).astype(np.int64)
    # small sets leave buckets empty: each of these takes the least of all shingles under its own multiplier
    ends, low = np.cumsum(sizes), h.astype(np.uint32)
    for i in np.flatnonzero((sizes > 0) & (out == 0).any(1)):
        empty = np.flatnonzero(out[i] == 0)
        least = (low[ends[i] - sizes[i] : ends[i], None] * FILL[empty]).min(0)
        out[i, empty] = np.maximum(mix(least.astype(_U)) >> _U(48), _U(1))
    return out


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, band, key) of every band with a register that isn't empty."""
    bands = regs.reshape(len(regs), BANDS, ROWS).astype(_U)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), bands.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + bands[:, :, i] + _U(1))
    row, band = np.nonzero(bands.any(2))
    return row, band, key[row, band].astype(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, corrected for the expected number of
    registers that agree by chance, and the number of registers used."""
    used = ((a != 0) | (b != 0)).sum(1)
    agree = ((a == b) & (a != 0)).sum(1)
    ratio = np.maximum(n_a, n_b) / np.maximum(np.minimum(n_a, n_b), 1)
    # two least values fall in one register by chance: about 0.17 * 2**-MANTISSA * 4r / (1 + r)**2 of the buckets
    chance = 0.169919 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2 * ((a != 0) & (b != 0)).sum(1)
    return np.maximum(agree - chance, 0) / np.maximum(used, 1), used


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row. Documents are
    linked if 100 * |A & B| >= percent * |A | B|; ``component_id`` is the
    smallest doc_id reachable, ``kept`` marks it."""
    # a row is found again by its id and the hashes of its text
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumns({"h": F.xxhash64("text"), "g": F.hash("text")})

    def sketch(batch: pa.RecordBatch):
        texts = [normal_words(x) for x in text_bytes(batch.column(1))]
        sets = shingle_sets(texts, shingle)
        regs = registers(sets)
        columns = [
            batch.column(0),
            batch.column(2),
            batch.column(3),
            pa.array([hashlib.md5(t).digest() if t else None for t in texts], pa.binary()),
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([r.tobytes() for r in regs], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "g", "sequence", "n", "regs"])

    sketches = stored(map_batches(rows, sketch, "doc_id long, h long, g int, sequence binary, n long, regs binary"), "sketches")
    # one class, numbered when written, for each sequence of words; one of its rows speaks for it
    members = sketches.where("sequence is not null")
    speaker = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "g")).alias("of")
    classes = members.groupBy("sequence").agg(speaker, F.first("n").alias("n"), F.first("regs").alias("regs"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    def bands(batch: pa.RecordBatch):
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BUCKETS)
        row, band, key = band_keys(regs)
        ids = batch.column(0).to_numpy()[row]
        # the order that picks a band's hub: one of HUBS
        order = mix(ids.astype(_U) + _U(0x9E3779B97F4A7C15) * (band % HUBS + 1).astype(_U)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), pa.array(order)], ["band", "id", "ord"])

    banded = map_batches(classes.select("id", "regs"), bands, "band long, id long, ord long")
    hubs = banded.groupBy("band").agg(F.min(F.struct("ord", "id")).alias("hub"), F.count("*").alias("m")).where("m > 1").select("band", F.col("hub.id").alias("hub"))
    shared = stored(banded.select("band", "id").join(hubs, "band"), "bands")

    # texts of the classes that share a band: the only ones compared
    bare = _texts_of(rows, classes.join(shared.select("id").distinct(), "id", "left_semi").select("id", "of.doc_id", "of.h", "of.g"), members)

    first = shared.where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    links = _confirm(first, classes, bare, shingle, percent)
    linked = connected_components(links)

    # what the hubs didn't settle
    placed = shared.select("band", "id").join(linked, F.col("id") == F.col("vertex"), "left").select("band", "id", F.coalesce("component", "id").alias("component"))
    counts = placed.groupBy("band", "component").agg(F.count("*").alias("m"))
    largest = counts.groupBy("band").agg(F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("parts"), F.sum("m").alias("size")).where("parts > 1").select("band", F.col("top.component").alias("top"), "size")
    open_rows = stored(placed.join(largest, "band"), "open-bands")
    little = open_rows.where(F.col("size") <= SMALL)
    outside = little.where("component <> top")
    rest = outside.alias("x").join(little.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.top")) | (F.col("x.id") < F.col("y.id"))))
    rest = rest.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    rest = rest.join(first, ["a", "b"], "left_anti")
    large = _compare_blocks(open_rows.where(F.col("size") > SMALL), classes, bare, shingle, percent)
    more = _confirm(rest, classes, bare, shingle, percent)
    parts = connected_components(links.unionByName(more).unionByName(large).unionByName(_same_document(members, classes)))

    grouped = classes.join(parts, F.col("id") == F.col("vertex"), "left").select("sequence", "of.doc_id", F.coalesce("component", "id").alias("group"))
    smallest = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    found = grouped.select("sequence", "group").join(smallest, "group").select("sequence", "component_id")
    out = sketches.select("doc_id", "n", "sequence").join(found, "sequence", "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.when(F.col("doc_id").isNull(), component.isNull()).otherwise(F.col("doc_id") == component)
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def _same_document(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one id's texts."""
    named = members.where("doc_id is not null")
    s = F.xxhash64("sequence")
    several = named.groupBy("doc_id").agg(F.min(s).alias("low"), F.max(s).alias("high")).where("low <> high").select("doc_id")
    theirs = stored(named.join(several, "doc_id", "left_semi").select("doc_id", "sequence").distinct(), "several-texts")
    theirs = theirs.join(classes.select("sequence", "id"), "sequence")
    return theirs.join(theirs.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b"))


def _texts_of(rows: DataFrame, speakers: DataFrame, members: DataFrame) -> DataFrame:
    """(id, text) of the classes of ``speakers``, one shuffle of the texts."""
    t, k = rows.alias("t"), speakers.hint("shuffle_hash").alias("k")
    same = F.col("t.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("t.h") == F.col("k.h")) & (F.col("t.g") == F.col("k.g"))
    found = t.where("t.text is not null").join(k, same).select("k.id", "t.text")
    if members.groupBy("doc_id", "h", "g").count().where("count > 1").limit(1).count():  # rows that repeat
        found = found.groupBy("id").agg(F.first("text").alias("text"))
    return stored(found, "texts")


def _compare_blocks(rows: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of members outside a band's largest component with members
    of other components, for ``rows`` (id, component, top). A member needs one
    link with each other component."""
    arena = rows.groupBy("top", "id").agg(F.first("component").alias("component")).join(classes.select("id", "n"), "id")
    out = F.col("component") != F.col("top")
    sizes = arena.groupBy("top").agg(F.count("*").alias("m"), F.sum("n").alias("s"), F.count_if(out).alias("m_out"), F.sum(F.when(out, F.col("n")).otherwise(0)).alias("s_out"))
    blocks = lambda m, s: F.greatest(F.ceil(F.col(m) / BLOCK), F.ceil(F.col(s) / BLOCK_SHINGLES)).cast("int")
    arena = arena.join(sizes, "top").select("top", "id", "component", blocks("m", "s").alias("p"), blocks("m_out", "s_out").alias("q"))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = arena.select("top", "id", "component", dealt("p").alias("x"), every("q").alias("y"), F.lit(False).alias("out"))
    outer = arena.where("component <> top").select("top", "id", "component", every("p").alias("x"), dealt("q").alias("y"), F.lit(True).alias("out"))
    full = inner.unionByName(outer).join(classes.select("id", "n", "regs"), "id").join(texts, "id").select("top", "x", "y", "id", "component", "out", "n", "regs", "text")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["id", "out"])
        ids, component, n = group.id.to_numpy(), group.component.to_numpy(), group.n.to_numpy()
        # a class that stands on both sides has one set
        _, first, own = np.unique(ids, return_index=True, return_inverse=True)
        sets = sets_in_pieces([normal_words(group.text.iat[i].encode()) for i in first], shingle)
        size = np.array([len(x) for x in sets])
        start = np.cumsum(size) - size
        # numbered shingles: one lookup of many sets in a set's marks counts what they share
        numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
        marks = np.zeros(len(numbers) + 1, np.bool_)
        regs = np.frombuffer(b"".join(group.regs), np.uint16).reshape(-1, BUCKETS)
        inside = np.flatnonzero(~group.out.to_numpy())
        t = percent / 100
        found = []
        for i in np.flatnonzero(group.out.to_numpy()):
            j = inside[(component[inside] != component[i]) & (100 * np.minimum(n[inside], n[i]) >= percent * np.maximum(n[inside], n[i]))]
            if not len(j):
                continue
            guess, used = estimate(regs[i][None, :], regs[j], n[i], n[j])
            j = j[guess >= t - 6 * np.sqrt(t * (1 - t) / used)]
            if not len(j):
                continue
            mine = numbers[start[own[i]] : start[own[i]] + size[own[i]]]
            marks[mine] = True
            length = size[own[j]]
            at = np.cumsum(length) - length
            theirs = numbers[np.repeat(start[own[j]] - at, length) + np.arange(length.sum())]
            both_n = np.add.reduceat(marks[theirs], at, dtype=np.int64)
            marks[mine] = False
            j = j[100 * both_n >= percent * (len(mine) + length - both_n)]
            # one link with each other component
            for k in j[np.unique(component[j], return_index=True)[1]]:
                found.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return stored(full.groupBy("top", "x", "y").applyInPandas(compare, "a long, b long"), "block-links")


def _confirm(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate and then whose full sets reach percent."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"r_{x}"))
    # sizes alone bound the similarity
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def likely(batch: pa.RecordBatch):
        got = {f: batch.column(i) for i, f in enumerate(("a", "b", "n_a", "n_b", "r_a", "r_b"))}
        regs = [np.frombuffer(b"".join(got[k].to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in ("r_a", "r_b")]
        j, used = estimate(*regs, got["n_a"].to_numpy(), got["n_b"].to_numpy())
        t = percent / 100
        keep = np.flatnonzero(j >= t - 6 * np.sqrt(t * (1 - t) / used))
        yield pa.RecordBatch.from_arrays([got["a"].take(pa.array(keep)), got["b"].take(pa.array(keep))], ["a", "b"])

    survivors = map_batches(near.select("a", "b", "n_a", "n_b", "r_a", "r_b"), likely, "a long, b long")
    sided = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t_{x}"))
    both = survivors.join(sided("b"), "b").join(sided("a"), "a").select("a", "b", "t_a", "t_b")

    def confirmed(batch: pa.RecordBatch):
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        text: dict[int, bytes] = {}
        for ids, column in ((a, 2), (b, 3)):
            text.update(zip(ids, text_bytes(batch.column(column)), strict=True))
        sets = dict(zip(text, shingle_sets([normal_words(x) for x in text.values()], shingle), strict=True))
        keep = []
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            both_n = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both_n >= percent * (len(sets[x]) + len(sets[y]) - both_n):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    return stored(map_batches(both, confirmed, "a long, b long"), "links")
