"""Token ids in patched frame-of-reference files.

Documents are encoded with a given tokenizer, an end id follows each, and the
ids are written in ascending document order. The stream is cut into blocks of
``BLOCK`` ids. A block stores its minimum, a bit width chosen as the given
percentile of the bit lengths of (id - minimum), all offsets packed at that
width, and the offsets that need more bits whole in an exception list
(positions, values). An index gives the byte at which every block starts, so
any block is decoded alone.

Container: Parquet rows, so that Spark's commit protocol decides which task's
output counts when an executor is lost, and so that the files may be in any
store that Spark reaches. One row is a segment: consecutive whole documents of
about ``SEGMENT_IDS`` ids (one longer document is a segment of its own), with
its document index, its block index and its blocks. Segments of one write task
form a shard; shards ascend in document order.

Defined results: null text is empty and yields the end id alone; rows with
equal ids are ordered by their text's hash and are all written; null ids come
first; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import kept, ship_package, split_batch

BLOCK = 1024
SEGMENT_IDS = 1 << 20
PERCENTILE = 0.9
#: Chunks whose ids a worker keeps (bounds its memory, not the result).
CACHE_CHUNKS = 600_000
#: Characters of chunks after which it forgets them (long chunks).
CACHE_CHARS = 16 << 20
#: Chunks in one line asked of the library.
JOINED = 200
#: Text bytes encoded together.
GROUP_BYTES = 4 << 20

SEGMENT = "shard int, segment int, shard_start long, n_ids long, doc_ids array<long>, n_tokens array<long>, block_starts binary, blocks binary"


# --- blocks -------------------------------------------------------------------


def _pack(v: np.ndarray, width: int) -> np.ndarray:
    """(rows, BLOCK) offsets below 2**width -> (rows, bytes): bit j * width is
    where offset j starts, in little-endian 64-bit words."""
    rows = len(v)
    words = np.zeros((BLOCK // 64 * width, rows), np.uint64)
    lanes = np.ascontiguousarray(v.T).astype(np.uint64).reshape(BLOCK // 64, 64, rows)
    out = words.reshape(BLOCK // 64, width, rows)
    for j in range(64 if width else 0):
        at, shift = divmod(j * width, 64)
        out[:, at] |= lanes[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, at + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    rows = len(words)
    got = np.zeros((BLOCK // 64, 64, rows), np.uint64)
    if width:
        src = np.ascontiguousarray(words.T).reshape(BLOCK // 64, width, rows)
        mask = np.uint64((1 << width) - 1)
        for j in range(64):
            at, shift = divmod(j * width, 64)
            x = src[:, at] >> np.uint64(shift)
            if shift + width > 64:
                x = x | (src[:, at + 1] << np.uint64(64 - shift))
            got[:, j] = x & mask
    return np.ascontiguousarray(got.reshape(BLOCK, rows).T)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, bytes]:
    """(block starts as little-endian 64-bit offsets, blocks). A block is
    <u4 minimum, u2 width, u2 exceptions>, packed words, exception positions
    (u2), exception offsets (u4). The last block is padded with its minimum."""
    n = len(ids)
    if not n:
        return b"", b""
    k = -(-n // BLOCK)
    v = np.empty(k * BLOCK, np.int64)
    v[:n] = ids
    v[n:] = v[(k - 1) * BLOCK : n].min()
    v = v.reshape(k, BLOCK)
    low = v.min(1)
    v = v - low[:, None]
    bits = np.frexp(v.astype(np.float64))[1]
    width = np.sort(bits, axis=1)[:, int(percentile * (BLOCK - 1))]
    patched = bits > width[:, None]
    packed: list[bytes] = [b""] * k
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        words = _pack(np.where(patched[rows], 0, v[rows]), int(w))
        for r, x in zip(rows.tolist(), words, strict=True):
            packed[r] = x.tobytes()
    n_patched = patched.sum(1)
    row, pos = np.nonzero(patched)
    at = np.concatenate(([0], np.cumsum(n_patched)))
    value = v[row, pos].astype("<u4")
    pos = pos.astype("<u2")
    out = [
        struct.pack("<IHH", low[r], width[r], n_patched[r]) + packed[r] + pos[at[r] : at[r + 1]].tobytes() + value[at[r] : at[r + 1]].tobytes()
        for r in range(k)
    ]
    starts = np.concatenate(([0], np.cumsum([len(x) for x in out])[:-1])).astype("<u8")
    return starts.tobytes(), b"".join(out)


def decode_blocks(starts: bytes, blocks: bytes, n_ids: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks first..last-1 (all by default), found by the block index."""
    at = np.frombuffer(starts, "<u8").astype(np.int64)[first:last]
    if not len(at):
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(blocks, np.uint8)
    head = raw[at[:, None] + np.arange(8)]
    low = head[:, :4].copy().view("<u4").ravel().astype(np.int64)
    width = head[:, 4:6].copy().view("<u2").ravel().astype(np.int64)
    n_patched = head[:, 6:8].copy().view("<u2").ravel().astype(np.int64)
    v = np.empty((len(at), BLOCK), np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        size = BLOCK // 8 * int(w)
        words = raw[at[rows][:, None] + 8 + np.arange(size)].view("<u8") if size else np.zeros((len(rows), 0), np.uint64)
        v[rows] = _unpack(words, int(w)).astype(np.int64)
    if n_patched.any():
        r = np.repeat(np.arange(len(at)), n_patched)
        i = np.arange(len(r)) - np.repeat(np.cumsum(n_patched) - n_patched, n_patched)
        p0 = at[r] + 8 + BLOCK // 8 * width[r]
        pos = raw[(p0 + 2 * i)[:, None] + np.arange(2)].copy().view("<u2").ravel()
        value = raw[(p0 + 2 * n_patched[r] + 4 * i)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        v[r, pos] = value
    v += low[:, None]
    return v.ravel()[: n_ids - first * BLOCK].astype(np.uint32)


# --- tokens -------------------------------------------------------------------


def _byte_table(kinds: dict[int, bytes | range]) -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    for kind, members in kinds.items():
        table[list(members)] = kind
    return table


# What a byte tells of its character. HIGH begins a character beyond ASCII that
# isn't white space, ODD one that may be, LATIN one of U+00C0 to U+01FF, which
# are letters but for two signs. Controls and continuation bytes are OTHER.
OTHER, SPACE, NEWLINE, LETTER, DIGIT, SIGN, QUOTE, HIGH, ODD, LATIN = range(10)
KIND = _byte_table({
    SIGN: range(33, 127),
    LETTER: b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    DIGIT: b"0123456789",
    QUOTE: b"'",
    SPACE: b" ",
    NEWLINE: b"\n",
    HIGH: range(0xC8, 0xF5),
    ODD: b"\xc2\xe1\xe2\xe3",
    LATIN: range(0xC3, 0xC8),
})
#: A word of the pattern by itself: one run of letters, digits or signs.
WORD = re.compile(r" ?(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u01ff]+|[0-9]+|[!-/:-@\[-`{-~]+)")
#: White space at a chunk's edge, and two characters that old Unicode counts as such.
LOOSE = re.compile(r"(?! ?[^\s\u180e\u200b])|.*[\s\u180e\u200b]\Z", re.DOTALL)


def cut_words(data: np.ndarray, text_at: np.ndarray) -> np.ndarray:
    """Ascending starts of the chunks of texts (UTF-8; text i is
    data[text_at[i]:text_at[i + 1]]), each text's start among them.

    Cuts lie where the byte-level pattern always ends one word and begins the
    next: before a space that no white space follows, around a single line end,
    and between letters, digits and signs, but not after an apostrophe, which
    may belong to the letters behind it."""
    if not len(data):
        return text_at[:-1]
    kind = KIND[data]
    lead = np.flatnonzero(kind == LATIN)
    second = data[lead + 1]
    letter = (data[lead] != 0xC3) | ((second != 0x97) & (second != 0xB7))
    kind[lead] = np.where(letter, LETTER, HIGH)
    kind[lead[letter] + 1] = LETTER
    plain = (kind >= LETTER) & (kind <= QUOTE)
    # text edges are no neighbours
    inner = np.ones(len(data) + 1, bool)
    inner[text_at] = False
    sort = np.where(kind == QUOTE, SIGN, kind).astype(np.uint8)
    turn = plain[:-1] & plain[1:] & (sort[:-1] != sort[1:]) & ~((kind[:-1] == QUOTE) & (kind[1:] == LETTER))
    single = np.flatnonzero((kind[1:-1] == NEWLINE) & plain[:-2] & plain[2:]) + 1
    single = single[inner[single] & inner[single + 1]]
    space = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] >= LETTER))
    space = space[inner[space + 1]]
    odd = np.flatnonzero(kind[space + 1] == ODD)
    if len(odd):
        code = data[np.minimum(space[odd, None] + np.arange(1, 4), len(data) - 1)].astype(np.int64)
        first, two, three = code[:, 0], code[:, 0] << 8 | code[:, 1], code[:, 0] << 16 | code[:, 1] << 8 | code[:, 2]
        blank = np.where(first == 0xC2, (two == 0xC285) | (two == 0xC2A0), np.isin(three, BLANKS))
        space = np.delete(space, odd[blank])
    at = np.zeros(len(data) + 1, bool)
    at[1:-1] = turn
    at[space] = at[single] = at[single + 1] = True
    at &= inner
    return np.sort(np.concatenate([np.flatnonzero(at), text_at[:-1]]), kind="stable")


#: Characters of three bytes that are white space, or were in old Unicode.
BLANKS = [int.from_bytes(chr(c).encode()) for c in (0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


class ChunkEncoder:
    """Ids of whole texts by a tokenizer of the tokenizers library that splits
    words by the byte-level pattern.

    A text cut where that pattern always cuts (``cut_words``) encodes to the ids
    of its chunks, one after the other; a worker asks the library for each
    distinct chunk once and joins the answers. Most chunks are one word of the
    pattern: they go to the library's model behind a splitter at white space,
    as their words are known. The others go through the whole tokenizer, in
    lines of many chunks where their edges allow it. Byte lengths of the ids
    tell which are whose.
    """

    def __init__(self, tokenizer_file: str, limit: int = CACHE_CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        splitter = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer or not isinstance(splitter, pre_tokenizers.ByteLevel) or splitter.add_prefix_space or not splitter.use_regex:
            raise ValueError("the tokenizer doesn't split words by the byte-level pattern")
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.limit = limit
        # a byte-level vocabulary has one character a byte: itself if it can be seen, else one from U+0100 on
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.shown = np.arange(256, dtype="<u4")
        self.shown[np.setdiff1d(np.arange(256), seen)] = 256 + np.arange(256 - len(seen))
        self.shown[ord("\n")] = ord(" ")  # between words
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.uint32)
        self.n_ids = self.held = 0

    def _library(self, tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text)."""
        found = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)

    def _joined(self, chunks: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each chunk, asked in lines of many chunks."""
        raw = ["\n".join(chunks[a : a + JOINED]) for a in range(0, len(chunks), JOINED)]
        size = np.array([len(c) if c.isascii() else len(c.encode()) for c in chunks], np.int64)
        if words:
            ids, _ = self._library(self.words, [self.shown[np.frombuffer(x.encode(), np.uint8)].tobytes().decode("utf-32-le") for x in raw])
        else:
            ids, n = self._library(self.tokenizer, [x + "\n" for x in raw])
            size += 1  # the line end
        done = np.cumsum(self.n_bytes[ids])
        ends = np.cumsum(size)
        last = np.searchsorted(done, ends)
        if len(ends) and (last[-1] != len(ids) - 1 or (done[last] != ends).any()):
            raise ValueError("the tokenizer doesn't split words by the byte-level pattern")
        n = np.diff(last, prepend=-1)
        if not words:
            if (self.n_bytes[ids[last]] != 1).any():
                raise ValueError("the tokenizer doesn't split words by the byte-level pattern")
            ids, n = np.delete(ids, last), n - 1
        return ids, n

    def _learn(self, chunks: list[str]) -> None:
        """Ask the library for chunks that aren't known."""
        words, lines, alone = [], [], []
        for c in chunks:
            (words if WORD.fullmatch(c) else alone if LOOSE.match(c) else lines).append(c)
        for part, (ids, n) in ((words, self._joined(words, True)), (lines, self._joined(lines, False)), (alone, self._library(self.tokenizer, alone))):
            first, end = len(self.known), self.n_ids + len(ids)
            self.known.update(zip(part, range(first, first + len(part)), strict=True))
            while len(self.start) < len(self.known):
                self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
            if len(self.ids) < end:
                self.ids = np.concatenate([self.ids[: self.n_ids], np.zeros(2 * end - self.n_ids, np.uint32)])
            self.ids[self.n_ids : end] = ids
            self.start[first : len(self.known)] = self.n_ids + np.cumsum(n) - n
            self.length[first : len(self.known)] = n
            self.n_ids = end
        self.held += sum(map(len, chunks))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (no nulls) as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        if len(self.known) > self.limit or self.held > CACHE_CHARS:
            self._forget()
        text_at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[text_at[0] : text_at[-1]]
        text_at = text_at - text_at[0]
        at = cut_words(data, text_at).astype(np.int32)
        cut = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, text_at[-1:])), pa.py_buffer(data))
        coded = cut.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        self._learn([c for c in distinct if c not in known])
        place = np.array([known[c] for c in distinct], np.int64)[coded.indices.to_numpy()]
        n = self.length[place]
        before = np.cumsum(n) - n
        total = int(n.sum())
        ids = self.ids[np.repeat(self.start[place] - before, n) + np.arange(total)].tobytes()
        # an empty text's chunk stands before the chunk of the next text at the same place
        first = np.searchsorted(at, text_at[:-1])
        first += np.arange(len(first)) - np.searchsorted(text_at[:-1], text_at[:-1])
        cuts = [*(4 * np.append(before, total)[first]).tolist(), 4 * total]
        return [ids[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]


def _encoder(tokenizer_file: str) -> ChunkEncoder:
    """One for each worker process, kept between its tasks."""
    encoders = kept(__name__)
    if tokenizer_file not in encoders:
        encoders[tokenizer_file] = ChunkEncoder(tokenizer_file)
    return encoders[tokenizer_file]


# --- files --------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text", shards: int | None = None) -> None:
    """Encode, order and write (one range shuffle of the texts)."""
    spark = docs.sparkSession
    ship_package(spark)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("block_starts", pa.binary()), ("blocks", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file)
        shard = TaskContext.get().partitionId()
        end = struct.pack("<I", end_id)
        names: list[int | None] = []
        counts: list[int] = []
        parts: list[bytes] = []
        held = start = segment = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            index, blocks = encode_blocks(ids)
            values = ([shard], [segment], [start], [len(ids)], [names], [counts], [index], [blocks])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for piece in split_batch(batch, GROUP_BYTES):
                for name, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1)), strict=True):
                    names.append(name)
                    counts.append(len(ids) // 4 + 1)
                    parts += (ids, end)
                    held += counts[-1]
                    if held >= SEGMENT_IDS:
                        yield flush()
                        segment, start = segment + 1, start + held
                        names, counts, parts, held = [], [], [], 0
        if names:
            yield flush()

    ordered.mapInArrow(run, SEGMENT).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every written document, from the
    files: ``start`` counts the ids of all documents before it."""
    ship_package(spark)
    files = spark.read.schema(SEGMENT).parquet(path)
    # one row a shard, of three numbers: the write tasks bound it, not the documents
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, start, n_ids, doc_ids, n_tokens, index, blocks = (batch.column(k)[i].as_py() for k in range(7))
                raw = memoryview(decode_blocks(index, blocks, n_ids).astype("<u4").tobytes())
                at = np.concatenate(([0], np.cumsum(n_tokens)))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(crc), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(at[:-1] + start), pa.array(n_tokens, pa.int64()), pa.array(crc, pa.int64())], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    found = files.select("shard", "shard_start", "n_ids", "doc_ids", "n_tokens", "block_starts", "blocks").mapInArrow(run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(before), "shard").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
