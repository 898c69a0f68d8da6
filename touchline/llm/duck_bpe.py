"""Byte-level BPE encoding and decoding with DuckDB recursive queries.

Inside every Spark task an in-process DuckDB connection holds the merge table:
(left id, right id) -> merged id, whose number is its rank. Texts are split
into words by the given pattern. Distinct words start as rows of byte tokens;
a recursive query unnests every unfinished word into token-position rows, joins
neighbouring pairs with the merge table, contracts the leftmost pair of least
rank in each word, and goes on until no word has a pair left. Decoding joins
the ids of whole texts with the vocabulary and concatenates their bytes by an
ordered aggregation.

A worker keeps words and chunks it has met (bounded numbers, forgotten
together), and long texts and large sets of new words go through in slices, so
that neither a query nor the worker grows with a text. A word that is itself in
the vocabulary is one id from the start. One contraction a round takes time
quadratic in the word's length, so words of more than ``LONG_WORD`` bytes
(unbroken runs) are encoded by the tiktoken library from the same ranks; the
result is the same.

Defined results: null text is empty; an empty text has no ids and decodes to no
bytes; rows are never dropped or merged, so repeated rows and null ids come
back as they are; an empty table gives no rows. Only the id and text columns
are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import kept, map_batches

#: Entries each of a worker's two caches may hold (bounds memory, not results).
CACHE_WORDS = 200_000
LONG_WORD = 400
#: Characters of a text taken at once, and new words asked of one query.
PIECE_CHARS = 1 << 20
ASKED = 20_000
#: Text bytes encoded together: the more, the fewer queries.
GROUP_BYTES = 4 << 20

ENCODE = """
with recursive state(w, live, ids) as (
  select w, true, list(t order by p) from fresh group by w
  union all
  select s.w, b.best is not null,
         case when b.best is null then s.ids
              else s.ids[:(b.best & 1048575)] || [(b.best >> 20)::integer] || s.ids[(b.best & 1048575) + 3:] end
  from (select w, ids from state where live) s
  left join (
    select t.w, min((m.merged::bigint << 20) | (t.p - 1)) as best
    from (select w, ids, unnest(generate_series(1, len(ids) - 1)) as p from state where live) t
    join merges m on m.pair = ((t.ids[t.p]::bigint << 20) | t.ids[t.p + 1])
    group by t.w) b on b.w = s.w
)
select w, ids from state where not live order by w
"""

# the aggregate reads sorted rows; the places it returns prove that it kept their order
DECODE = "select d, string_agg(chars, ''), list(p) from (select t.d, t.p, v.chars from tokens t join vocabulary v on v.id = t.id order by t.p) group by d"
DECODE_SORTED = "select t.d, string_agg(v.chars, '' order by t.p) from tokens t join vocabulary v on v.id = t.id group by t.d"

#: Stands for the byte 0 in the vocabulary's text, where a byte is the character of its number.
_ZERO = "\u0100"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class DuckBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.pattern_text = pattern
        self.pattern = regex.compile(pattern)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})
        self.con.execute("set enable_progress_bar = false")
        pairs: list[int] = []
        merged: list[int] = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append(a << 20 | b)
                    merged.append(rank)
        table = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "chars": [t.decode("latin-1").replace("\0", _ZERO) for t in ranks]})
        self.con.register("t0", table)
        self.con.execute("create table merges as select * from t0")
        self.con.register("t1", vocabulary)
        self.con.execute("create table vocabulary as select * from t1")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes | None] = {}
        self.unclean: set[str] = set()
        self._library = None

    # --- encoding -------------------------------------------------------------

    def _learn(self, words: set[str]) -> None:
        """Put the ids of ``words`` into self.words."""
        fresh: list[bytes] = []
        names: list[str] = []
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words[word] = rank.to_bytes(4, "little")
            elif len(raw) > LONG_WORD:
                self.words[word] = np.array(self._long(word), "<u4").tobytes()
            else:
                fresh.append(raw)
                names.append(word)
        for a in range(0, len(fresh), ASKED):
            self._ask(names[a : a + ASKED], fresh[a : a + ASKED])

    def _ask(self, names: list[str], fresh: list[bytes]) -> None:
        lens = np.array([len(x) for x in fresh])
        w = np.repeat(np.arange(len(fresh), dtype=np.int32), lens)
        p = np.arange(len(w)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.con.register("fresh", pa.table({"w": w, "p": p, "t": self.byte_ids[np.frombuffer(b"".join(fresh), np.uint8)]}))
        ids = self.con.sql(ENCODE).to_arrow_table().column(1).combine_chunks()
        self.con.unregister("fresh")
        raw = ids.flatten().to_numpy().astype("<u4").tobytes()
        at = (ids.offsets.to_numpy().astype(np.int64) - ids.offsets[0].as_py()) * 4
        self.words.update(zip(names, (raw[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)), strict=True))

    def _long(self, word: str) -> list[int]:
        if self._library is None:
            import tiktoken

            self._library = tiktoken.Encoding("ranks", pat_str=self.pattern_text, mergeable_ranks=self.ranks, special_tokens={})
        return self._library._encode_single_piece(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        short = [i for i, x in enumerate(texts) if len(x) <= PIECE_CHARS]
        out = dict(zip(short, self._encode([texts[i] for i in short]), strict=True))
        return [out[i] if i in out else b"".join(self._encode([piece])[0] for piece in _pieces(x)) for i, x in enumerate(texts)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        """The pattern never joins a character to a single space after it, so
        texts are cut before every space and distinct chunks are split into
        words once; a text with a chunk that begins or ends with white space
        (a run of it) is split whole.
        """
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.chunks) > CACHE_WORDS:
            self.chunks.clear()
            self.unclean.clear()
        cut = [x.split(" ") for x in texts]
        new = {c for chunks in cut for c in chunks[1:]}.difference(self.chunks)
        split: dict[str, list[str]] = {c: self.pattern.findall(" " + c) for c in new if c and not c[0].isspace() and not c[-1].isspace()}
        self.unclean.update(c for c in new if c not in split)
        odd = [i for i, chunks in enumerate(cut) if len(chunks) > 1 and (chunks[0][-1:].isspace() or not self.unclean.isdisjoint(chunks[1:]))]
        heads = {i: self.pattern.findall(cut[i][0]) for i in range(len(texts))}
        for i in odd:
            heads[i] = self.pattern.findall(texts[i])
        wanted = {w for words in split.values() for w in words}.union(*heads.values()) if heads else set()
        self._learn(wanted.difference(self.words))
        known = self.words
        self.chunks.update(dict.fromkeys(new))
        for c, words in split.items():
            self.chunks[c] = b"".join([known[w] for w in words])
        odd_set = set(odd)
        of = self.chunks
        return [b"".join([known[w] for w in heads[i]]) + (b"" if i in odd_set else b"".join([of[c] for c in cut[i][1:]])) for i in range(len(texts))]

    # --- decoding -------------------------------------------------------------

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each list of ids stands for."""
        out: list[list[bytes]] = [[] for _ in ids]
        held: list[tuple[int, bytes]] = []
        n = 0
        for k, raw in enumerate(ids):
            for a in range(0, len(raw), 4 * PIECE_CHARS):
                held.append((k, raw[a : a + 4 * PIECE_CHARS]))
                n += len(held[-1][1]) // 4
                if n >= PIECE_CHARS:
                    self._put_together(held, out)
                    held, n = [], 0
        self._put_together(held, out)
        return [b"".join(parts) for parts in out]

    def _put_together(self, held: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        if not held:
            return
        lens = np.array([len(x) // 4 for _, x in held])
        d = np.repeat(np.arange(len(held), dtype=np.int32), lens)
        self.con.register("tokens", pa.table({"d": d, "p": np.arange(len(d), dtype=np.int32), "id": np.frombuffer(b"".join(x for _, x in held), "<u4").astype(np.int32)}))
        found = self.con.sql(DECODE).to_arrow_table()
        place = found.column(2).combine_chunks().flatten().to_numpy()
        if (np.diff(place)[np.diff(d[place]) == 0] < 0).any():  # not in the order they were sorted
            found = self.con.sql(DECODE_SORTED).to_arrow_table()
        self.con.unregister("tokens")
        for k, x in sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True)):
            out[held[k][0]].append(x.replace(_ZERO, "\0").encode("latin-1"))


def _pieces(text: str) -> Iterator[str]:
    """A long text cut before single spaces, about every PIECE_CHARS."""
    at = 0
    while at < len(text):
        cut = _LONE_SPACE.search(text, at + PIECE_CHARS)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _model(rank_file: str, pattern: str) -> DuckBpe:
    """One for each worker process, kept between its tasks."""
    models = kept(__name__)
    if (rank_file, pattern) not in models:
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        models[rank_file, pattern] = DuckBpe(ranks, pattern)
    return models[rank_file, pattern]


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers."""

    def run(batch: pa.RecordBatch):
        ids = _model(rank_file, pattern).encode(["" if x is None else x for x in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return map_batches(_rows(docs, doc_id, text), run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, ids binary", GROUP_BYTES)


def decode_ids(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) of the output of ``encode_texts``."""

    def run(batch: pa.RecordBatch):
        out = _model(rank_file, pattern).decode(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return map_batches(encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")), run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, bytes binary", GROUP_BYTES)


def encode_checked(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256, exact): ``encode_texts``, the
    digest of the ids' decoded bytes and whether these are the text's."""

    def run(batch: pa.RecordBatch):
        model = _model(rank_file, pattern)
        texts = ["" if x is None else x for x in batch.column(1).to_pylist()]
        ids = model.encode(texts)
        back = model.decode(ids)
        columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()), pa.array([x == t.encode() for x, t in zip(back, texts, strict=True)], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded_sha256", "exact"])

    return map_batches(_rows(docs, doc_id, text), run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, ids binary, decoded_sha256 string, exact boolean", GROUP_BYTES)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, its
    ids decoded again, both in one pass without a shuffle."""

    def run(batch: pa.RecordBatch):
        model = _model(rank_file, pattern)
        ids = model.encode(["" if x is None else x for x in batch.column(1).to_pylist()])
        digest = lambda x: hashlib.sha256(x).hexdigest()
        columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(digest, ids)), pa.array(map(digest, model.decode(ids)))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(_rows(docs, doc_id, text), run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string", GROUP_BYTES)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
