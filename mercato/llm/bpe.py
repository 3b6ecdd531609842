"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside the partitions.

A text is cut by the tokenizer's pattern; a piece that is a token as a whole is that token. The other
pieces, each distinct one once per task, become rows (piece, position, token). A recursive query finds
every piece's adjacent pair of least rank, the leftmost of equals, and contracts it, until no piece has a pair left.
Decoding joins the ids with the vocabulary and gathers the bytes in order of position.

Spark partitions the texts; DuckDB is a library inside a task, fed pieces, shortest first, whose steps make
``CHUNK_ROWS`` rows at most (a piece of n bytes makes n (n + 1) / 2), or ``CHUNK_TOKENS`` ids at a time, so its memory
depends neither on the partition nor on a text. Pieces above ``LONG`` bytes take a linear list instead of rows,
because a recursion of one contraction per step is quadratic in the piece; the order of contractions is the same.
The pieces of one text and their numbers have to fit a task.

Nulls: a null text is empty; an empty text has no ids and decodes to no bytes. Repeated rows are encoded
alike. Other columns are kept unless they have the name of a result column. Empty table: empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from mercato.llm.tables import tidy

#: Rows of all steps of one recursive query, and ids that one query decodes.
CHUNK_ROWS, CHUNK_TOKENS = 500_000, 500_000
LONG = 256
#: Pieces that a task remembers before it starts afresh, and bytes of text it encodes at a time.
REMEMBERED, TEXT_BYTES = 450_000, 1_000_000
ROWS = 500  # texts of one step
MEMORY = "400MB"
Run = Callable[["Codec", pa.RecordBatch], pa.Array]

CONTRACT = """
WITH RECURSIVE state AS (
  SELECT 0 AS step, w, pos, tok, nxt, npos FROM start
  UNION ALL
  SELECT n.step + 1, n.w, n.pos,
         CASE WHEN n.pos = b.pos THEN b.rank ELSE n.tok END,
         CASE WHEN n.pos = b.pos THEN b.after WHEN n.npos = b.pos THEN b.rank ELSE n.nxt END,
         CASE WHEN n.pos = b.pos THEN b.after_pos ELSE n.npos END
  FROM state n
  JOIN (SELECT c.w, c.pos, c.npos, c.rank, q.nxt AS after, q.npos AS after_pos
        FROM (SELECT w, (min(least_pair) % 4294967296)::INTEGER AS pos,
                     (min(least_pair) // 4294967296)::INTEGER AS rank, arg_min(npos, least_pair) AS npos
              FROM (SELECT p.w, p.npos, m.rank::BIGINT * 4294967296 + p.pos AS least_pair
                    FROM state p JOIN merges m ON m.pair = p.tok::BIGINT * 4294967296 + p.nxt)
              GROUP BY w) c
        JOIN state q ON q.w = c.w AND q.pos = c.npos) b
    ON n.w = b.w AND n.pos <> b.npos
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
GROUP BY w ORDER BY w
"""
DECODE = "SELECT list(v.bytes ORDER BY pos) AS parts FROM encoded JOIN vocabulary v USING (id)"


def piece_patterns() -> tuple[np.ndarray, str, str]:
    r"""Rare numbers, the pattern for texts without them, and the pattern for all texts:     ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.

    ``re`` knows no ``\p``: its word characters are letters, numbers and the underscore, so the numbers
    that are not decimal digits are listed from the Unicode tables, and white space is spelt out.
    """
    numbers, start = [], None
    for point in range(sys.maxunicode + 2):
        inside = point <= sys.maxunicode and unicodedata.category(chr(point)) in ("No", "Nl")
        if inside and start is None:
            start = point
        elif not inside and start is not None:
            numbers.append(f"\\U{start:08x}-\\U{point - 1:08x}")
            start = None
    more = "".join(numbers)
    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

    def pattern(more: str) -> str:
        letters, digits = rf"[^\W\d_{more}]+", rf"[\d{more}]+"
        return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}| ?{digits}| ?(?:[^\w{space}]|_)+|[{space}]+(?![^{space}])|[{space}]+"

    rare = [p for p in range(sys.maxunicode + 1) if unicodedata.category(chr(p)) in ("No", "Nl")]
    return np.array(rare), pattern(""), pattern(more)


class Tokenizer(NamedTuple):
    """What tasks need of a vocabulary: its size is the tokenizer's, whatever the corpus."""

    ranks: dict[bytes, int]
    patterns: tuple[np.ndarray, str, str]
    pairs: np.ndarray
    merged: np.ndarray


def tokenizer(path: str) -> Tokenizer:
    """From a file of lines ``base64 rank``. Any two tokens whose bytes together are a token are a pair
    (left * 2^32 + right) with that token as rank."""
    with open(path, "rb") as file:
        content = file.read()
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
    pairs = {
        left << 32 | right: rank
        for token, rank in ranks.items()
        for at in range(1, len(token))
        if (left := ranks.get(token[:at])) is not None and (right := ranks.get(token[at:])) is not None
    }
    numbers = np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int32)
    return Tokenizer(ranks, piece_patterns(), *numbers)


def contracted(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction on a linked list with a queue of pairs, for one long piece."""
    ends, nexts, backs = list(range(1, len(piece) + 1)), list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        right = nexts[at] if at >= 0 else len(piece)
        if right < len(piece):
            rank = ranks.get(piece[at : ends[right]])
            if rank is not None:
                heapq.heappush(queue, (rank, at, ends[right]))

    for at in range(len(piece)):
        offer(at)
    while queue:
        _, at, end = heapq.heappop(queue)
        right = nexts[at] if ends[at] > at else len(piece)
        if right >= len(piece) or ends[right] != end:
            continue  # one of the two has been merged since
        ends[at], nexts[at], ends[right] = end, nexts[right], -1
        if nexts[at] < len(piece):
            backs[nexts[at]] = at
        offer(at)
        offer(backs[at])
    out, at = [], 0
    while at < len(piece):
        out.append(ranks[piece[at : ends[at]]])
        at = nexts[at]
    return out


class Codec:
    """One task's DuckDB database with the merge table, and the pieces it has encoded."""

    def __init__(self, source: Tokenizer):
        ranks = self.ranks = source.ranks
        rare, *patterns = source.patterns
        self.common, self.full = map(re.compile, patterns)
        self.rare = np.zeros(sys.maxunicode + 1, dtype=bool)
        self.rare[rare] = True
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        merges = pa.table({"pair": source.pairs, "rank": source.merged})
        words = pa.table({"id": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(ranks.keys(), pa.binary())})
        for name, rows in (("merges", merges), ("vocabulary", words)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.forget()

    def forget(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.starts = np.zeros(1, dtype=np.int64)  # of the ids of piece i, and one more
        self.ids = np.zeros(0, dtype=np.int32)

    def query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        result = self.db.sql(sql).to_arrow_table().combine_chunks()
        self.db.unregister(name)
        return result

    def contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces after one another, and how many each has."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = (np.arange(len(owner)) - first).astype(np.int32)
        token = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        last = at == np.repeat(lengths - 1, lengths)
        following = np.where(last, -1, np.roll(token, -1)).astype(np.int32)
        start = pa.table(
            {"w": owner, "pos": at, "tok": token, "nxt": following, "npos": np.where(last, -1, at + 1).astype(np.int32)}
        )
        ids = self.query("start", start, CONTRACT)["ids"].combine_chunks()
        return ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy())

    def learn(self, pieces: pa.StringArray) -> None:
        """Take in ``pieces``, which are new and differ, with their ids."""
        raw = pieces.cast(pa.binary()).to_pylist()
        order: list[list[int]] = [[], [], []]
        for i, piece in enumerate(raw):
            order[0 if piece in self.ranks else 1 if len(piece) > LONG else 2].append(i)
        whole, long, rest = order
        rest.sort(key=lambda i: len(raw[i]))  # pieces of one length need about as many steps
        ids = [np.array([self.ranks[raw[i]] for i in whole], dtype=np.int32)]
        counts = [np.ones(len(whole), dtype=np.int64)]
        for i in long:
            made = contracted(raw[i], self.ranks)
            ids.append(np.array(made, dtype=np.int32)), counts.append(np.array([len(made)]))
        ends = np.cumsum([len(raw[i]) * (len(raw[i]) + 1) // 2 for i in rest])
        at = 0
        while at < len(rest):
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_ROWS, side="right"))
            made, sizes = self.contract([raw[i] for i in rest[at:stop]])
            ids.append(made), counts.append(sizes)
            at = stop
        self.pieces = pa.concat_arrays([self.pieces, pieces.take(pa.array([*whole, *long, *rest], pa.int64()))])
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])

    def places(self, pieces: pa.StringArray) -> np.ndarray:
        """The numbers of ``pieces``, which differ; unknown ones are learnt."""
        if len(self.pieces) > REMEMBERED:
            self.forget()
        at = pc.index_in(pieces, value_set=self.pieces)
        if at.null_count:
            known, missing = len(self.pieces), pc.is_null(at)
            unknown = pieces.filter(missing)
            self.learn(unknown)
            found = pc.index_in(unknown, value_set=self.pieces.slice(known))
            at = pc.replace_with_mask(at, missing, pc.add(found, pa.scalar(known, pa.int32())))
        return at.to_numpy()

    def cutter(self, text: str) -> re.Pattern[str]:
        if text.isascii():
            return self.common
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return self.full if self.rare[points].any() else self.common

    def encode(self, texts: list[str]) -> pa.ListArray:
        """The ids of the texts, TEXT_BYTES of them at a time."""
        found, start, held = [], 0, 0
        for i, text in enumerate(texts):
            if held and held + len(text) > TEXT_BYTES:
                found.append(self.encode_some(texts[start:i]))
                start, held = i, 0
            held += len(text)
        found.append(self.encode_some(texts[start:]))
        return pa.concat_arrays(found)

    def encode_some(self, texts: list[str]) -> pa.ListArray:
        cut = [self.cutter(t).findall(t) for t in texts]
        per_text = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        coded = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
        pieces = self.places(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self.starts[pieces + 1] - self.starts[pieces]
        ends = np.cumsum(sizes)
        # the k-th id of a piece stands at its start + k
        flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[pieces] - (ends - sizes), sizes)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(self.ids[flat], pa.int32()))

    def decode(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of the ids, CHUNK_TOKENS of them at a time whatever text they belong to."""
        sizes = np.asarray(ids.value_lengths().fill_null(0), dtype=np.int64)
        flat = ids.flatten()
        data = []
        for at in range(0, len(flat), CHUNK_TOKENS):
            part = flat.slice(at, CHUNK_TOKENS)
            rows = pa.table({"pos": np.arange(len(part), dtype=np.int32), "id": part})
            parts = self.query("encoded", rows, DECODE)["parts"].combine_chunks().flatten()
            # the parts come by position: their bytes follow each other in the buffer, whatever text they belong to
            first, last = (np.frombuffer(parts.buffers()[1], dtype=np.int32)[parts.offset + i] for i in (0, len(parts)))
            data.append(parts.buffers()[2].slice(int(first), int(last - first)).to_pybytes())
        lengths = np.append(0, np.cumsum(self.lengths[flat.to_numpy()]))
        edges = lengths[np.append(0, np.cumsum(sizes))]
        offsets = pa.array(edges, pa.int32())
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, offsets.buffers()[1], pa.py_buffer(b"".join(data))])


def _mapped(df: DataFrame, tokens: Tokenizer, target: str, kind: DataType, rows: int, run: Run) -> DataFrame:
    """``df`` with the column ``target``, made by ``run(codec, batch)`` for ``rows`` rows at a time."""
    plain = df.select([F.col(f"`{c}`") for c in df.columns if c != target])
    shared = df.sparkSession.sparkContext.broadcast(tuple(tokens))  # the tokenizer's own size

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(Tokenizer(*shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays([*part.columns, run(codec, part)], names=[*part.schema.names, target])
        codec.db.close()

    return plain.mapInArrow(tidy(convert), StructType([*plain.schema.fields, StructField(target, kind)]))


def encoded(docs: DataFrame, tokens: Tokenizer, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text."""

    def run(codec: Codec, batch: pa.RecordBatch) -> pa.Array:
        return codec.encode([t or "" for t in batch.column(text).to_pylist()])

    return _mapped(docs, tokens, "ids", ArrayType(IntegerType()), ROWS, run)


def decoded(docs: DataFrame, tokens: Tokenizer, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes of the ids."""
    return _mapped(docs, tokens, "decoded", BinaryType(), ROWS, lambda codec, batch: codec.decode(batch.column(ids)))
