"""Harmonic packing of tokenised documents into sequences of one capacity.

A document is its token ids and an end token. Its length is cut into parts of reciprocal capacity: capacity / 1
as long as that fits, then, of a rest r, the class is j = capacity // r, whose sequences hold exactly j parts.
A rest that leaves more than 1 / TIGHT of such a sequence empty gives up its largest reciprocal part,
capacity // (j + 1), and goes on with what remains, so a rest is cut a few times at most.

Every task fills its own sequences: per class one is open, and it is closed with its j-th part. What a task leaves
open is bounded (a sequence a class). FAN_IN tasks' open parts meet in one group and are packed there in the
same way, and so on up to one group, whose last open parts are laid end to end and cut at the capacity; the
remaining tokens make sequences of powers of two, which need no padding.

Nulls: a null text is empty, an empty text is its end token alone, a null id is kept. A very long text is whole
sequences and one rest. Repeated rows are documents of their own. Only the id and the text are read, other columns
may have any name. Empty table: no parts. The table is written once, so a lost executor repeats only its own task.
"""

from __future__ import annotations

import json
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercato.llm.tables import written

CAPACITY = 2048
END = 1
#: A part may leave a share of 1 / TIGHT of its class's sequences empty.
TIGHT = 64
#: Groups whose open sequences are packed together.
FAN_IN = 64
#: Bytes of text tokenised at a time, stems a worker remembers before it starts afresh, words encoded at once.
TEXT_BYTES, REMEMBERED, JOINED = 8_000_000, 1_000_000, 50
# fixed values: letters that stand for themselves in NFC and have one lower-case letter, and those in lower case
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿĀ-įĲ-ňŊ-žЀ-џ]+$"
PLAIN = "^[a-zß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįĳĵķĸĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžа-џ]+$"
#: A word of letters and one mark; no pattern of the tokenizer spans the two.
MARKED = r"^\pL+[.,;:!?]$"

SCHEMA = "doc_id {kind}, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, task long"
WIDTH = 4  # bytes of a token: little-endian, unsigned


class Words:
    """Ids of white-space separated words, each distinct one encoded once; no token and no step of the tokenizer crosses
    white space, and none a letter before MARKS, so a mark at the end of a word is a word of its own (both are stems).

    Known stems stay in arrays: about 40 bytes each, REMEMBERED at most."""

    def __init__(self, model: str):
        self.full = Tokenizer.from_str(model)
        self.full.encode_special_tokens = True
        plain = json.loads(model)
        cut = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
        letters = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        plain |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [cut, letters]}}
        #: The same vocabulary and merges for words that normalisation and the pattern leave as they are.
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.full.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.stems, self.ids = pa.array([""], pa.string()), Store()
        self.ids.add(np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))

    def learn(self, stems: pa.StringArray) -> None:
        """Take in ``stems``, which are new and differ."""
        easy = pc.match_substring_regex(stems, PLAIN)
        words, others = stems.filter(easy), stems.filter(pc.invert(easy))
        listed = words.to_pylist()
        texts = [" ".join(listed[at : at + JOINED]) for at in range(0, len(listed), JOINED)]
        flat = np.fromiter(chain.from_iterable(e.ids for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)), np.uint32)
        ends = np.flatnonzero(self.last[flat]) + 1  # a word of letters is one piece, whose last token says so
        self.ids.add(flat, np.diff(ends, prepend=0))
        ids = [e.ids for e in self.full.encode_batch_fast(others.to_pylist(), add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self.ids.add(np.fromiter(chain.from_iterable(ids), dtype=np.uint32), sizes)
        self.stems = pa.concat_arrays([self.stems, words, others])

    def places(self, stems: pa.StringArray) -> np.ndarray:
        """Where the known stems hold ``stems``; unknown ones are learnt."""
        at = pc.index_in(stems, value_set=self.stems)
        if at.null_count:
            known, missing = len(self.stems), pc.is_null(at)
            unknown = stems.filter(missing)
            self.learn(unknown.unique())
            found = pc.index_in(unknown, value_set=self.stems.slice(known))
            at = pc.replace_with_mask(at, missing, pc.add(found, pa.scalar(known, pa.int32())))
        return at.to_numpy()

    def encode(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Per text its ids and END."""
        if len(self.stems) > REMEMBERED:
            self.forget()
        cut = pc.ascii_split_whitespace(texts)
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary
        marked = pc.match_substring_regex(words, MARKED)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words)
        stems = pc.if_else(pc.match_substring_regex(stems, LETTERS), pc.utf8_lower(stems), stems)
        marks = pc.if_else(marked, pc.utf8_slice_codeunits(words, -1), "")
        both = self.places(pa.concat_arrays([stems, marks])).reshape(2, -1).T
        ids, sizes = self.ids.gather(both.ravel())
        of_words = Store()
        of_words.add(ids, sizes.reshape(-1, 2).sum(axis=1))
        ids, sizes = of_words.gather(coded.indices.to_numpy())
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(cut.value_lengths().to_numpy()))]
        return [np.append(ids[a:b], np.uint32(END)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def words_of(model: str) -> Words:
    """One ``Words`` per Python worker: a reused worker knows the words of its earlier tasks. Functions come by value,
    so what stays with the worker hangs on a module made there."""
    held = sys.modules.setdefault("_packing_words", types.ModuleType("_packing_words"))
    if getattr(held, "model", None) != model:
        held.model, held.words = model, Words(model)
    return held.words


class Store:
    """Lists of ids after one another."""

    def __init__(self):
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists ``at``, and how many each has."""
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[at] - (ends - sizes), sizes)], sizes


def _slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TEXT_BYTES; a longer text is one of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    start = 0
    while start < len(texts):
        limit = TEXT_BYTES + (ends[start - 1] if start else 0)
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield start, stop
        start = stop


def parts(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(length, class) of the parts of a document of ``length`` tokens."""
    found = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        fits = capacity // rest
        if (capacity - fits * rest) * TIGHT <= capacity:
            found.append((rest, fits))
            break
        found.append((capacity // (fits + 1), fits + 1))
        rest -= capacity // (fits + 1)
    return found


class Bins:
    """The open sequences of one worker, and the closed parts it has not handed on yet."""

    def __init__(self, schema: pa.Schema, worker: int, first: int):
        self.schema, self.worker, self.next = schema, worker, first
        self.open: dict[int, list[tuple]] = {}
        self.closed: list[tuple] = []

    def put(self, part: tuple, fits: int) -> None:
        """``part`` is (doc_id, start, length, tokens, doc_tokens)."""
        waiting = self.open.setdefault(fits, [])
        waiting.append(part)
        if len(waiting) == fits:
            self.close(self.open.pop(fits))

    def close(self, members: list[tuple]) -> None:
        offset = 0
        for part in members:
            self.closed.append((*part, self.next, offset, None))
            offset += part[2]
        self.next += 1

    def rest(self) -> list[tuple]:
        """The parts of open sequences, long ones first."""
        left = [part for fits in sorted(self.open) for part in self.open[fits]]
        self.open = {}
        return left

    def lay(self, members: list[tuple], capacity: int) -> None:
        """Close all of ``members``: end to end in sequences of ``capacity``, then of powers of two."""
        left = sum(part[2] for part in members)
        queue, room, filling = members[::-1], 0, []
        while queue:
            if not room:
                room = capacity if left >= capacity else 1 << left.bit_length() - 1
                left -= room
            key, start, length, tokens, total = queue.pop()
            taken = min(length, room)
            filling.append((key, start, taken, tokens[: taken * WIDTH], total))
            if taken < length:
                queue.append((key, start + taken, length - taken, tokens[taken * WIDTH :], total))
            room -= taken
            if not room:
                self.close(filling)
                filling = []

    def batch(self, more: list[tuple] = ()) -> pa.RecordBatch:
        """What was closed since the last call, and ``more`` parts that stay open."""
        rows = [*self.closed, *((*part, None, None, self.worker) for part in more)]
        self.closed = []
        columns = zip(*rows, strict=True) if rows else [[]] * len(self.schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def _arrow(kind: pa.DataType) -> pa.Schema:
    names = ["start", "length", "tokens", "doc_tokens", "sequence_id", "offset", "task"]
    return pa.schema([("doc_id", kind), *[(n, pa.binary() if n == "tokens" else pa.int64()) for n in names]])


def _first_id(level: int, worker: int) -> int:
    """Ids of a worker's sequences: 7 bits of level, 24 of worker, 32 of sequence."""
    return level << 56 | worker << 32


def packed(docs: DataFrame, model: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per part: doc_id, start (tokens of its document before it), length, tokens (little-endian, 4 bytes
    each), doc_tokens, sequence_id and offset there. ``model`` is the JSON text of the tokenizer."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = SCHEMA.format(kind=rows.schema["doc_id"].dataType.simpleString())
    shared = rows.sparkSession.sparkContext.broadcast(model)  # the tokenizer's own size

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bins = words_of(shared.value), None
        for batch in batches:
            if bins is None:
                worker = TaskContext.get().partitionId()
                bins = Bins(_arrow(batch.schema.field("doc_id").type), worker, _first_id(0, worker))
            for at, stop in _slices(batch.column("text")):
                few = batch.slice(at, stop - at)
                for key, ids in zip(few.column("doc_id").to_pylist(), words.encode(few.column("text")), strict=True):
                    start, raw = 0, ids.astype("<u4").tobytes()
                    for length, fits in parts(len(ids), capacity):
                        bins.put((key, start, length, raw[start * WIDTH : (start + length) * WIDTH], len(ids)), fits)
                        start += length
                yield bins.batch()
        if bins is not None:
            yield bins.batch(bins.rest())

    def merged(level: int, last: bool):
        def pack(table: pa.Table) -> pa.Table:
            worker = table.column("task")[0].as_py()
            bins = Bins(_arrow(table.schema.field("doc_id").type), worker, _first_id(level, worker))
            ordered = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
            names = ["doc_id", "start", "length", "tokens", "doc_tokens"]
            for part in zip(*[ordered.column(n).to_pylist() for n in names], strict=True):
                bins.put(part, capacity // part[2])
            left = bins.rest()
            if last:
                bins.lay(left, capacity)
                left = []
            return pa.Table.from_batches([bins.batch(left)])

        return pack

    made = written(rows.mapInArrow(tokenised, schema), "packed")
    levels, last = [made], False
    while not last:
        waiting = levels[-1].filter("sequence_id IS NULL")
        highest = waiting.agg(F.max("task")).first()[0]
        if highest is None:
            break
        last = highest < FAN_IN
        team = waiting.withColumn("task", F.floor(F.col("task") / FAN_IN))  # at most FAN_IN tasks' open sequences
        levels.append(written(team.groupBy("task").applyInArrow(merged(len(levels), last), schema), "packed"))
    closed = levels[0].filter("sequence_id IS NOT NULL")
    for level in levels[1:]:
        closed = closed.unionByName(level.filter("sequence_id IS NOT NULL"))
    return closed.drop("task")


def sequences(packed_parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence: sequence_id, tokens, length and padded_length (the capacity, or its own power of two)."""
    parts_of = F.array_sort(F.collect_list(F.struct("offset", "tokens", "length")))  # at most ``capacity`` parts
    whole = F.reduce("parts", F.lit(b""), lambda got, part: F.concat(got, part["tokens"]))
    grouped = packed_parts.groupBy("sequence_id").agg(parts_of.alias("parts"), F.sum("length").alias("length"))
    power = F.bit_count("length") == 1
    return grouped.select("sequence_id", whole.alias("tokens"), "length", F.when(power, F.col("length")).otherwise(capacity).alias("padded_length"))
