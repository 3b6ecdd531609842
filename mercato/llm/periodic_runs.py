"""Periodic runs of words by descending-LCP Kruskal, and texts with the repeats of a run collapsed to its first period.

A run is a stretch of words with smallest period q, at least MIN_LENGTH words and MIN_PERIODS periods long, that no
neighbouring word extends. Two suffixes q apart at its start agree in length - q words, which is at least LEAST
words (16) for every run asked for. So only places whose 16 words occur twice in the document matter:

1. a rolling hash finds them (a collision only lets more places through), and they and the words that their 16-grams
   cover are laid out with separators between stretches and documents;
2. the suffixes are sorted by prefix doubling, of which each round sorts only the suffixes that are still tied, and
   the LCP of neighbours is read from the ranks of all rounds;
3. neighbours are united by decreasing LCP with union-find over ordered lists of places. Where a union at LCP l makes
   two places neighbours in the united list, d apart, the words between and the l after have period d. No place
   between them agrees in l >= d words, so d is the smallest period (else a smaller one would divide it, and the place
   one such period on would have been united before). A seed whose left neighbours differ is the start of its run, and
   l is exact, so every run is found once, with its true end.

A document is the unit of work and has to fit one row; documents are taken a bounded number of words at a time (or one
by one if longer), and Spark deals them out by partition, so no group of copies meets in a task.

Nulls: a null text has no words, like an empty or blank one: no runs, an empty collapsed text. A null id is kept.
Repeated rows are judged alike. Other columns stay, unless they have the name of a result column. Empty table: empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_LENGTH, MIN_PERIODS = 24, 3
#: Words in which two suffixes at a run's start and one period on agree: length - period, over all runs asked for.
LEAST = MIN_LENGTH * (MIN_PERIODS - 1) // MIN_PERIODS
#: Words that are worked on at a time; a longer document is worked on alone.
WORDS = 1_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)

RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
RESULT = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType())]
Runs = list[tuple[int, int, int]]


def _repeated(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks the places whose next LEAST words seem to occur elsewhere in the same document."""
    count = len(words) - LEAST + 1
    marks = np.zeros(len(words), dtype=bool)
    if count < 2:
        return marks
    grams = (words.astype(np.uint64) + np.uint64(1)) * FACTOR
    grams ^= grams >> np.uint64(29)
    width = 1
    while width < LEAST:
        step = min(width, LEAST - width)
        grams = grams[: len(grams) - step] * FACTOR + grams[step:]
        grams ^= grams >> np.uint64(31)
        width += step
    inside = np.flatnonzero(owner[:count] == owner[LEAST - 1 :])
    keys = grams[inside] ^ (owner[inside].astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    tied = np.zeros(len(ordered), dtype=bool)
    tied[1:] |= same
    tied[:-1] |= same
    marks[inside[order[tied]]] = True
    return marks


def _laid_out(words: np.ndarray, owner: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the covered stretches, a separator after each, and their places (-1: separator).

    A word of two documents is two symbols; every separator is a symbol of its own."""
    starts = np.flatnonzero(marks)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + LEAST, -1)
    places = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    broken = np.flatnonzero((np.diff(places) > 1) | (np.diff(owner[places]) != 0)) + 1
    ends = np.append(broken, len(places))
    laid = np.insert(places, ends, -1)
    keys = owner[places].astype(np.int64) << 32 | words[places].astype(np.int64)
    symbols = np.empty(len(laid), dtype=np.int64)
    symbols[laid >= 0] = np.unique(keys, return_inverse=True)[1] + len(ends)
    symbols[laid < 0] = np.arange(len(ends))
    return symbols, laid


def _suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and the LCP of each with the one before it."""
    size = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    heads = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    rank = np.empty(size, dtype=np.int32)
    rank[order] = heads
    rounds, width = [rank], 1
    slots = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))  # slots of suffixes that are tied
    while len(slots):
        tied = order[slots]
        # a tied suffix holds no separator in its first ``width`` symbols, so the next ones exist
        after = rank[tied + width]
        group = rank[tied]
        sort = np.lexsort((after, group))
        tied, after, group = tied[sort], after[sort], group[sort]
        order[slots] = tied
        fresh = np.append(True, (after[1:] != after[:-1]) | (group[1:] != group[:-1]))
        rank = rank.copy()
        rank[tied] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        rounds.append(rank)
        width *= 2
        slots = slots[~fresh | ~np.append(fresh[1:], True)]
    left, right = order[:-1], order[1:]
    lcp = np.zeros(size, dtype=np.int64)
    common = lcp[1:]
    for step in range(len(rounds) - 1, -1, -1):
        a, b = np.minimum(left + common, size - 1), np.minimum(right + common, size - 1)
        common += np.where(rounds[step][a] == rounds[step][b], 1 << step, 0)
    return order, lcp


def _united(small: list[int], large: list[int]) -> list[tuple[int, int]]:
    """The neighbours (lower, higher) that come from both lists once they are one; ``large`` takes ``small`` in."""
    seeds = []
    for k, place in enumerate(small):
        at = bisect_left(large, place)
        if at and (k == 0 or small[k - 1] < large[at - 1]):
            seeds.append((large[at - 1], place))
        if at < len(large) and (k + 1 == len(small) or small[k + 1] > large[at]):
            seeds.append((place, large[at]))
    if len(small) * 16 < len(large):
        for place in small:
            insort(large, place)
    else:
        large += small
        large.sort()
    return seeds


def _seeds(order: np.ndarray, lcp: np.ndarray, laid: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, distance, LCP) of every pair of places that become neighbours, where LCP >= (MIN_PERIODS - 1) * distance."""
    edges = np.flatnonzero(lcp >= LEAST)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    ends = np.stack([laid[order[edges - 1]], laid[order[edges]]])
    nodes, at = np.unique(ends, return_inverse=True)
    first, second = at.reshape(ends.shape).tolist()
    levels = lcp[edges].tolist()
    parent = list(range(len(nodes)))
    sets = [[place] for place in nodes.tolist()]
    found = []
    for a, b, level in zip(first, second, levels, strict=True):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if len(sets[a]) > len(sets[b]):
            a, b = b, a
        parent[a] = b
        small, sets[a] = sets[a], []
        for low, high in _united(small, sets[b]):
            if level >= (MIN_PERIODS - 1) * (high - low):
                found.append((low, high - low, level))
    return found


def runs_of(words: np.ndarray, owner: np.ndarray) -> Runs:
    """All runs (start, length, period) of ``words`` (numbers); none crosses a change of ``owner``, which ascends."""
    marks = _repeated(words, owner)
    if not marks.any():
        return []
    symbols, laid = _laid_out(words, owner, marks)
    order, lcp = _suffixes(symbols)
    found = []
    for start, period, level in _seeds(order, lcp, laid):
        apart = start == 0 or owner[start - 1] != owner[start] or words[start - 1] != words[start - 1 + period]
        if apart and level + period >= MIN_LENGTH:
            found.append((start, level + period, period))
    return found


def kept_words(count: int, runs: Runs) -> np.ndarray:
    """Marks the words that no run holds after its first period."""
    change = np.zeros(count + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _judged(texts: list[bytes]) -> tuple[list[int], list[Runs], list[str]]:
    numbers: dict[bytes, int] = {}
    cut = [text.split() for text in texts]  # on bytes: ASCII white space
    sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in cut for w in ws), dtype=np.int32, count=sizes.sum())
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(cut), dtype=np.int32), sizes)
    runs: list[Runs] = [[] for _ in cut]
    for start, length, period in sorted(runs_of(words, owner), key=lambda run: (run[0], run[2])):
        document = owner[start]
        runs[document].append((int(start - starts[document]), int(length), int(period)))
    collapsed = []
    for ws, own in zip(cut, runs, strict=True):
        left = [ws[i] for i in np.flatnonzero(kept_words(len(ws), own)).tolist()] if own else ws
        collapsed.append(b" ".join(left).decode())
    return sizes.tolist(), runs, collapsed


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about WORDS words; half the bytes bound the words of a text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) // 2 + 1
        if held and held + size > WORDS:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then period) and collapsed, the kept words
    joined by one space."""
    others = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    rows = docs.select(*[F.col(f"`{c}`") for c in others])
    fields = [*rows.schema.fields, *RESULT]
    kinds = [pa.int64(), pa.list_(pa.struct([pa.field(n, pa.int64(), nullable=False) for n in RUN.names])), pa.string()]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).fill_null(b"").to_pylist()
            for start, end in _slices(texts):
                counts, runs, collapsed = _judged(texts[start:end])
                named = [[dict(zip(RUN.names, run, strict=True)) for run in own] for own in runs]
                made = [pa.array(c, k) for c, k in zip((counts, named, collapsed), kinds, strict=True)]
                few = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*few.columns, *made], names=[f.name for f in fields])

    return rows.mapInArrow(judge, StructType(fields))
