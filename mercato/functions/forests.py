"""A fitted forest as flat arrays, and rows that walk down all its trees at once.

The splits ask few different tests ("slot 3 is at most 2.5", "slot 9 holds one of these codes"). A row answers each test
once; a step down is then one answer looked up, for a block of rows and trees together. Votes are whole numbers of 2^-40, so
rows that end in the same leaves have the same score, in whatever order votes are added.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import scratch_path

VOTE = 1 << 40
WORD = 64
TEST_BITS = 24  # of a step; the others name the left child
TESTS = (1 << TEST_BITS) - 1
BLOCK_ROWS, BLOCK_TREES, BLOCK_UNITS = 512, 16, 128  # what a block walks with fits a core's cache


def node_table(spark: SparkSession, forest: RandomForestClassificationModel) -> DataFrame:
    """One row per node of every tree: tree, node, stats (weight per class), gain, left, right, feature, cut, categories.

    A leaf has left = -1. A row goes left if its feature is at most ``cut[0]`` or, with categories, one of ``cut``."""
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cut"),
        F.col("nodeData.split.numCategories").alias("categories"),
    )


class FlatForest:
    """Nodes and tests of a binary classifier. Test 0 is never answered with right: leaves ask it and lead to themselves."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        stats = np.stack(nodes["stats"].to_numpy())
        first = np.flatnonzero(nodes["node"].to_numpy() == 0)  # a tree's root
        self.trees = len(first)
        start = np.repeat(first, np.diff([*first, len(nodes)]))
        inner = np.flatnonzero(nodes["left"].to_numpy() >= 0)
        left, right = ((start + nodes[side].to_numpy())[inner] for side in ("left", "right"))
        # roots come first, then pairs of siblings
        new = np.empty(len(nodes), np.int64)
        new[first] = np.arange(self.trees)
        new[left] = self.trees + 2 * np.arange(len(inner))
        new[right] = new[left] + 1
        slots, cuts, categories = (nodes[c].to_numpy()[inner] for c in ("feature", "cut", "categories"))
        keys = [(int(s), tuple(float(v) for v in cut), int(c) >= 0) for s, cut, c in zip(slots, cuts, categories, strict=True)]
        self.tests = sorted(set(keys))
        number = {key: i + 1 for i, key in enumerate(self.tests)}
        self.step = np.arange(len(nodes), dtype=np.int64) << TEST_BITS
        self.step[new[inner]] = (new[left] << TEST_BITS) | np.array([number[k] for k in keys], np.int64)
        self.vote = np.empty(len(nodes), np.int64)
        self.vote[new] = np.rint(stats[:, 1] / stats.sum(axis=1) * VOTE).astype(np.int64)
        self.depth, at = 0, np.arange(self.trees)
        while True:
            at = (self.step[at] >> TEST_BITS)[self.step[at] & TESTS > 0]
            if not len(at):
                break
            self.depth, at = self.depth + 1, np.concatenate([at, at + 1])

    def tests_of(self, slots: Sequence[int]) -> np.ndarray:
        return np.array([i + 1 for i, (slot, _, _) in enumerate(self.tests) if slot in slots], np.int64)

    def cuts_of(self, slot: int) -> np.ndarray:
        return np.array([cut[0] for s, cut, _ in self.tests if s == slot])

    def answers(self, x: np.ndarray) -> np.ndarray:
        """1 where a row (a line of x) goes right."""
        given = np.zeros((len(x), len(self.tests) + 1), np.uint8)
        for i, (slot, cut, coded) in enumerate(self.tests):
            given[:, i + 1] = ~(np.isin(x[:, slot], cut) if coded else x[:, slot] <= cut[0])
        return given

    def scores(self, answers: np.ndarray) -> np.ndarray:
        """The mean vote of all trees for every line of answers."""
        total = np.zeros(len(answers), np.int64)
        for begin in range(0, len(answers), BLOCK_ROWS):
            some = answers[begin : begin + BLOCK_ROWS]
            total[begin : begin + len(some)] = sum(self.vote[at].sum(axis=0) for at in self.ends(some))
        return self.mean(total)

    def mean(self, votes: np.ndarray) -> np.ndarray:
        return votes / (float(VOTE) * self.trees)

    def ends(self, answers: np.ndarray, path: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """The leaves of some lines of answers, by tree and line, ``BLOCK_TREES`` trees at a time. ``path``, by step, tree
        and line, takes twice the test that each step asked plus its answer."""
        size = len(answers)
        for begin in range(0, self.trees, BLOCK_TREES):
            end = min(begin + BLOCK_TREES, self.trees)
            at, lines = np.repeat(np.arange(begin, end), size), np.tile(np.arange(size), end - begin)
            seen = None if path is None else path[:, begin:end].reshape(self.depth, -1)
            yield self.walk(at, lines, answers, seen).reshape(end - begin, size)
            if path is not None:
                path[:, begin:end] = seen.reshape(self.depth, end - begin, size)

    def walk(self, at: np.ndarray, lines: np.ndarray, answers: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        """The leaves below the nodes ``at`` for lines of answers."""
        flat, line = np.ascontiguousarray(answers).ravel(), lines * answers.shape[1]
        at, step, ask, right = at.copy(), np.empty_like(at), np.empty_like(at), np.empty(len(at), np.uint8)
        for turn in range(self.depth):
            np.take(self.step, at, out=step, mode="clip")
            np.bitwise_and(step, TESTS, out=ask)
            if seen is not None:
                seen[turn] = ask
            np.add(ask, line, out=ask)
            np.take(flat, ask, out=right, mode="clip")
            if seen is not None:
                seen[turn] = 2 * seen[turn] + right
            np.right_shift(step, TEST_BITS, out=step)
            np.add(step, right, out=at)
        return at


def scored(rows: DataFrame, forest: FlatForest, vector: str, name: str) -> DataFrame:
    """``rows`` with their score in place of ``vector``, an array of the forest's inputs."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # bounded by the trees and depth of the forest
    fields = [field for field in rows.schema.fields if field.name != vector]
    names = [field.name for field in fields]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = shared.value.scores(shared.value.answers(_matrix(batch.column(vector))))
                yield batch.select(names).append_column(name, pa.array(scores))

    return rows.mapInArrow(walk, T.StructType([*fields, T.StructField(name, T.DoubleType())]))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


class Exchange:
    """What a forest says of rows when one raw column takes another value.

    A column is a number in its own slot or a text with one slot per known label. Only what the tests can tell apart counts:
    between two neighbouring cuts of its slot all numbers are one *code*, as are all unknown labels (code 0)."""

    def __init__(self, forest: FlatForest, size: int, numbers: Mapping[int, int], labels: Mapping[int, tuple[int, list[str]]]):
        """``size`` slots; column -> slot of a number, column -> (first slot, labels) of a text."""
        self.forest, self.numbers, self.labels = forest, dict(numbers), dict(labels)
        self.tests, self.table = {}, {}
        for column, slot in numbers.items():
            each = np.zeros((len(forest.cuts_of(slot)) + 1, size))
            each[:, slot] = [*forest.cuts_of(slot), np.inf]
            self._add(column, [slot], each)
        for column, (first, known) in labels.items():
            each = np.zeros((len(known) + 1, size))
            each[1:, first : first + len(known)] = np.eye(len(known))
            self._add(column, range(first, first + len(known)), each)

    def _add(self, column: int, slots: Sequence[int], each: np.ndarray) -> None:
        self.tests[column] = self.forest.tests_of(slots)
        self.table[column] = self.forest.answers(each)[:, self.tests[column]]

    def _own(self, column: int, x: np.ndarray) -> np.ndarray:
        if column in self.numbers:
            slot = self.numbers[column]
            return np.searchsorted(self.forest.cuts_of(slot), x[:, slot])
        first, known = self.labels[column]
        flags = x[:, first : first + len(known)]
        return np.where(flags.any(axis=1), flags.argmax(axis=1) + 1, 0)

    def _codes(self, column: int, number: pa.Array, text: pa.Array) -> np.ndarray:
        if column in self.numbers:
            return np.searchsorted(self.forest.cuts_of(self.numbers[column]), number.to_numpy(zero_copy_only=False))
        found = pc.index_in(text, pa.array(self.labels[column][1], text.type))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False) + 1

    def scores(self, x: np.ndarray, row: np.ndarray, column: np.ndarray, number: pa.Array, text: pa.Array) -> np.ndarray:
        """For every exchange (a line of x, a column, its new value) the score of that line with the new value.

        Equal codes on one line are one walk, and only trees whose path asks a test that answers the new code otherwise are
        walked again."""
        found = np.empty(len(row), np.int64)
        order = np.argsort(row, kind="stable")
        edges = np.searchsorted(row[order], np.arange(0, len(x) + BLOCK_ROWS, BLOCK_ROWS))
        columns = {c: (self._own(c, x), np.zeros(len(row), np.int64)) for c in self.tests}
        for c, (_, codes) in columns.items():
            at = np.flatnonzero(column == c)
            codes[at] = self._codes(c, number.take(pa.array(at)), text.take(pa.array(at)))
        for block, begin in enumerate(range(0, len(x), BLOCK_ROWS)):
            some, mine = slice(begin, begin + BLOCK_ROWS), order[edges[block] : edges[block + 1]]
            answers = self.forest.answers(x[some])
            path = np.empty((self.forest.depth, self.forest.trees, len(answers)), np.int32)
            votes = np.concatenate([self.forest.vote[at] for at in self.forest.ends(answers, path)])
            found[mine] = votes.sum(axis=0)[row[mine] - begin]
            for c, (own, codes) in columns.items():
                at = mine[column[mine] == c]
                at, kinds = at[codes[at] != own[row[at]]], len(self.table[c])
                units, which = np.unique((row[at] - begin) * kinds + codes[at], return_inverse=True)
                found[at] += self._gains(c, answers, path, votes, *np.divmod(units, kinds))[which]
        return self.forest.mean(found)

    def _gains(self, c: int, answers: np.ndarray, path: np.ndarray, votes: np.ndarray, line: np.ndarray, code: np.ndarray) -> np.ndarray:
        """How much the sum of votes of a line changes with a code of the column."""
        gains = np.zeros(len(line), np.int64)
        kept = self._kept(c, path)
        for begin in range(0, len(line), BLOCK_UNITS):
            lines, codes = line[begin : begin + BLOCK_UNITS], code[begin : begin + BLOCK_UNITS]
            changed = answers[lines]
            changed[:, self.tests[c]] = self.table[c][codes]
            moved = kept[codes // WORD, :, lines].T >> (codes % WORD).astype(np.uint64) & np.uint64(1) == 0
            tree, unit = np.nonzero(moved)
            ends = self.forest.walk(tree, unit, changed)
            gained = (self.forest.vote[ends] - votes[tree, lines[unit]]).astype(np.float64)  # whole numbers below 2^53
            gains[begin : begin + BLOCK_UNITS] = np.bincount(unit, gained, len(lines)).astype(np.int64)
        return gains

    def _kept(self, c: int, path: np.ndarray) -> np.ndarray:
        """By word, tree and line a bit per code of the column: whether it answers all of the path's tests as the line does."""
        kinds = len(self.table[c])
        words = -(-kinds // WORD)
        same = np.full((words, 2 * len(self.forest.tests) + 2), np.uint64(2**WORD - 1))
        for test, given in zip(self.tests[c], self.table[c].T, strict=True):
            for answer in (0, 1):
                for word in range(words):
                    bits = np.flatnonzero(given[word * WORD : (word + 1) * WORD] == answer)
                    same[word, 2 * test + answer] = np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0))
        kept = np.full((words, *path.shape[1:]), np.uint64(2**WORD - 1))
        for word in range(words):
            for step in path:
                kept[word] &= same[word][step]
        return kept


def exchanged(rows: DataFrame, exchange: Exchange, repeats: int) -> DataFrame:
    """(job, label, score) for every value that ``rows`` (label, x, given) are given: ``given`` holds (job, number, text), a
    job is a column of ``exchange`` times ``repeats`` plus a turn."""
    shared = rows.sparkSession.sparkContext.broadcast(exchange)  # the forest and its few tests

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("given")
            row = np.repeat(np.arange(len(given)), pc.list_value_length(given).to_numpy(zero_copy_only=False))
            if len(row):
                job, number, text = given.flatten().flatten()
                column = job.to_numpy(zero_copy_only=False) // repeats
                scores = shared.value.scores(_matrix(batch.column("x")), row, column, number, text)
                yield pa.RecordBatch.from_arrays(
                    [job.cast(pa.int32()), batch.column("label").take(pa.array(row)).cast(pa.int32()), pa.array(scores)],
                    names=["job", "label", "score"],
                )

    return rows.select("label", "x", "given").mapInArrow(walk, "job int, label int, score double")
