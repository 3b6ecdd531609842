"""Language identification of mixed text: script ranges, n-gram scores per word, Viterbi over the words.

Training counts letter n-grams (1 to 3, with word ends) of labelled texts into hashed slots per language,
and the scripts each language is written in. The model is ``SLOTS`` numbers per language, whatever the
corpus. To label a text, the script of a word narrows its candidate languages, its n-grams give each
candidate a log-likelihood, and Viterbi finds the cheapest labelling when every change of language costs
``SWITCH``. Neighbouring words of one label form a span. The text's language has most letters; the
score is its share of all letters.

The labelled sample is bounded: ``TRAIN_ROWS`` rows by hash of the id, a documented parameter. Texts are
labelled whole, in Arrow batches; all texts of a batch take a Viterbi step together.

Nulls: a null text or one without letters is ``und`` with score 0 and no spans; rows with a null label do
not train. A text whose script no learned language uses gets the most frequent language with score 0.
Without labelled rows every text is ``und``. Ties go to the language first by code point. Repeated rows are
labelled alike, other columns are kept by ``identified`` unless they have the name of a result column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from mercato.llm.tables import tidy

UNKNOWN = "und"
#: Labelled rows that train the model, by hash of doc_id.
TRAIN_ROWS = 20_000
SLOTS = 1 << 16
#: Log-likelihood that a change of language inside a text must gain.
SWITCH = 12.0
#: Share of a language's letters that a script needs to count as one of its own.
SCRIPT_SHARE = 0.001
REMEMBERED = 300_000
IMPOSSIBLE = np.float32(-1e4)

# fixed values: first and last code point of the letters of common scripts
SCRIPTS = [
    ("latin", 0x41, 0x24F),
    ("latin", 0x250, 0x2AF),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x6FF),
    ("syriac", 0x700, 0x74F),
    ("arabic", 0x750, 0x77F),
    ("thaana", 0x780, 0x7BF),
    ("devanagari", 0x900, 0x97F),
    ("bengali", 0x980, 0x9FF),
    ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF),
    ("oriya", 0xB00, 0xB7F),
    ("tamil", 0xB80, 0xBFF),
    ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF),
    ("malayalam", 0xD00, 0xD7F),
    ("sinhala", 0xD80, 0xDFF),
    ("thai", 0xE00, 0xE7F),
    ("lao", 0xE80, 0xEFF),
    ("tibetan", 0xF00, 0xFFF),
    ("myanmar", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF),
    ("mongolian", 0x1800, 0x18AF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x323AF),
]
NAMES = ["other", *sorted({name for name, _, _ in SCRIPTS})]
WORD = re.compile(r"[^\W\d_]+")


def scripts_of(first: np.ndarray) -> np.ndarray:
    """Number in ``NAMES`` of each code point."""
    starts = np.array([a for _, a, _ in SCRIPTS])
    ends = np.array([b for _, _, b in SCRIPTS])
    names = np.array([NAMES.index(name) for name, _, _ in SCRIPTS])
    at = np.maximum(np.searchsorted(starts, first, side="right") - 1, 0)
    return np.where((first >= starts[at]) & (first <= ends[at]), names[at], 0)


def grams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, word number) of all n-grams of 1 to 3 characters, word ends included."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(words)), lengths)
    points = points.astype(np.uint64)
    slots, owners = [], []
    rolling = np.zeros(len(points), dtype=np.uint64)
    for size in (1, 2, 3):
        count = len(points) - size + 1
        if count <= 0:
            break
        rolling = (rolling[:count] * np.uint64(0x9E3779B97F4A7C15)) + points[size - 1 :] + np.uint64(size)
        inside = owner[:count] == owner[size - 1 :]
        hashed = (rolling * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)
        slots.append(hashed[inside].astype(np.int64) % SLOTS)
        owners.append(owner[:count][inside])
    return np.concatenate(slots or [np.zeros(0, np.int64)]), np.concatenate(owners or [np.zeros(0, np.int64)])


def letters_only(word: str) -> str:
    """The word without the digits that count as letters in a pattern but not in Unicode (like a superscript two)."""
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Model from (doc_id, text, lang): languages, n-gram weights and candidate languages per script."""
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    share = min(1.0, rows / max(1, usable.count()))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                words = pd.Series([w for t in texts for w in map(letters_only, WORD.findall(t)) if w]).value_counts()
                if not len(words):
                    continue
                names, times = list(words.index), words.to_numpy()
                slot, owner = grams_of([w.lower() for w in names])
                grams = np.bincount(slot, weights=times[owner], minlength=SLOTS)
                script = scripts_of(np.array([ord(w[0]) for w in names]))
                letters = np.bincount(script, weights=times * np.array(list(map(len, names))), minlength=len(NAMES))
                for kind, counts in (("gram", grams), ("script", letters)):
                    at = np.flatnonzero(counts)
                    yield pd.DataFrame({"lang": lang, "kind": kind, "at": at, "n": counts[at].astype(np.int64)})

    counted = usable.filter(drawn).select("lang", "text").mapInPandas(tidy(count), "lang string, kind string, at long, n long")
    # at most SLOTS + scripts rows per language
    table = counted.groupBy("lang", "kind", "at").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(table["lang"].unique())
    grams, scripts = np.zeros((SLOTS, len(langs))), np.zeros((len(NAMES), len(langs)))
    for (lang, kind), part in table.groupby(["lang", "kind"]):
        target = grams if kind == "gram" else scripts
        target[part["at"].to_numpy(), langs.index(lang)] = part["n"].to_numpy()
    weights = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * SLOTS)) if langs else grams
    allowed = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    frequent = int(np.argmax(grams.sum(axis=0))) if langs else 0
    return {"langs": langs, "weights": weights.astype(np.float32), "allowed": allowed, "frequent": frequent}


class Scorer:
    """Numbers words and keeps their scores per language."""

    def __init__(self, model: dict):
        self.model = model
        self.ids: dict[str, int] = {}
        self.scores = np.zeros((0, len(model["langs"])), dtype=np.float32)
        self.letters = np.zeros(0, dtype=np.int64)
        self.scripted = np.zeros(0, dtype=bool)

    def numbered(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Word numbers of every text; scores of words that are new are added first."""
        new = list({w for words in texts for w in words if w not in self.ids})
        if new:
            self.add(new)
        look = self.ids.__getitem__
        return [np.fromiter(map(look, words), dtype=np.int32, count=len(words)) for words in texts]

    def add(self, words: list[str]) -> None:
        plain = [letters_only(w) for w in words]
        slot, owner = grams_of([w.lower() for w in plain])
        weights = self.model["weights"]
        scores = np.stack(
            [np.bincount(owner, weights=weights[slot, j], minlength=len(words)) for j in range(weights.shape[1])], axis=1
        ).astype(np.float32)
        first = np.array([ord(w[0]) if w else 0 for w in plain])
        allowed = self.model["allowed"][scripts_of(first)]
        known = allowed.any(axis=1) & np.array([bool(w) for w in plain])
        scores = np.where(known[:, None], np.where(allowed, scores, IMPOSSIBLE), np.float32(0))
        start = len(self.ids)
        self.ids.update(zip(words, range(start, start + len(words)), strict=True))
        self.scores = np.concatenate([self.scores, scores])
        self.letters = np.concatenate([self.letters, [len(w) for w in plain]])
        self.scripted = np.concatenate([self.scripted, known])


def viterbi(numbers: list[np.ndarray], scores: np.ndarray, switch: float) -> list[np.ndarray]:
    """The best label of every word of every text; all texts advance together, the longest first in the arrays."""
    lengths = np.array([len(n) for n in numbers])
    order = np.argsort(-lengths, kind="stable")
    live = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")  # texts longer than t
    flat = np.concatenate([numbers[i] for i in order]) if len(order) else np.zeros(0, np.int32)
    start = np.concatenate([[0], np.cumsum(lengths[order])])[:-1]
    steps, langs = len(live), scores.shape[1]
    came = np.zeros((len(flat), langs), dtype=np.int8 if langs < 128 else np.int32)
    value = np.zeros((len(order), langs), dtype=np.float32)
    own = np.arange(langs)
    for t in range(steps):
        n = live[t]
        at = start[:n] + t
        if t:
            v = value[:n]
            best = v.argmax(axis=1)
            top = v[np.arange(n), best] - np.float32(switch)
            stay = v >= top[:, None]
            came[at] = np.where(stay, own, best[:, None])
            value[:n] = np.where(stay, v, top[:, None]) + scores[flat[at]]
        else:
            value[:n] = scores[flat[at]]
    labels = np.zeros(len(flat), dtype=np.int32)
    current = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = live[t]
        at = start[:n] + t
        labels[at] = current[:n]
        if t:
            current[:n] = came[at, current[:n]]
    out: list[np.ndarray] = [labels[:0]] * len(numbers)
    for k, i in enumerate(order):
        out[i] = labels[start[k] : start[k] + lengths[i]]
    return out


def spans_of(text: str, labels: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of one label as code point ranges."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    first = {0, *cuts.tolist()}
    last = {*(cuts - 1).tolist(), len(labels) - 1}
    found: list[dict] = []
    for i, match in enumerate(WORD.finditer(text)):
        if i in first:
            found.append({"start": match.start(), "end": 0, "lang": langs[labels[i]]})
        if i in last:
            found[-1]["end"] = match.end()
    return found


def labelled(texts: list[str | None], scorer: Scorer, switch: float) -> tuple[list[str], list[float], list[list[dict]]]:
    langs = scorer.model["langs"]
    if not langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    numbers = []
    for at in range(0, len(texts), 256):  # the words of a few texts at a time are Python objects
        numbers += scorer.numbered([WORD.findall(t or "") for t in texts[at : at + 256]])
    return_lang, return_score, return_spans = [], [], []
    for text, ids, labels in zip(texts, numbers, viterbi(numbers, scorer.scores, switch), strict=True):
        letters = scorer.letters[ids]
        if not letters.sum():
            return_lang.append(UNKNOWN), return_score.append(0.0), return_spans.append([])
            continue
        told = np.bincount(labels, weights=letters * scorer.scripted[ids], minlength=len(langs))
        best = int(told.argmax()) if told.any() else scorer.model["frequent"]
        return_lang.append(langs[best])
        return_score.append(float(told[best] / letters.sum()))
        return_spans.append(spans_of(text, labels, langs))
    return return_lang, return_score, return_spans


def identified(docs: DataFrame, model: dict, switch: float = SWITCH) -> DataFrame:
    """``docs`` with lang_pred, score and spans (start, end, lang; code points); only ``text`` is looked at."""
    result = ["lang_pred", "score", "spans"]
    plain = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in result])
    span = StructType().add("start", IntegerType()).add("end", IntegerType()).add("lang", StringType())
    more = [("lang_pred", StringType()), ("score", DoubleType()), ("spans", ArrayType(span))]
    schema = StructType([*plain.schema.fields, *[StructField(name, kind) for name, kind in more]])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers per language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            if len(scorer.ids) > REMEMBERED:
                scorer = Scorer(shared.value)
            lang, score, spans = labelled(batch.column("text").to_pylist(), scorer, switch)
            more = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *result])

    return plain.mapInArrow(tidy(label), schema)
