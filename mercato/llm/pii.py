"""Personal data: pattern spans, and words that give protected entities away by corpus co-occurrence.

Emails, IP addresses, card and phone numbers are found by pattern. Each distinct value is a protected
entity. The words within ``WINDOW`` words of an entity, on its line or not, are its context. A word t
discloses entity e by the share of e's information it carries: PMI(e; t) / IC(e), with probabilities from
the whole corpus in units of one window: 1 means that t never occurs without e, 0 that it tells nothing.
Evidence needs two different contexts of the same entity, so copies of one text prove nothing. A word at or
above ``THRESHOLD`` is generalised to its first letters if that stem stays below the threshold for every
such entity of the document, and removed otherwise; this holds for all its places in the documents that hold the
entity, near it or not.

Words are counted per task before they are shuffled, and only words that met an entity twice leave a task:
a bitmap of fixed size tells which. Joins on (entity, word) leave a hot entity to Spark's skew join.

Nulls: a null text is empty; rows are told apart by a 128-bit hash of doc_id and text, null ids included. Repeated rows get the
same spans. Empty table: empty result. Spans are code points, end exclusive, never overlapping a pattern span.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.session import written

KINDS = ("email", "ip", "card", "phone")
#: Words on each side of an entity that are its context.
WINDOW = 8
#: Share of an entity's information from which a word is disclosing.
THRESHOLD = 0.95
STEM = 4
BITS = 1 << 20

# fixed values: the character classes and lengths of the patterns
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")
DIGITS = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, from each @ outwards: linear also in long words without one."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of all pattern spans, by start, then kind."""
    found = [(a, b, 0, text[a:b].lower()) for a, b in emails(text)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1, m[0]))
    for m in CARD.finditer(text):
        digits = "".join(DIGITS.findall(m[0])) if m.end() - m.start() <= 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2, digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            digits = "".join(DIGITS.findall(m[0]))
            if 9 <= len(digits) <= 15:
                found.append((m.start(), m.end(), 3, digits))
    return [(a, b, KINDS[k], value) for a, b, k, value in sorted(found, key=lambda s: (s[0], s[2], s[1]))]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def placed(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], np.ndarray, list[tuple[int, int]]]:
    """Places of all words, marks of those that overlap a span, and per span the first word in it and the first after."""
    words = [m.span() for m in WORD.finditer(text)]
    starts = [s for s, _ in words]
    covered = np.zeros(len(words), dtype=bool)
    where = []
    for start, end in spans:
        first, after = np.searchsorted(starts, [start, end])
        if first and words[first - 1][1] > start:
            first -= 1
        covered[first:after] = True
        where.append((int(first), int(after)))
    return words, covered, where


def contexts(text: str, spans: list[tuple[int, int, str, str]], window: int) -> list[dict]:
    """The words around every entity: entity, context (hash of its words), word."""
    if not spans:
        return []
    words, covered, where = placed(text, [s[:2] for s in spans])
    found = []
    for (first, after), (_, _, kind, value) in zip(where, spans, strict=True):
        near = [i for i in (*range(max(0, first - window), first), *range(after, min(len(words), after + window))) if not covered[i]]
        told = [text[slice(*words[i])].lower() for i in near]
        entity, context = _hash(f"{kind}:{value}"), _hash(" ".join(told))
        found += [{"entity": entity, "context": context, "word": w} for w in told]
    return found


def _row() -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat(key, F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"))


def found_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """row, doc_id, base spans, entities and their contexts, and the text if there is an entity: one row per document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", _row().alias("row"), text.alias("text"))
    span = "array<struct<start:int,end:int,kind:string,entity:bigint>>"
    context = "array<struct<entity:bigint,context:bigint,word:string>>"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = list(map(base_spans, batch["text"]))
            base = [[{"start": a, "end": b, "kind": k, "entity": _hash(f"{k}:{v}")} for a, b, k, v in s] for s in spans]
            near = [contexts(t, s, window) for t, s in zip(batch["text"], spans, strict=True)]
            words = [t.count(" ") + t.count("\n") + 1 for t in batch["text"]]
            held = [t if s else None for t, s in zip(batch["text"], spans, strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "row": batch["row"], "words": words, "base": base, "near": near, "held": held})

    # nullable ids stay whole numbers: they pass as text
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = rows.mapInPandas(find, f"doc_id string, row string, words bigint, base {span}, near {context}, held string")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def stem(word: Column) -> Column:
    return F.concat(F.substring(word, 1, STEM), F.lit("*"))


def _bit(text: str) -> int:
    """What Spark's xxhash64 gives, as a place in the bitmap."""
    return xxhash.xxh64_intdigest(text, seed=42) % BITS


def word_counts(docs: DataFrame, forms: DataFrame) -> DataFrame:
    """form, n: how often the words and stems of ``forms`` occur in all texts, counted per task first."""
    places = forms.select(F.pmod(F.xxhash64("form"), F.lit(BITS)).alias("at")).distinct()
    bits = np.zeros(BITS, dtype=bool)  # at most BITS rows come back
    bits[places.toPandas()["at"].to_numpy(dtype=np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            counted: Counter[str] = Counter()
            for text in batch["text"]:
                counted.update(WORD.findall(text.lower()))
            stems: Counter[str] = Counter()
            for word, n in counted.items():
                if len(word) > STEM:
                    stems[word[:STEM] + "*"] += n
            kept = [(f, n) for c in (counted, stems) for f, n in c.items() if known[_bit(f)]]
            yield pd.DataFrame(kept, columns=["form", "n"])

    counts = docs.filter("text IS NOT NULL").select("text").mapInPandas(tally, "form string, n long")
    return counts.groupBy("form").agg(F.sum("n").alias("n"))


def disclosures(docs: DataFrame, found: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """entity, word, share, action: the words that disclose an entity, to be generalised or removed."""
    near = found.select(F.explode("near").alias("c")).select("c.*")
    entities = found.select(F.explode("base").alias("b")).groupBy("b.entity").agg(F.count(F.lit(1)).alias("n_entity"))
    long = F.char_length("word") > STEM
    forms = F.explode(F.when(long, F.array("word", stem(F.col("word")))).otherwise(F.array("word")))
    met = near.select("entity", "context", forms.alias("form")).groupBy("entity", "form")
    pairs = met.agg(F.count(F.lit(1)).alias("n_both"), F.min("context").alias("one"), F.max("context").alias("other"))
    pairs = written(pairs.filter("one <> other").select("entity", "form", "n_both"), "pii-pairs")
    counts = written(word_counts(docs, pairs.select("form").distinct()), "pii-counts")
    units = max(1.0, (found.agg(F.sum("words")).first()[0] or 0) / (2 * window + 1))
    lost = F.log(F.greatest("n", "n_both") / F.col("n_both"))
    information = F.log(F.greatest(F.lit(units) / F.col("n_entity"), F.lit(1.0 + 1e-9)))
    told = pairs.join(counts, "form").join(entities, "entity").withColumn("share", 1 - lost / information)
    words = told.filter((F.col("share") >= threshold) & ~F.col("form").endswith("*"))
    stems = told.filter(F.col("form").endswith("*")).select("entity", F.col("form").alias("stem"), F.col("share").alias("stem_share"))
    judged = words.withColumn("stem", stem(F.col("form"))).join(stems, ["entity", "stem"], "left")
    safe = (F.char_length("form") > STEM) & (F.col("stem_share") < threshold)
    action = F.when(safe, "generalise").otherwise("remove")
    return judged.select("entity", F.col("form").alias("word"), "share", action.alias("action"))


def word_spans(found: DataFrame, told: DataFrame) -> DataFrame:
    """row, extra (start, end, kind): all places of the words that disclose an entity of their row."""
    held = found.select("row", F.explode("base.entity").alias("entity")).distinct()
    strictest = held.join(told, "entity").groupBy("row", "word").agg(F.max("action").alias("action"))
    condemned = strictest.groupBy("row").agg(F.collect_list("word").alias("words"), F.collect_list("action").alias("actions"))
    # only texts that hold an entity travel
    texts = found.filter("held IS NOT NULL").select("row", F.col("held").alias("text")).join(condemned, "row").dropDuplicates(["row"])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            extra = []
            for text, words, actions in zip(batch["text"], batch["words"], batch["actions"], strict=True):
                action = dict(zip(words, actions, strict=True))
                where, covered, _ = placed(text, [s[:2] for s in base_spans(text)])
                kinds = [action.get(text[a:b].lower()) for a, b in where]
                extra.append([{"start": a, "end": b, "kind": k} for (a, b), k, c in zip(where, kinds, covered, strict=True) if k and not c])
            yield pd.DataFrame({"row": batch["row"], "extra": extra})

    return texts.mapInPandas(find, "row string, extra array<struct<start:int,end:int,kind:string>>")


def spans(docs: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, base and spans (start, end, kind; kinds of words: ``generalise``, ``remove``)."""
    found = written(found_spans(docs, window), "pii-found")
    told = written(disclosures(docs, found, window, threshold), "pii-told")
    extra = word_spans(found, told)
    rank = lambda s: F.array_position(F.lit([*KINDS, "generalise", "remove"]), s["kind"])
    own = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    both = F.concat(own, F.coalesce("extra", F.expr("array()").cast("array<struct<start:int,end:int,kind:string>>")))
    ranked = F.array_sort(F.transform(both, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    plain = F.transform(ranked, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return found.join(extra, "row", "left").select("row", "doc_id", own.alias("base"), plain.alias("spans"))


def joined(spans_column: str) -> Column:
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with their spans and the text in which they are replaced: ``[EMAIL]``, a stem, ``[...]``."""
    told = spans(docs, window, threshold).select("row", F.col("spans").alias("pii_spans")).dropDuplicates(["row"])
    keyed = docs.withColumn("__row", _row())

    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, marks in zip(texts, found, strict=True):
            parts, at = [], 0
            for mark in marks:
                if mark["start"] < at:
                    continue
                word = text[mark["start"] : mark["end"]]
                new = {"generalise": word[:STEM] + "*", "remove": "[...]"}.get(mark["kind"], f"[{mark['kind'].upper()}]")
                parts += [text[at : mark["start"]], new]
                at = mark["end"]
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out)

    clean = F.pandas_udf(replace, "string")(F.coalesce("text", F.lit("")), F.col("pii_spans"))
    return keyed.join(told, keyed["__row"] == told["row"]).drop("row", "__row").withColumn("sanitised", clean)
