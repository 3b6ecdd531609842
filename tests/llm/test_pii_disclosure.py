"""Disclosure against a plain version on a small corpus, the query's columns included."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

from mercato.llm import pii, queries

SCHEMA = "doc_id long, text string, lang string"


def corpus() -> list[tuple]:
    draw = random.Random(12)
    common = ["wor" + "".join(draw.choices("abcdefgh", k=4)) for _ in range(60)]
    rows = []
    for i in range(80):
        words = draw.choices(common, k=draw.randrange(5, 60))
        if i % 8 == 0:  # a person whose mail meets two telling words
            words[2:2] = ["zorbulon", "ann@mail.example", "keeper"]
            words += draw.choices(common, k=12) + (["Zorbulon", "end"] if i == 0 else [])
        if i % 9 == 0:
            words.insert(1, "call +49 151 2345678 or 10.0.0.1")
        rows.append((i, " ".join(words), "en"))
    rows += [(90, rows[8][1], None), (91, None, None), (92, "", None), rows[16], (None, rows[24][1], "x")]
    return rows


def plain_spans(rows, window=pii.WINDOW, threshold=pii.THRESHOLD) -> dict[tuple, list[tuple]]:
    """(doc_id, text) to its spans: the docstring with dictionaries, texts in memory."""
    texts = [(key, text or "") for key, text, _ in rows]
    entities, both, seen, counts, words_in_all = Counter(), Counter(), defaultdict(set), Counter(), 0
    for _, text in texts:
        words_in_all += text.count(" ") + text.count("\n") + 1
        for word in pii.WORD.findall(text.lower()):
            counts[word] += 1
            if len(word) > pii.STEM:
                counts[word[: pii.STEM] + "*"] += 1
        spans = pii.base_spans(text)
        for *_, kind, value in spans:
            entities[kind, value] += 1
        hit = [m.span() for m in pii.WORD.finditer(text)]
        free = [not any(a < e and s < b for s, e, *_ in spans) for a, b in hit]
        for start, end, kind, value in spans:
            before = [i for i, (a, b) in enumerate(hit) if b <= start][-window:]
            after = [i for i, (a, b) in enumerate(hit) if a >= end][:window]
            near = [text[slice(*hit[i])].lower() for i in (*before, *after) if free[i]]
            for word in near:
                for form in {word, word[: pii.STEM] + "*"} if len(word) > pii.STEM else {word}:
                    both[(kind, value), form] += 0
                    seen[(kind, value), form].add(" ".join(near))
            for word in near:
                both[(kind, value), word] += 1
                if len(word) > pii.STEM:
                    both[(kind, value), word[: pii.STEM] + "*"] += 1
    units = max(1.0, words_in_all / (2 * window + 1))
    share = {}
    for (entity, form), n in both.items():
        if len(seen[entity, form]) > 1:
            information = math.log(max(units / entities[entity], 1.0 + 1e-9))
            share[entity, form] = 1 - math.log(max(counts[form], n) / n) / information
    action = {}
    for (entity, form), value in share.items():
        if value >= threshold and not form.endswith("*"):
            stem_share = share.get((entity, form[: pii.STEM] + "*"))
            safe = len(form) > pii.STEM and stem_share is not None and stem_share < threshold
            action[entity, form] = "generalise" if safe else "remove"
    found = {}
    for key, text in texts:
        spans = pii.base_spans(text)
        own = {(kind, value) for *_, kind, value in spans}
        marks = [(a, pii.KINDS.index(k), b, k) for a, b, k, _ in spans]
        taken = [(a, b) for a, b, *_ in spans]
        for m in pii.WORD.finditer(text):
            kinds = [action[e, m[0].lower()] for e in own if (e, m[0].lower()) in action]
            if kinds and not any(m.start() < b and a < m.end() for a, b in taken):
                kind = max(kinds)
                marks.append((m.start(), 4 if kind == "generalise" else 5, m.end(), kind))
        found[key, text] = [(k, a, b) for a, _, b, k in sorted(marks)]
    return found


def test_query_equals_the_plain_version(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(rows, SCHEMA).repartition(3))
    wanted = plain_spans(rows)
    by_id = defaultdict(set)
    for (key, _), spans in wanted.items():
        by_id[key].add(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    got = queries.personal_data(spark, "").collect()
    assert len(got) == len(rows)
    texts = defaultdict(set)
    for key, text, _ in rows:
        texts[key].add(text or "")
    for row in got:
        assert row["spans"] in by_id[row["doc_id"]]
        base = {",".join(f"{k}:{a}:{b}" for a, b, k, _ in pii.base_spans(t)) for t in texts[row["doc_id"]]}
        assert row["base_sha256"] in {hashlib.sha256(b.encode()).hexdigest() for b in base}
        kinds = Counter(s.split(":")[0] for s in row["spans"].split(",") if s)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [kinds[k] for k in pii.KINDS]
    # the word at the end of the text goes as well, far from the entity
    text = rows[0][1]
    assert f"{text.index('Zorbulon')}:{text.index('Zorbulon') + 8}" in next(r["spans"] for r in got if r["doc_id"] == 0)
