"""Corpus operators against brute force, oracles and hand-made cases: nulls, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from mercato.llm import (
    bpe,
    chat,
    components,
    exact_dedup,
    jaccard_join,
    language_id,
    mixing,
    pii,
    queries,
    simhash,
    substring_dedup,
    tables,
    url_filter,
)
from tools.check import TABLES, table

# the columns after n_chars have names that operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, ids string, spans string, range string"


def words(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(count))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, blank and long texts, equal texts, repeated rows, null ids, sources and languages."""
    texts = [None, "", " \t\n", "One two", "one  two", "One two", words(1, 3000), words(2, 80), words(2, 80), "ünï cödé 漢字 ١٢"]
    rows = [(i, t, "en" if i % 3 else None, "a" if i % 2 else None, None, "k", "i", "s", "r") for i, t in enumerate(texts)]
    rows += [rows[5], rows[7], (None, "One two", None, None, None, None, None, None, None), (None, None, *[None] * 7)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return tables.table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def tokens():
    return bpe.tokenizer(public_tokenizers.path(queries.VOCABULARY))


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.ranks, special_tokens={})


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for each in TABLES:
        duck.execute(f"CREATE VIEW {each} AS SELECT * FROM '{SF}/{each}.parquet'")
    df = registered.queries()[name](spark, SF)
    result = duck.execute(queries.ORACLES[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in result.description], result.fetchall())


def test_components_are_smallest_reachable_ids(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(0, i) for i in range(300, 400)]
    group = {x: x for p in pairs for x in p}
    for _ in range(400):
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    found = components.components(spark.createDataFrame(pairs, "a long, b long"))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.component for r in found.collect()} == {x: group[x] for x in linked}


# exact duplicates


@pytest.mark.parametrize("capacity, bits", [(4096, 64), (1, 64), (2, 2)])
def test_exact_duplicates_of_odd_rows(odd, capacity, bits):
    rows = exact_dedup.exact_duplicates(odd, capacity, bits).collect()
    groups = defaultdict(list)
    for r in odd.collect():
        groups[re.sub(r"[ \t-\r]", "", r.text or "")].append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    assert len(rows) == odd.count() and sum(r.kept for r in rows) == len(groups)
    keep = {hashlib.sha256(t.encode()).hexdigest(): (min(g)[2], len(g)) for t, g in groups.items()}
    assert all((r.keep_id, r.group_size) == keep[r.text_sha256] for r in rows)


def test_deduplicated_keeps_columns_and_one_row_each(odd, none):
    left = exact_dedup.deduplicated(odd)
    assert left.columns == odd.columns and left.count() == 6
    assert exact_dedup.deduplicated(none).count() == exact_dedup.exact_duplicates(none).count() == 0


# Jaccard join


def linked_by_force(texts: dict[int, str]) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return group


@pytest.mark.parametrize("block", [jaccard_join.BLOCK, 400])
def test_near_copies_in_one_block_and_in_many(spark, block):
    draw, texts = random.Random(7), {}
    for i in range(90):
        w = words(i // 30, 60 + 15 * (i % 3)).split()
        for _ in range(draw.randrange(4)):
            w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.linked_documents(df, block).collect()}
    assert found == linked_by_force(texts)


@pytest.mark.parametrize("block", [jaccard_join.BLOCK, 400])
def test_every_link_is_counted(spark, block, monkeypatch):
    draw, texts = random.Random(8), {}
    for i in range(120):
        w = words(i // 40, 60 + 10 * (i % 3)).split()
        for _ in range(draw.randrange(4)):
            w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
        texts[i] = " ".join(w)
        if i % 7 == 0:
            texts[1000 + i] = texts[i].upper()  # a copy is a link
    texts[2000] = texts[2001] = ""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [t.lower().split()]}
    linked = {i: sum(1 for j in sets if i != j and a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j])) for i, a in sets.items()}
    rows = [*texts.items(), (3, texts[3]), (None, texts[3])]  # a repeated row and one without id are no links
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for searched in (0, 10**9):  # all long lists searched, all marked
        monkeypatch.setattr(jaccard_join, "SEARCHED", searched)
        found = jaccard_join.linked_documents(df, block).collect()
        assert {r.doc_id: r.n_links for r in found} == {**linked, None: 0}
        assert all(r.class_id == min(i for i in sets if sets[i] == sets[r.doc_id]) for r in found if r.doc_id is not None and sets[r.doc_id])
    assert sum(linked.values()) > 700


def test_jaccard_of_odd_rows(odd, none):
    rows = {r.doc_id: r for r in jaccard_join.linked_documents(odd).collect()}
    assert [rows[i].n_shingles for i in range(6)] == [0, 0, 0, 1, 1, 1]
    assert [rows[i].component_id for i in range(9)] == [0, 1, 2, 3, 3, 3, 6, 7, 7]
    assert rows[None].component_id in (None, 3)
    assert jaccard_join.linked_documents(none).count() == 0


# byte-level BPE


def test_bpe_equals_the_public_library(tokens, reference):
    draw = random.Random(3)
    points = [*range(32, 127), *range(160, 0x2000), *range(0x3000, 0x3100), 9, 10, 13, 32, 32, 0x1C, 0x2028, 0x1F600]
    texts = ["", "a" * 3000, "ab" * 700, "x²½Ⅷ٣ don't 'llama", "\x1c\x1d a\x85b", "привет мир 漢字"]
    texts += ["".join(map(chr, draw.choices(points, k=draw.randrange(1, 200)))) for _ in range(300)]
    codec = bpe.Codec(tokens)
    ids = codec.encode(texts)
    assert ids.to_pylist() == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode(ids).to_pylist() == [t.encode() for t in texts]


def test_bpe_of_odd_rows(odd, none, tokens, reference):
    made = bpe.decoded(bpe.encoded(odd, tokens), tokens)
    assert made.columns[-2:] == ["ids", "decoded"] and "key" in made.columns
    for r in made.collect():
        assert r.ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.decoded(bpe.encoded(none, tokens), tokens).count() == 0


# mixing


def test_mixture_targets_limits_and_reruns(spark, none):
    rows = [(i, words(i, 20), s) for s, n in (("a", 200), ("b", 600), (None, 300), ("c", 20)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.source: r for r in mixing.source_rates(df).collect()}
    assert sum(r.target for r in rates.values()) == pytest.approx(1.5 * sum(r.source_size for r in rates.values()))
    assert all(r.target <= 2 * r.source_size for r in rates.values())
    taken = mixing.taken(df).collect()
    assert sorted(taken) == sorted(mixing.taken(df.repartition(7)).collect())
    assert all(r.taken <= 2 * r.size for r in taken)
    assert mixing.mixed(df).count() == sum(r.taken for r in taken) / 20
    assert mixing.mixed(df).columns == df.columns and mixing.mixed(none).count() == mixing.taken(none).count() == 0


def test_lookup_above_the_broadcast_bound(spark, odd, monkeypatch):
    broadcast = sorted(mixing.taken(odd).collect(), key=str)
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    assert sorted(mixing.taken(odd).collect(), key=str) == broadcast and len(broadcast) == odd.count()


# chat


LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def test_log_is_folded(spark):
    rows = [
        (1, 1, 1, "message", "user", "hi"),
        (1, 2, 2, "message", "assistant", ""),
        (1, 4, 2, "delta", None, "b"),
        (1, 3, 2, "delta", None, "a"),
        (1, 5, 3, "message", "user", "dropped"),
        (1, 6, 2, "regenerate", None, None),
        (1, 7, 2, "delta", None, "new"),
        (1, 8, 1, "edit", None, "hello"),
        (None, 1, None, "message", None, None),
    ]
    done = chat.folded(spark.createDataFrame(rows, LOG))
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in done.collect()), key=str)
    assert got == [(1, 1, "user", "hello"), (1, 2, "assistant", "new"), (None, None, "", "")]
    assert chat.rendered(spark.createDataFrame([], LOG)).count() == 0


def test_control_strings_survive_and_mask_is_exact(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|im_end|><\\|im_sep|>", "<<SYS>> \\<s>", "[\\\\INST]", None, "ü𝄞<|im_start|>x"]
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c in (1, None) for t, text in enumerate(hostile)]
    rows += [rows[1], (2, None, "<|im_end|>", "odd role")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.rendered(chat.events_of(df))).collect():
        own = sorted(((t is None, t or 0, role, x or "") for c, t, role, x in rows if c == r.conv_id), key=lambda x: x)
        assert [(t.role, t.text) for t in r.turns] == [(role, x) for _, _, role, x in own]
        assert r.learnt == [x for _, _, role, x in own if role == "assistant"]
        assert r.formatted.count("<|im_end|>") == len(own)


# URLs


def test_url_rules_and_precedence(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("a.net", "/en", "allow"), ("a.net", "/en", "block"), ("org", "/", "allow")],
        "host string, path string, action string",
    )
    urls = {
        "http://A.net/english?x": ("a.net", "/english", "a.net/en", "block"),
        "x://b.a.net/en#t": ("b.a.net", "/en", "a.net/en", "block"),
        "x://ba.net/en": ("ba.net", "/en", "net/", "block"),
        "x://net": ("net", "", None, "allow"),
        "x://" + "l." * 5000 + "org/": ("l." * 5000 + "org", "/", "org/", "allow"),
        "a.net/en": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(1, u, "r") for u in [*urls, None, "x://net"]], "page_id long, url string, rule string")
    rows = url_filter.judged(pages, rules)
    want = [urls[u] for u in [*urls, None, "x://net"]]
    assert sorted(((r.host, r.path, r.rule, r.verdict) for r in rows.collect()), key=str) == sorted(want, key=str)
    assert url_filter.judged(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judged(pages, rules.limit(0)).collect()} == {"allow"}


# passages


def test_windows_are_cartesian_tree_nodes():
    def plain(values, least):
        found, left = [], [(0, len(values) - 1)]
        while left:
            a, b = left.pop()
            if b - a + 1 >= least:
                c = a + int(values[a : b + 1].argmin())
                found.append((a, c, b))
                left += [(a, c - 1), (c + 1, b)]
        return found

    draw = np.random.default_rng(2)
    for high in (3, 50, 10**9):
        parts = [draw.integers(0, high, draw.integers(1, 300)).astype(np.uint64) for _ in range(20)]
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - np.array([len(p) for p in parts])
        made = substring_dedup.compact_windows(np.concatenate(parts), starts, ends - 1, 7)
        want = [(a + s, c + s, b + s) for s, p in zip(starts, parts, strict=True) for a, c, b in plain(p, 7)]
        assert sorted(zip(*made, strict=True)) == sorted(want)


def test_every_repeated_passage_is_found(spark, none):
    passage, edited = words(99, 55), words(98, 200).split()
    rows = [(i, f"{words(i, 70)} {passage.upper() if i == 4 else passage}\n{words(i + 50, 40)}") for i in range(8)]
    rows += [(20, words(20, 300)), (21, " ".join(edited)), (22, " ".join([*edited[:60], "x", *edited[61:130], "y", *edited[131:]]))]
    rows += [(30, None), (31, ""), (None, passage), rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit("x"))
    texts = dict(rows)
    places = substring_dedup.repeated_passages(df).collect()
    found = [r for r in places if r.removed]
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5, 6, 7, 22} and {0, 21} <= {r.keep_id for r in found}
    assert {r.doc_id for r in places if not r.removed} == {0, 21}
    assert all(passage in texts[r.doc_id][r.start : r.end].lower() for r in found if r.keep_id == 0)
    assert any(r.n_words == 200 for r in found if r.doc_id == 22)
    short = {r.doc_id: r.text for r in substring_dedup.without_repeats(df).collect()}
    assert passage in short[0] and passage not in short[4].lower() and short[20] == texts[20] and short[30] is None
    assert substring_dedup.repeated_passages(none).count() == 0


def test_holders_of_parts_do_not_hide_repeated_runs(spark):
    draw, rows = random.Random(11), []
    for group in range(12):
        passage, texts = words(1000 + group, draw.choice([50, 55, 70, 120])).split(), []
        for k in range(14):
            size = len(passage) if k % 3 == 2 else draw.randrange(28, 50)  # most hold a part that is too short
            at = draw.randrange(len(passage) - size + 1)
            texts.append(f"{words(5000 + 100 * group + k, 40)} {' '.join(passage[at : at + size])} {words(9000 + 100 * group + k, 40)}")
        rows += [(100 * group + k, t) for k, t in enumerate(texts)]
    line = words(77, 9)
    rows += [(5000, f"{words(78, 30)} {line * 12}"), (5001, f"{line * 9} {words(79, 30)}")]  # a passage that repeats itself
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = defaultdict(list)
    for r in substring_dedup.repeated_passages(df).filter("removed").collect():
        removed[r.doc_id].append((r.start, r.end))
    seen, missed, repeated = set(), [], 0
    for i, text in sorted(rows):
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        runs = [(text[spans[k][0] : spans[k + 49][1]], spans[k][0], spans[k + 49][1]) for k in range(len(spans) - 49)]
        for run, start, end in runs:
            if run in seen:
                repeated += 1
                missed += [(i, start)] * (not any(a <= start and end <= b for a, b in removed[i]))
        seen |= {run for run, _, _ in runs}
    assert repeated > 300 and not missed


# fingerprints


def test_successors_edits_and_votes(spark, texts, docs, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_ROWS", 17)
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in simhash.compared(docs).collect()}
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        half = len(texts[i]) // 2
        body = texts[i][: len(texts[i]) - half] + texts[following][:half]
        assert rows[i].edited_sha256 == hashlib.sha256(body.encode()).hexdigest()
        apart = bin((rows[i].hi ^ rows[following].hi) & (1 << 64) - 1).count("1")
        apart += bin((rows[i].lo ^ rows[following].lo) & (1 << 64) - 1).count("1")
        assert rows[i].near_next == 1 - apart / 128
    hashes = spark.createDataFrame([(texts[order[0]],)], "text string").select(simhash.terms(F.col("text")).alias("t")).first().t
    hi = sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))
    assert rows[order[0]].hi & (1 << 64) - 1 == hi


def test_neighbours_equal_brute_force(spark):
    draw, prints = random.Random(1), []
    for _ in range(40):
        base = draw.getrandbits(128)
        for _ in range(4):
            flipped = base
            for _ in range(draw.randrange(7)):
                flipped ^= 1 << draw.randrange(128)
            prints.append(flipped)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    pairs = [(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints]
    df = spark.createDataFrame(pairs, "hi long, lo long")
    for radius in (0, 4):
        got = {(r.hi, r.lo, r.near_hi, r.near_lo) for r in simhash.neighbours(df, df, radius).collect()}
        want = {(*a, *b) for a, p in zip(pairs, prints, strict=True) for b, q in zip(pairs, prints, strict=True) if bin(p ^ q).count("1") <= radius}
        assert got == want


def test_near_copies_are_found_and_named(spark):
    draw, texts = random.Random(5), {}
    for group in range(40):
        base = words(300 + group, 180).split()
        texts[1000 * group] = " ".join(base)
        texts[1000 * group + 1] = " ".join(base).upper()  # the same class
        for k in range(2, 8):  # 1 to 4 changes in 180 words: 5-word Jaccard from 0.95 to 0.8
            copy = list(base)
            for place in draw.sample(range(4, 176), 1 + k % 4):
                copy[place] = f"new{draw.randrange(10**6)}"
            texts[1000 * group + k] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r.doc_id: r for r in simhash.fingerprinted(df).collect()}
    bits = {i: int(r.fingerprint, 16) for i, r in rows.items()}
    found = expected = 0
    for i in range(0, 40_000, 1000):
        near = [j for j in bits if j != i and bin(bits[i] ^ bits[j]).count("1") <= 20]
        assert rows[i].n_near == len(near)
        assert rows[i].near_ids == sorted({rows[j].class_id for j in near} - {rows[i].class_id})
        assert rows[i + 1].class_id == rows[i].class_id == i and rows[i + 1].near_ids is None
        shingled = {j: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for j in range(i, i + 8) if (w := texts[j].lower().split())}
        similar = [j for j in range(i + 1, i + 8) if 10 * len(shingled[i] & shingled[j]) >= 8 * len(shingled[i] | shingled[j])]
        expected += len(similar)
        found += len(set(similar) & set(near))
    print(f"recall {found} of {expected}")
    assert expected > 200 and found >= 0.97 * expected


def test_fingerprints_of_odd_rows(odd, none):
    rows = simhash.fingerprinted(odd).collect()
    assert len(rows) == odd.count()
    by_text = defaultdict(set)
    for r in rows:
        if r.doc_id in (0, 1, 2, 3, 5, 7, 8):
            by_text[{0: 1, 2: 1, 5: 3, 8: 7}.get(r.doc_id, r.doc_id)].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and by_text[1] == {"0" * 32}
    assert simhash.fingerprinted(none).count() == 0
    alone = simhash.fingerprinted(odd.filter("doc_id = 6")).first()
    assert alone.near_next == 1.0


# language


@pytest.fixture(scope="module")
def model(docs):
    return queries.language_model(docs)


def test_held_out_languages(spark, docs):
    told = registered.queries()["op1_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    right = told.filter("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97


def test_spans_of_mixed_text_and_odd_rows(spark, odd, none, docs, model):
    parts = {r.lang: r.text[:600] for r in docs.filter("length(text) > 700").orderBy("doc_id").collect()}
    mixed = spark.createDataFrame([(1, parts["en"] + " " + parts["de"])], "doc_id long, text string")
    row = language_id.identified(mixed, model).first()
    assert [s.lang for s in row.spans] == ["en", "de"] and abs(row.spans[1].start - 601) < 40
    rows = {r.doc_id: r for r in language_id.identified(odd, model).collect()}
    assert [rows[i].lang_pred for i in range(3)] == ["und"] * 3 and rows[0].spans == [] and rows[0].score == 0
    foreign = spark.createDataFrame([(1, "привет мир"), (2, "² ½ 123")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in language_id.identified(foreign, model).orderBy("doc_id").collect()] == [("en", 0.0), ("und", 0.0)]
    assert language_id.identified(none, model).count() == 0
    assert language_id.identified(odd, language_id.train(none)).filter("lang_pred <> 'und'").count() == 0


# personal data


def test_base_spans_equal_plain_patterns(texts):
    def plain(text):
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            found += [(m.start(), 1, m.end())] if all(int(p) <= 255 for p in m[0].split(".")) else []
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits)))
            found += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and total % 10 == 0 else []
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            found += [(m.start(), 3, m.end())] if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
        return [(a, b, pii.KINDS[k]) for a, k, b in sorted(found)]

    draw = random.Random(4)
    samples = ["".join(draw.choices("ab@.-+%_ 0123456789()\n", k=80)) for _ in range(3000)]
    samples += ["a@b.c@d.e_x@f.g", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+1 (743) 555-3824", "", "@a.b", "x" * 100_000]
    for text in [*samples, *texts.values()]:
        assert [s[:3] for s in pii.base_spans(text)] == plain(text)


@pytest.mark.parametrize("text, kinds", [("10.0.0.1@host.com", ["email", "ip"]), ("4111111111111111@x.com", ["email", "card"]),
                                         ("+4915112345678@sms.example.com", ["email", "phone"])])
def test_base_spans_of_one_start_come_by_kind(text, kinds):
    assert [s[2] for s in pii.base_spans(text) if s[0] == 0] == kinds


def test_disclosing_words(spark, none):
    rows = [(i, f"{words(i, 12)} the zorbulon wizard writes from jo@x.org about {words(i + 99, 12)}") for i in range(6)]
    rows += [(i, f"{words(i, 30)} the wizard writes from here about {words(i + 7, 30)}") for i in range(10, 200)]
    rows += [(300, None), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("entity", F.lit(1))
    told = {r.doc_id: r for r in pii.spans(df).collect()}
    hidden = lambda i: {dict(rows)[i][s.start : s.end] for s in told[i].spans}
    assert hidden(1) == {"jo@x.org", "zorbulon"} and hidden(20) == set() and told[300].spans == []
    assert all(" zorbulon" not in r.sanitised and "[EMAIL]" in r.sanitised for r in pii.sanitised(df).filter("doc_id < 6").collect())
    assert pii.spans(none).count() == 0


def test_counting_bitmap_uses_spark_hashes(spark):
    forms = ["abc", "ünï*", ""]
    rows = spark.createDataFrame([(f,) for f in forms], "f string").select("f", F.pmod(F.xxhash64("f"), F.lit(pii.BITS)).alias("at"))
    assert {r.f: r.at for r in rows.collect()} == {f: pii._bit(f) for f in forms}


# pipeline


def test_stages_keep_columns_and_take_effect(spark, odd):
    shape = odd.select("doc_id", "text", "lang", "source", "n_chars")
    docs, left = shape.filter("doc_id IS NOT NULL"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = tables.written(stage(spark, docs, SF), f"test-{name}")
        assert name == "byte_bpe" or docs.columns == shape.columns
        left.append(docs.count())
    assert left[:3] == [9, 5, 4] and left[4] == left[3]


def test_stages_of_an_empty_table(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_rows_equal_a_plain_version(spark, docs, reference, tmp_path):
    shape = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = sorted(tuple(r) for r in docs.select(*shape).filter("doc_id IS NOT NULL").collect())[:150]
    for n, (i, text, lang, source, _) in enumerate(rows[:60]):
        changed = text.split()
        changed[len(changed) // 2] = f"new{n}"
        for k, other in enumerate([text + " ", "\n".join(text.split(" ")), " ".join(changed)]):
            rows.append((10**6 + 10 * i + k, other, lang, source, None))  # a longer copy, an equal one, a near one
    rows += [(2 * 10**6 + n, f"{rows[n][1]} {rows[n + 1][1]}", rows[n][2], "hot", None) for n in range(60, 149)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "documents.parquet"))
    told = {r.doc_id for r in queries.language(spark, str(tmp_path)).collect() if r.lang_pred != language_id.UNKNOWN}
    best = {}
    for i, text, *_ in rows:
        if i in told:
            plain = re.sub(r"[\x20\x09-\x0D]+", "", text)
            best[plain] = max(best.get(plain, (-1, 0, "")), (len(text), -i, text))
    single = {-i: text for _, i, text in best.values()}
    group = linked_by_force(single)
    left = {i: text for i, text in single.items() if group[i] == i}
    assert len(told) > len(single) > len(left)
    of = {i: (lang, source) for i, _, lang, source, _ in rows}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for i, text in left.items()}
    sums = defaultdict(int)
    for i, n in size.items():
        sums[of[i][1]] += n
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sums))}
    target, open_ = {}, set(sums)
    while open_:  # rounds: what a full source cannot take goes to the others
        level = (1.5 * sum(sums.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sums[s]}
        target |= {s: 2.0 * sums[s] for s in full} if full else {s: weight[s] * level for s in open_}
        open_ = open_ - full if full else set()
    want = defaultdict(int)
    for i, text in left.items():
        lang, source = of[i]
        rate = target[source] / sums[source]
        coin = int(hashlib.md5(f"{i}:17".encode()).hexdigest()[:13], 16) / 2**52
        times = int(rate) + (coin < rate - int(rate))
        if times:
            ids = tuple(reference.encode_ordinary(text))
            want[i, lang, source, len(ids), ids] = times
    found = defaultdict(int)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        found[r.doc_id, r.lang, r.source, r.n_tokens, tuple(r.ids)] += 1
    assert found == want
