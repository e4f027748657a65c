"""Divergence audit, language and lexical search against plain Python, on small and awkward tables."""

import random
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest

from dripline.llm import divergence, languages, lexical
from dripline.llm.common import halves, rows

DOCS = "doc_id long, text string, lang string, source string, size long, rank int, score long, part string, kept long, shard int"
LETTERS = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, digits):
    keep = lambda c: c in LETTERS or c > "\x7f" or digits and c in "0123456789"
    return "".join(c if keep(c) else " " for c in (text or "").translate(LOWER)).split(" ")


def terms(text, digits=False):
    return [t for t in runs(text, digits) if t]


def row(k, text, lang="en", source="s0"):
    return (k, text, lang, source, 1, 1, 1, "x", 1, 1)


@pytest.fixture(scope="module")
def odd(spark):
    draw = random.Random(1)
    word = lambda: draw.choice(["the", "The", "of", "ÉT", "été", "x1y", "a b", "z\x00q", "12"]) + str(draw.randrange(3))
    found = [row(k, " ".join(word() for _ in range(draw.randrange(30))), draw.choice(["en", "fr", None, ""]), draw.choice(["a", "b", "c", None, "é"])) for k in range(400)]
    found += [row(500, None), row(501, ""), row(502, " .,;"), row(503, "lone", "xx", "only"), row(None, "the of the", None, None)]
    found += [row(504, "the of été " * 30_000, "en", "a")] + [row(505, "the the of")] * 4 + [row(506, "...", "en", "wordless")]
    return spark.createDataFrame(found, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def plain_divergence(docs, least=30, top=50):
    uses, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for r in docs:
        lang, source, found = r.lang or "", r.source or "", terms(r.text)
        groups.add((lang, source))
        uses[lang, source].update(found)
        held[lang].update(set(found))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update(uses[lang, s])

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(uses[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            words = [(t, p[s][t] - q[t]) for t in kept if uses[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", words, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, v, k) for k, (item, v) in enumerate(order, 1)}
    return out


def test_divergence(spark, odd, nothing, monkeypatch):
    want = plain_divergence(odd.collect())
    for shard, held, cells in ((50_000, 400_000, 1 << 20), (7, 20, 8)):
        monkeypatch.setattr(divergence, "SHARD", shard)
        monkeypatch.setattr(divergence, "HELD", held)
        monkeypatch.setattr(divergence, "CELLS", cells)
        got = [tuple(r) for r in divergence.source_divergence(odd).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert any(w[0] == "" for w in want) and any(w[1] == "wordless" and w[4] > 0 for w in want)
    assert not any(w[1] == "only" for w in want) and divergence.source_divergence(nothing).count() == 0


def test_shares_are_exact_for_large_counts():
    draw = random.Random(2)
    for _ in range(2000):
        total = draw.randrange(1, 9 * 10**15)
        uses = draw.randrange(1, total + 1)
        assert divergence.shares(np.array([uses]), np.array([total]))[0] == 1 + 10**9 * uses // total


def test_halves_keep_all_rows_in_order():
    batch = rows(text=["x" * (10 ** (k % 5)) for k in range(50)])
    parts = list(halves(batch, 3000))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.nbytes <= 3000 or p.num_rows == 1 for p in parts)


def plain_search(docs, items, top=20):
    found = [(r.doc_id, Counter(terms(r.text, True))) for r in docs]
    n, length = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    asked = defaultdict(Counter)
    for r in items:
        asked[r.item_id].update(terms(r.text, True))
    out = []
    for item, uses in asked.items():
        scores = []
        for doc, c in found:
            m = 75 + 25 * sum(c.values()) * n // max(length, 1)
            scores.append((sum(k * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in uses.items() if c[t]), doc))
        order = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1]))[:top]
        out += [(item, k, doc, s) for k, (s, doc) in enumerate(order, 1)]
    return sorted(out, key=str)


def test_search(spark, odd, nothing, monkeypatch):
    asked = [(1, "the OF été1 été1", 1, 1), (2, "x1y2 of0", 1, 1), (2, "12 of0", 1, 1), (3, None, 1, 1), (4, "", 1, 1), (None, "lone the1 b0", 1, 1), (5, "absent", 1, 1), (6, "the", 1, 1)]
    items = spark.createDataFrame(asked, "item_id long, text string, doc_id long, score int")
    want = plain_search(odd.collect(), items.collect())
    for entries, read, chars in ((2_000_000, 256, 4_000_000), (60, 2, 10)):
        monkeypatch.setattr(lexical, "ENTRIES", entries)
        monkeypatch.setattr(lexical, "READ", read)
        monkeypatch.setattr(lexical, "BLOCK_CHARS", chars)
        got = sorted((tuple(r) for r in lexical.lexical_search(odd, items).collect()), key=str)
        assert got == want
    for docs, some in ((nothing, items), (odd, items.limit(0)), (odd, items.where("item_id = 3"))):
        assert lexical.lexical_search(docs, some).count() == 0


def test_reading_stops_only_when_settled(monkeypatch):
    monkeypatch.setattr(lexical, "READ", 1)
    draw = np.random.default_rng(3)
    for _ in range(300):
        size, score, lists = int(draw.integers(1, 40)), None, []
        score = np.zeros(size, np.int64)
        for _ in range(int(draw.integers(0, 6))):
            docs = draw.permutation(size)[: draw.integers(0, size + 1)]
            impacts = np.sort(draw.integers(0, 6, len(docs)))[::-1].astype(np.int64)
            score[docs] += impacts
            lists.append((docs, impacts))
        most, least = int(draw.integers(1, 8)), int(draw.integers(1, 5))
        at, found = lexical.ranked(lists, size, most, least)
        last = max(least, int(np.sort(score)[::-1][most - 1]) if size >= most else 0)
        assert sorted(at) == np.flatnonzero(score >= last).tolist() and (found == score[at]).all()


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = languages.language_scores(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.98 and all(0 <= r.score <= 1 for r in got)


def test_languages_odd_rows(spark, odd, nothing):
    got = languages.language_scores(odd).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    blank = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (500, 501, 502, 506)}
    assert set(blank.values()) == {("und", 0.0)} and {r.lang_pred for r in got} <= {"en", "fr", "", "xx", "und"}
    assert not any(r.held_out for r in got if r.doc_id is None)
    unlearned = languages.language_scores(odd.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)}
    one = languages.language_scores(odd.where("lang = 'en'")).where("doc_id < 400").collect()
    assert {r.lang_pred for r in one if r.score} == {"en"} and any(r.score for r in one)
    assert languages.language_scores(nothing).count() == 0


def test_machine_separates_and_families_join_the_alike():
    draw = np.random.default_rng(5)
    base = draw.random((2, 64)) / 64
    x = np.abs(np.repeat(base, 60, 0) + draw.normal(size=(120, 64)) / 900)
    y = np.repeat([1.0, -1.0], 60).astype(np.float32)
    w, constant = languages.fit(x, y)
    assert ((x @ w + constant > 0) == (y > 0)).all()
    far, near = np.zeros(9), draw.random(9)
    far[0] = 3
    assert languages.families({"a": far, "b": far + 0.01, "c": near, "d": near * 1.01}) == [["a", "b"], ["c", "d"]]
    assert languages.families({"a": far}) == [["a"]]


def test_words_add_up_to_the_text():
    texts = ["Ein Wort, ein Wort!", "l'été 2020 à Paris", "ß ß", "日本語 テキスト"]
    draw = np.random.default_rng(6)
    weights, constants = draw.normal(size=(languages.WIDTH, 2)), draw.normal(size=2)
    model = languages.Machines([["a"], ["b"]], [], weights, constants)
    for text in texts:
        margins = languages.vector(text) @ weights + constants
        want = "a" if margins[0] >= margins[1] else "b"
        assert model.decide(text, model.memo())[0] == want
