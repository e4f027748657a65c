"""Operators of the optional subpackage against plain Python, on small and awkward tables."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dripline.llm import common, decontamination, jaccard, mixing, neighbours, private, quality, repeats, tokens, toxicity, warc
from dripline.llm.queries import op1, op7

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, node long"


def words_of(seed, n):
    draw = random.Random(seed)
    return [f"w{draw.randrange(3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, texts and sources, blanks, copies, near copies, ties, a long text, clashing columns."""
    base = words_of(1, 200)
    near = base[:100] + ["changed"] + base[101:]
    texts = [None, "", " \t\n", "one two", "One  TWO", " ".join(base), " ".join(base), " ".join(near), " ".join(words_of(2, 30_000)), "Ünïcode é " * 40]
    rows = [(k, t, "en", f"s{k % 3}" if k else None, 0, k, -k) for k, t in enumerate(texts)]
    rows += [(None, "no id here", None, None, None, 1, 1), (5, " ".join(base), "en", "s2", 0, 5, -5)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def classes(texts: dict):
    sets, parent = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k in sorted(sets):
        for g in sets[k]:
            holders[g].append(k)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), top(k)) for k in texts}


def test_jaccard_odd_rows(spark, odd):
    got = jaccard.jaccard_classes(odd).collect()
    assert len(got) == odd.count()
    want = classes({r.doc_id: r.text for r in odd.collect() if r.doc_id is not None})
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want


def test_jaccard_frequent_shingles_and_many_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 5)
    monkeypatch.setattr(jaccard, "MEMBERS", 7)
    draw, texts = random.Random(3), {}
    bases = [words_of(b, 60) for b in range(3)]
    for k in range(120):
        w = list(bases[k % 3])
        for _ in range(draw.randrange(4)):
            w[draw.randrange(60)] = f"x{draw.randrange(9)}"
        texts[k] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(df).collect()}
    assert got == classes(texts)


def test_a_task_holds_one_bucket_of_signatures(spark):
    buckets, entries = 8, []
    for sig in range(3 * buckets):
        size = 9 if sig < buckets else 2
        e = np.array([(sig, 100 * sig + k, 10) for k in range(size)], jaccard.ENTRY)
        entries += [(sig % buckets, e[: size // 2].tobytes()), (sig % buckets, e[size // 2 - 1 :].tobytes())]
    sent = spark.createDataFrame([(b, bytearray(d), None, None, None, None, None, None) for b, d in entries], jaccard.SENT)
    got = jaccard._groups(sent, buckets).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.sig, r.node) for r in got if r.sig is not None) == [(s, 100 * s + k) for s in range(buckets) for k in range(9)]
    assert sorted((r.node, r.other) for r in got if r.other is not None) == [(100 * s, 100 * s + 1) for s in range(buckets, 3 * buckets)]
    held = defaultdict(set)
    for r in got:
        held[r.task].add((r.sig if r.other is None else r.node // 100) % buckets)
    assert len(held) == buckets and all(len(b) == 1 for b in held.values())


def test_a_bucket_is_paired_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIECE", 4)
    sizes, buckets, entries = {0: 5, 3: 2, 6: 9, 9: 3, 12: 1}, 3, []
    for sig, size in sizes.items():
        e = np.array([(sig, 100 * sig + k, 10) for k in range(size)], jaccard.ENTRY)
        entries += [(0, bytearray(half.tobytes()), *[None] * 6) for half in (e[::2], e[1::2])]
    got = jaccard._groups(spark.createDataFrame(entries, jaccard.SENT), buckets).collect()
    pairs = {(100 * s + a, 100 * s + b) for s, n in sizes.items() if n <= jaccard.SMALL_GROUP for b in range(n) for a in range(b)}
    assert sorted((r.node, r.other) for r in got if r.other is not None) == sorted(pairs)
    assert sorted((r.sig, r.node) for r in got if r.sig is not None) == [(6, 600 + k) for k in range(9)]


def test_likely_pairs_come_in_parts():
    count = 700
    s = np.arange(40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    node, n = np.arange(count) + 5, np.full(count, len(s))
    parts = list(jaccard.likely_pairs(node, n, node, [jaccard.bitmap(s, 1)] * count, np.full(count, 2)))
    assert max(map(len, parts)) < jaccard.ROWS + count and len(parts) > 3
    assert sorted(map(tuple, np.concatenate(parts).tolist())) == [(a + 5, b + 5) for a in range(count) for b in range(a + 1, count)]
    assert not list(jaccard.likely_pairs(node, n, node * 0, [jaccard.bitmap(s, 1)] * count, np.full(count, 2)))


def test_a_pair_that_meets_in_many_groups_is_sent_once(monkeypatch, spark):
    s = np.arange(40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    nodes = spark.createDataFrame([(k, bytearray(jaccard.bitmap(s, jaccard.BRIEF))) for k in range(4)], "node long, brief binary")
    rest = spark.createDataFrame([(sig, k, 40, k) for sig in range(50) for k in range(4)], "sig long, node long, n long, of long")
    monkeypatch.setattr(type(rest), "distinct", lambda df: df)
    got = [tuple(r) for r in jaccard._within_groups(rest.coalesce(1), nodes).collect()]
    pairs = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    assert sorted(set(got)) == pairs and len(got) <= 8 * len(pairs)  # of 50 each


def test_bitmaps_tell_short_texts_apart():
    draw = np.random.default_rng(3)
    for n in (100, 396, 900):
        x = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        y = np.r_[x[: n * 5 // 6], draw.integers(0, 2**63, n - n * 5 // 6).astype(np.uint64)]  # similar by 0.71
        assert 7 * jaccard.bits_apart(jaccard.bitmap(x, jaccard.BRIEF), jaccard.bitmap(y, jaccard.BRIEF)) > 2 * n


def test_a_worker_keeps_what_its_last_task_asked_for():
    class Here:
        def mapInArrow(self, run, schema):
            return lambda: list(run(iter([pa.record_batch({"a": [1, 2]})])))

    made = []

    def task(*names):
        def make():
            for name in names:
                common.per_process(name, lambda: made.append(name))
            return lambda batch: iter([batch])

        assert common.map_rows(Here(), make, "a long")()[0].num_rows == 2

    task("x", "y")
    task("x")
    task("x", "y")
    assert made == ["x", "y", "y"]
    task()
    task("x")
    assert made == ["x", "y", "y", "x"]


def test_sent_batches_are_cut():
    class Plan:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    big = common.rows(x=pa.array(range(1_500_000), pa.int64()))
    run = common.map_rows(Plan(), lambda: lambda batch: iter([big]), "x long", last=True)
    out = list(run(iter([big.slice(0, 1)])))
    assert pa.Table.from_batches(out).column("x").to_pylist() == 2 * list(range(1_500_000))
    assert max(b.nbytes for b in out) <= common.PART_BYTES


def test_bitmaps_never_exceed_the_difference():
    draw = np.random.default_rng(1)
    for n, m in ((100, 120), (700, 500), (5, 6)):
        both = draw.integers(0, 1 << 62, n // 2).astype(np.uint64)
        x, y = (np.unique(np.r_[both, draw.integers(0, 1 << 62, k - n // 2).astype(np.uint64)]) for k in (n, m))
        for each in (jaccard.BITS, jaccard.BRIEF):
            assert jaccard.bits_apart(jaccard.bitmap(x, each), jaccard.bitmap(y, each)) <= len(np.setxor1d(x, y))


def test_neighbours(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, 8)).astype(np.float32).astype(float)
    x[7], x[9] = x[3], x[3]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(600, None, 1), (601, [0.0] * 8, 1), (602, [float("nan")] * 8, 1), (603, [None] * 8, 1), (None, [1.0] * 8, 1), (604, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = defaultdict(dict)
    for r in neighbours.approximate_neighbours(df, df.where("vec_id % 20 = 0 or vec_id = 3")).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    u, hit = x / np.linalg.norm(x, axis=1, keepdims=True), 0
    for q, found in got.items():
        near = u @ u[q]
        near[q] = -9
        best = sorted(range(600), key=lambda k: (-round(near[k], 12), k))[:5]
        hit += len(set(best) & {v for v, _ in found.values()})
        assert sorted(found) == [1, 2, 3, 4, 5] and all(abs(near[v] - s) < 1e-12 for v, s in found.values())
    assert hit / (5 * len(got)) >= 0.9 and [got[3][1][0], got[3][2][0]] == [7, 9]
    assert neighbours.approximate_neighbours(df.limit(0), df).count() == 0


def test_scores_on_held_out_rows(spark, odd, nothing):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    for run, name, least in ((quality.quality_scores, "quality", 0.95), (toxicity.toxicity_scores, "toxic", 0.9)):
        seen = run(docs, labels).join(labels, "doc_id").where("held_out").collect()
        assert sum(r.predicted == r[name] for r in seen) / len(seen) >= least
        out = run(odd, labels).collect()
        assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
        assert run(nothing, labels).count() == 0
        assert {r.score for r in run(odd, labels.limit(0)).collect()} == {0.5}


def test_chain_marginals_against_enumeration():
    draw = np.random.default_rng(4)
    score, steps = draw.normal(size=(4, 1)), draw.normal(size=(2, 2))
    weight, total, steps_seen = np.zeros(4), 0.0, np.zeros((2, 2))
    for code in range(16):
        y = [code >> k & 1 for k in range(4)]
        w = np.exp(sum(score[k, 0] * y[k] for k in range(4)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
        total += w
        weight += w * np.array(y)
        for a, b in zip(y, y[1:]):
            steps_seen[a, b] += w
    p, expected = toxicity.expected_steps(score, steps, np.ones((4, 1), bool))
    assert np.allclose(p[:, 0], weight / total) and np.allclose(expected, steps_seen / total)


def test_marginals_of_chains_over_several_columns():
    draw = np.random.default_rng(7)
    steps = draw.normal(size=(2, 2))
    for sizes in ([10], [3, 4, 5], [1, 9, 4, 2, 30]):
        score, high = [draw.normal(size=n) * 3 for n in sizes], 4
        columns = [(s[k : k + high], k // high) for s in score for k in range(0, len(s), high)]
        grid, held = np.zeros((high, len(columns))), np.zeros((high, len(columns)), bool)
        for k, (part, _) in enumerate(columns):
            grid[: len(part), k], held[: len(part), k] = part, True
        got = toxicity.marginals(grid, steps, held, np.array([place for _, place in columns]))
        cut = np.concatenate([got[: len(part), k] for k, (part, _) in enumerate(columns)])
        whole = [toxicity.marginals(s[:, None], steps, np.ones((len(s), 1), bool), np.zeros(1, int))[:, 0] for s in score]
        assert np.allclose(cut, np.concatenate(whole), atol=1e-12)


def test_word_evidence_counts_all_documents(spark):
    draw = random.Random(9)
    found = [(" ".join(draw.choice(["a", "B.", "c", "vile" if y else "mild", "d"]) for _ in range(6)), y) for y in [0, 1] * 100]
    known = toxicity.evidence(spark.createDataFrame(found, "text string, y long").repartition(7))
    sides = [[{toxicity.plain(w) for w in t.split()} for t, y in found if y == k] for k in (0, 1)]
    for word, odds in known.odds.items():
        (clean, n), (toxic, m) = ((sum(word in d for d in side), len(side)) for side in sides)
        assert abs(odds - np.log((toxic + 0.5) / (m + 1.5 - toxic)) + np.log((clean + 0.5) / (n + 1.5 - clean))) < 1e-9
    assert known.telling == {"vile"} and {"vile", "mild"} <= set(known.odds)


def test_decontamination(spark, odd, nothing):
    item = words_of(50, 30)
    edited = item[:6] + ["new"] + item[6:14] + item[15:22] + ["other"] + item[23:]
    docs = {1: " ".join(words_of(51, 80) + item + words_of(52, 80)), 2: " ".join(words_of(53, 40) + edited), 3: " ".join(words_of(54, 200)), 4: " ".join(w.upper() + "!!" for w in item)}
    docs |= {100 + k: " ".join(item) for k in range(40)}
    df = spark.createDataFrame([*docs.items(), (None, " ".join(item)), (7, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (None, "a b c"), (11, ""), (12, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(df, bench).collect()}
    assert set(got) == {(k, 9) for k in docs if k != 3}
    assert got[1, 9] == 1 and 0.7 < got[2, 9] < 1
    assert decontamination.contaminated(nothing, bench).count() == 0 and decontamination.contaminated(odd, bench.limit(0)).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def fits(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "phone":
            return 9 <= len(d) <= 15
        return kind == "email" or 13 <= len(d) <= 19 and private.luhn(d)

    return [(k, *m.span()) for k, p in BASE.items() for m in re.finditer(p, text) if fits(k, m[0])]


def test_personal_data_spans_and_counts(spark, odd, nothing):
    draw = random.Random(5)
    for _ in range(3000):
        text = "".join(draw.choice("aZ9.@@+- 1255(0)") for _ in range(draw.randrange(60)))
        assert private.base_spans(text) == plain_spans(text), text
    rows = [(k, "write zebra to a.b@c.org now" if k < 3 else "now write to somebody") for k in range(9)]
    got = private.personal_digests(spark.createDataFrame([*rows, (None, None)], "doc_id long, text string")).collect()
    first = next(r for r in got if r.doc_id == 0)
    assert first.spans == "email:15:24,remove:6:11" and first.n_email == 1
    assert first.base_sha256 == hashlib.sha256(b"email:15:24").hexdigest()
    assert next(r for r in got if r.doc_id is None).base_sha256 == hashlib.sha256(b"").hexdigest()
    assert private.personal_digests(odd).count() == odd.count() and private.personal_digests(nothing).count() == 0
    clean = private.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 0").first().text
    assert "zebra" not in clean and "[email]" in clean


def test_warc_round_trip(spark):
    page = '<html><head><title>A &amp; B</title><script>x<y</script></head><body><p>Hi <b>there</b></p><a href="/l?a=1&amp;b=2">go</a></body>'
    pages = spark.createDataFrame([(1, "http://a/", page, "x"), (2, None, None, "x"), (1, "http://a/", page, "x")], "page_id long, url string, html string, record_id string")
    responses = warc.response_members(pages)
    got = [r for r in warc.read_records(warc.derived(responses)).collect() if r.page_id == 1]
    source = warc.read_records(responses).where("page_id = 1").first()
    assert len(got) == 4 and {r.refers_to for r in got} == {source.record_id} and all(r.digest_holds for r in got)
    notes = next(bytes(r.block).decode() for r in got if r.warc_type == "metadata")
    assert "title: A & B" in notes and "outlink: /l?a=1&b=2" in notes and "http-header-content-type: text/html" in notes
    assert next(bytes(r.block).decode() for r in got if r.warc_type == "conversion") == "A & B\nHi there\ngo"
    assert warc.page_derivatives(pages).count() == 6 and warc.page_derivatives(pages.limit(0)).count() == 0


def test_pages_beyond_ascii_are_scanned_as_fast():
    assert warc.scanned("<TITLE>İK\u212a\udc80</TITLE><A HREF='É'>É</A><SCRIPT>x</SCRIPT>ß") == ("\nİK\u212a\udc80\nÉ ß", "İK\u212a\udc80", ["É"])
    page, spent = "<p>" + "é" * 3_000_000, []
    for _ in range(3):
        began = time.process_time()
        warc.scanned(page)
        spent.append(time.process_time() - began)
    assert min(spent) < 0.2  # as fast as one of ASCII alone


def test_pages_of_any_kind(spark):
    """Odd charsets, codings, lengths and tags have defined results, and long malformed pages take no long time."""
    import gzip
    import time

    for name in ("idna", "undefined", "punycode", "base64", "rot13", "nonsense", "utf-16"):
        text, used = warc.decoded(b"plain \xc3\xa9", f"text/html; charset={name}")
        assert used == ("utf-16" if name == "utf-16" else "utf-8") and (name == "utf-16" or text == "plain é")
    for piece in ("<a ", "<title", "<title>", "<script", "<script>", "<!--", "<p", "</", "<a href=", "<a href='", "< ", "&lt"):
        began = time.time()
        warc.scanned(piece * (1_000_000 // len(piece)))
        assert time.time() - began < 2, piece
    page = "<TITLE>x &lt; y</TITLE ><p>a<b>c</b><BR/>d < e<!-- no --><style>z</style ><A class=q HREF=u>l</a><a href='v&amp;w'>m</a><script>never"
    assert warc.plain_text(page) == "x < y\nac\nd < e lm" and warc.scanned(page)[1:] == ("x &lt; y", ["u", "v&amp;w"])
    packed = gzip.compress("<p>é".encode())
    chunks = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in (packed[:7], packed[7:])) + b"0\r\n\r\n"
    http = [("Transfer-Encoding", "chunked"), ("Content-Encoding", "gzip")]
    assert warc.payload(http, chunks) == "<p>é".encode() and warc.payload(http, b"not chunked") == b"not chunked"
    good = warc.member(warc.record("response", [("WARC-Record-ID", "a")], b"HTTP/1.1 200 OK\r\n\r\nhi"))
    bad = b"WARC/1.1\r\nContent-Length: ten\r\n\r\n"
    assert warc.opened(good + good[:-9]) == warc.opened(good) and warc.opened(b"junk") == b"" and warc.opened(None) == b""
    assert [b for _, b in warc.parsed(bad + warc.opened(good))] == [b"HTTP/1.1 200 OK\r\n\r\nhi"]
    rows = [(1, good), (2, good[:20]), (3, None), (None, good), (4, warc.member(bad))]
    got = warc.derived(spark.createDataFrame(rows, "page_id long, member binary")).collect()
    assert sorted((r.page_id or 0, r.kind) for r in got) == [(0, "conversion"), (0, "metadata"), (1, "conversion"), (1, "metadata")]


def test_terms_beside_other_blanks_are_judged(spark):
    rows = [(k, "write zebra\u00a0fish to a.b@c.org now" if k < 3 else "now write to somebody") for k in range(9)]
    got = private.personal_digests(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 0").first()
    assert "remove:6:16" in got.spans


def plain_repeats(texts: dict):
    seen, out = set(), {}
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 99):
            s = raw[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]]) if raw else b""
        out[k] = (len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    monkeypatch.setattr(repeats, "CHUNK", 50)
    line = " ".join(words_of(60, 12))
    texts = {k: " ".join(words_of(k, 40)) + line * (k % 3) + " ".join(words_of(k // 4, 30)) for k in range(60)}
    texts |= {100: "ab" * 900, 101: "ba" * 900, 102: "", 103: None}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string").repartition(4)
    row = lambda r: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
    assert {r.doc_id: row(r) for r in repeats.repeat_digests(df).collect()} == plain_repeats(texts)
    own = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    got = repeats.repeat_digests(odd).collect()
    assert len(got) == odd.count() and {r.doc_id: row(r) for r in got if r.doc_id is not None} == plain_repeats(own)
    assert repeats.repeat_digests(nothing).count() == 0


def test_buckets_of_repeats_have_a_task_each(spark, monkeypatch):
    """Rows of one task reach Python in one batch, so buckets that share a task cost memory."""
    monkeypatch.setattr(repeats, "BUCKET", 100)
    draw = np.random.default_rng(7)
    texts = {k: "".join(map(chr, draw.integers(97, 123, 1500))) for k in range(80)}
    texts |= {k + 80: texts[k][:500] + texts[k + 1][:700] for k in range(30)}
    dealt, inner = [], repeats._reduced

    def reduced(gathered, buckets):
        own = gathered.where("data is not null").repartition(buckets, "bucket").groupBy(F.spark_partition_id())
        dealt.append((buckets, [r["n"] for r in own.agg(F.countDistinct("bucket").alias("n")).collect()]))
        return inner(gathered, buckets)

    monkeypatch.setattr(repeats, "_reduced", reduced)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    row = lambda r: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
    assert {r.doc_id: row(r) for r in repeats.repeat_digests(df).collect()} == plain_repeats(texts)
    assert len(dealt) == 2 and all(buckets >= 32 and len(n) >= 32 and max(n) == 1 for buckets, n in dealt)


def test_many_surroundings_of_one_string():
    """300,000 surroundings of one Q-gram with a low hash, which is the anchor of all strings around it."""
    draw = np.random.default_rng(8)
    flat = draw.integers(0, 256, repeats.SEGMENT, dtype=np.uint8)
    g, _, first, _ = repeats.anchors(flat)
    low, at = int(g.min()), int(first[g.argmin()])
    while repeats.anchors(flat[at + 1 : at + 1 + repeats.LENGTH])[0][0] == low:
        at += 1
    gram, side, seen = flat[at : at + repeats.Q], repeats.LENGTH - repeats.Q, {}
    for _ in range(1200):
        raw = draw.integers(0, 256, (250, side + repeats.Q + side), dtype=np.uint8)
        raw[:, side : side + repeats.Q] = gram
        g, c, first, last = repeats.anchors(raw.ravel())
        ours, flat = g == low, raw.ravel()
        for key, a, b in zip(c[ours].tolist(), first[ours], last[ours]):
            own = flat[a : b + repeats.LENGTH].tobytes()
            assert seen.setdefault(key, own) == own
    assert len(seen) >= 290_000


def test_mixing(spark, odd, nothing):
    assert mixing.targets([10, 10, 10], [3, 1, 2]) == [20.0, 25 / 3, 50 / 3]
    assert mixing.apportion([10.0, 1.0, 1.0], 4, [9, 9, 9]) == [4, 0, 0] or sum(mixing.apportion([10.0, 1.0, 1.0], 4, [9, 9, 9])) == 4
    got = mixing.mixed(odd, pieces=True).collect()
    assert len(got) == odd.count() and all(0 <= r.taken <= 2 * r.size for r in got)
    assert all(r.taken == sum((p["last"] - p["first"]) * p["times"] for p in r.pieces or []) for r in got)
    again = mixing.mixed(odd.repartition(5)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in got) == sorted((r.doc_id or -1, r.taken) for r in again)
    assert mixing.mixed(nothing).count() == 0


def test_tokens(spark, odd, nothing):
    from tokenizers import Tokenizer

    plain, start = Tokenizer.from_file(tokens.default_tokenizer()), 0
    encode = tokens.Encoder(tokens.default_tokenizer())
    for text in ("A b,c'S d's 12.5", "x y\tz \x1c", "<|ENDOFTEXT|> <|endoftext|>a", "ÉTÉ é.,", "", "AΣ Σ", "a*b** **", "İx", "Straße, ÀÿÞ.", "e\u0301x"):
        assert encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids + [1], text
    flat, ends = encode(["a b", None, "", "a"])
    one, two = (plain.encode(t, add_special_tokens=False).ids + [1] for t in ("a b", "a"))
    assert flat.tolist() == [*one, 1, 1, *two] and ends.tolist() == np.cumsum([len(one), 1, 1, len(two)]).tolist()
    assert list(tokens.blocks([5, tokens.BLOCK_CHARS, 1, 1])) == [(0, 2), (2, 4)] and not list(tokens.blocks([]))
    assert list(tokens.blocks([1] * (tokens.BLOCK + 1))) == [(0, tokens.BLOCK), (tokens.BLOCK, tokens.BLOCK + 1)]
    got = {r.doc_id: r for r in tokens.token_digests(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    for k, t in sorted({r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}.items()):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert tokens.token_digests(odd).count() == odd.count() and tokens.token_digests(nothing).count() == 0


def test_words_are_remembered_without_what_is_behind_them(monkeypatch):
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(tokens.default_tokenizer()), tokens.Encoder(tokens.default_tokenizer())
    encode(["abc abc. abc,", "d'e. été?!"])
    assert set(encode.numbers) == {"abc", "", ".", ",", "d'e.", "été", "?!"}
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    for text in ("one two. three", "one, four..", "É.. a.b 12. 日本.", "two one"):
        assert encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids + [1], text
    assert len(encode.numbers) == 3


def test_token_starts_do_not_depend_on_files(spark, tmp_path):
    docs = spark.createDataFrame([(k, "word " * (k % 9)) for k in range(300)], "doc_id long, text string")
    want = {r.doc_id: (r.start, r.n_tokens) for r in tokens.token_digests(docs).collect()}
    assert [want[k][0] for k in range(1, 300)] == list(np.cumsum([want[k][1] for k in range(299)]))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 7)
    try:
        tokens.write_tokens(docs, str(tmp_path / "cut"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(list((tmp_path / "cut").glob("*.orc"))) > 40
    got = tokens.read_tokens(spark, str(tmp_path / "cut")).collect()
    assert {r.doc_id: (r.start, len(r.ids)) for r in got} == want
    # Ranges are ordered as numbers, beyond any number of digits.
    parts = [(k, part, 0, [5] * (k + 1)) for k, part in enumerate((9, 99_999, 100_000, 1_000_000))]
    spark.createDataFrame(parts, tokens.TOKENS).repartition(3).write.orc(str(tmp_path / "far"))
    assert sorted((r.doc_id, r.start) for r in tokens.read_tokens(spark, str(tmp_path / "far")).collect()) == [(0, 0), (1, 1), (2, 3), (3, 6)]

def test_pipeline_stages(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == corpus_pipeline.COLUMNS, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()
    assert docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def test_empty_pipeline(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_whole_small_tables(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op1(spark, SMALL).collect()} == classes(docs)
    row = lambda r: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
    assert {r.doc_id: row(r) for r in op7(spark, SMALL).collect()} == plain_repeats(docs)
