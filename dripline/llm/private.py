"""Personal data, and sanitisation by what terms reveal about it.

Addresses, card and phone numbers are the protected entities. For a term ``t`` near an entity
``e``, documents of the whole corpus give the point-wise mutual information
``log2(p(e, t) / (p(e) p(t)))``; the entity's own information is ``-log2 p(e)``. A term whose
mutual information reaches REMOVE of that information gives the entity away and is removed
beside it; one that reaches GENERALISE is replaced by its kind (number, name, word). Terms
seen with the entity in fewer than SUPPORT documents are no evidence.
"""

from __future__ import annotations

import re
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.llm.common import land, map_rows, rows, texts

#: Fixed patterns of the base kinds, in their order. Possessive runs match the same, in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
KINDS = ("email", "ip", "card", "phone")
#: Words on each side of an entity, documents in support, and shares of the entity's information.
AROUND, SUPPORT, REMOVE, GENERALISE = 3, 2, 0.95, 0.8
#: Distinct words that a task counts before it gives them out.
COUNTED = 500_000
EDGES = " .,;:!?*#$%&|\"'()[]{}<>="
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; a match has its first @ at the end of the run of local characters."""
    out, start = [], 0
    while (at := text.find("@", start)) >= 0:
        left = at
        while left > start and text[left - 1] in LOCAL:
            left -= 1
        m = DOMAIN.match(text, at) if left < at else None
        if m:
            out.append((left, m.end()))
        start = m.end() if m else at + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start; kinds may overlap each other."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        found = [m for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        out += [("ip", *m.span()) for m in found]
    for m in CARD.finditer(text):
        d = _digits(m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def term(word: str) -> str:
    return word.strip(EDGES).lower()


def around(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """``(entity, term, start, end)`` of the AROUND words on each side of each entity."""
    out = []
    for kind, a, b in spans:
        entity = kind + ":" + (_digits(text[a:b]) if kind in ("card", "phone") else text[a:b].lower())
        found, end = [], a
        for _ in range(AROUND):  # leftwards, word by word
            while end and text[end - 1] in " \t\n\v\f\r":
                end -= 1
            start = end
            while start and text[start - 1] not in " \t\n\v\f\r":
                start -= 1
            if start == end:
                break
            found.append((start, end))
            end = start
        at = b
        for _ in range(AROUND):
            m = WORD.search(text, at)
            if not m:
                break
            found.append(m.span())
            at = m.end()
        for s, e in found:
            if (t := term(text[s:e])) and not any(x < e and s < y for _, x, y in spans):
                out.append((entity, t, s, e))
    return out


NEAR = T.ArrayType(T.StructType([T.StructField("entity", T.StringType()), T.StructField("term", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_NEAR = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _read(docs: DataFrame) -> DataFrame:
    """Rows of documents with base spans and their surroundings, and rows of word counts.

    ``key`` names a row, as ids may be null or repeated: the task's number and the row's in it.
    """

    def make():
        from pyspark import TaskContext

        counts: dict[str, int] = {}
        key = TaskContext.get().partitionId() << 36

        def counted():
            n = len(counts)
            yield rows(
                key=pa.nulls(n, pa.int64()), doc_id=pa.nulls(n, pa.int64()), spans=pa.nulls(n, _SPANS), near=pa.nulls(n, _NEAR),
                word=pa.array(list(counts), pa.string()), n=pa.array(list(counts.values()), pa.int64()),
            )
            counts.clear()

        def step(batch):
            nonlocal key
            if batch is None:
                yield from counted()
                return
            spans, near = [], []
            for text in texts(batch):
                text = text or ""
                found = base_spans(text)
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
                near.append([dict(zip(("entity", "term", "start", "end"), s)) for s in around(text, found)])
                for w in {term(x) for x in set(WORD.findall(text))}:
                    counts[w] = counts.get(w, 0) + 1
                if len(counts) > COUNTED:
                    yield from counted()
            n = len(spans)
            yield rows(
                key=pa.array(range(key, key + n), pa.int64()), doc_id=batch.column("doc_id").cast(pa.int64()),
                spans=pa.array(spans, _SPANS), near=pa.array(near, _NEAR), word=pa.nulls(n, pa.string()), n=pa.nulls(n, pa.int64()),
            )
            key += n

        return step

    schema = T.StructType(
        [T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS)]
        + [T.StructField("near", NEAR), T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]
    )
    return map_rows(docs.select("doc_id", "text"), make, schema, last=True)


def disclosing_terms(near: DataFrame, word_counts: DataFrame, total: int) -> DataFrame:
    """``entity, term, action``: terms above a threshold, from counts over all documents."""
    pairs = near.select("key", "entity", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("both"))
    pairs = pairs.where(F.col("both") >= SUPPORT)
    entities = near.select("key", "entity").distinct().groupBy("entity").agg(F.count("*").alias("own"))
    all_ = float(max(total, 1))
    known = pairs.join(entities, "entity").join(word_counts, F.col("term") == F.col("word"))
    told = F.log2(F.col("both") * all_ / (F.col("own") * F.col("n")))
    share = told / F.greatest(F.log2(all_ / F.col("own")), F.lit(1e-9))
    action = F.when(share >= REMOVE, "remove").when(share >= GENERALISE, "generalise")
    return known.select("entity", "term", action.alias("action")).where("action is not null")


def personal_data(docs: DataFrame) -> DataFrame:
    """``key, doc_id, base, added`` for each row of ``doc_id, text``.

    ``base`` has the spans of the four kinds; ``added`` the ``(kind, start, end)`` of terms to
    remove or generalise, without overlaps, by start. Offsets count code points. A null text
    is empty, ids may be null or repeated, and an empty table gives no rows.
    """
    seen = land(_read(docs), "read")
    base = seen.where("key is not null")
    near = base.select("key", F.explode("near").alias("x")).select("key", "x.*")
    words_ = seen.where("key is null and word <> ''").groupBy("word").agg(F.sum("n").alias("n"))
    actions = disclosing_terms(near, words_, base.count())
    marked = near.join(actions, ["entity", "term"])
    spans = marked.groupBy("key", "start", "end").agg(F.max("action").alias("kind"))
    added = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    added = added.withColumn("added", F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return base.join(added, "key", "left").select(
        "key", "doc_id", F.col("spans").alias("base"), F.coalesce("added", F.array().cast(SPANS)).alias("added")
    )


def sanitised_text(text: str, base, added) -> str:
    """The text with entities named by kind, and disclosing terms removed or generalised."""
    marks = [(s["start"], s["end"], f"[{s['kind']}]") for s in base]
    for s in added:
        word = term(text[s["start"] : s["end"]])
        kind = "[number]" if any(c.isdigit() for c in word) else "[name]" if text[s["start"]].isupper() else "[word]"
        marks.append((s["start"], s["end"], "" if s["kind"] == "remove" else kind))
    out, at = [], 0
    for a, b, put in sorted(marks):
        if a >= at:
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents after sanitisation, for tables with distinct doc_id."""

    def make():
        def step(batch):
            base, added = (batch.column(c).to_pylist() for c in ("base", "added"))
            out = [sanitised_text(t or "", b or [], a or []) for t, b, a in zip(texts(batch), base, added)]
            yield rows(doc_id=batch.column("doc_id"), text=pa.array(out, pa.string()))

        return step

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_rows(own.join(personal_data(own).drop("key"), "doc_id", "left"), make, "doc_id long, text string")


def personal_digests(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""

    def make():
        def step(batch):
            base, added = (
                [[(s["kind"], s["start"], s["end"]) for s in row] for row in batch.column(c).to_pylist()] for c in ("base", "added")
            )
            count = lambda kind: pa.array([sum(s[0] == kind for s in row) for row in base], pa.int64())
            yield rows(
                doc_id=batch.column("doc_id"),
                **{f"n_{kind}": count(kind) for kind in KINDS},
                base_sha256=pa.array([sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                spans=pa.array([joined([*b, *sorted(a)]) for b, a in zip(base, added)], pa.string()),
            )

        return step

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(personal_data(docs), make, schema)
