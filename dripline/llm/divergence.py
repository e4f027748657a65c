"""Divergence of the sources of a language, audited from columnar counts.

Tasks count terms in Arrow alone: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``
and a hash ``group_by`` give counts per (language, source, term), which the shuffle adds up. What
is kept of a language is dealt into shards by term, so that a shard holds all sources of its
terms; each shard gives its part of every distance and its own foremost terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dripline.llm.common import land, map_rows

#: What separates terms: all of ASCII but its letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A term is kept where so many documents of its language hold it; ranks of terms that are reported.
LEAST_DOCUMENTS, TOP = 30, 50
#: Shares are whole numbers of 1 / SCALE; ADDED is added to each count.
SCALE, ADDED = 1_000_000_000, 5
#: Rows that a task holds before it adds them up, and rows of a shard (more for many sources).
HELD, SHARD = 400_000, 50_000
#: Cells of a block of shares inside a shard.
CELLS = 1 << 20

COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("uses", pa.int64()), ("docs", pa.int64())]
)
KEYS = ["lang", "source", "term"]


def _filled(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pc.fill_null(batch.column(name).cast(pa.string()), "")


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, uses, docs`` of a batch of documents; a group's row without term says that it occurs."""
    lang, source = _filled(batch, "lang").dictionary_encode(), _filled(batch, "source").dictionary_encode()
    found = pc.split_pattern_regex(pc.ascii_lower(_filled(batch, "text")), BETWEEN)
    words, row = pc.list_flatten(found), pc.list_parent_indices(found)
    full = pc.not_equal(pc.binary_length(words), 0)
    terms, row = words.filter(full).dictionary_encode(), row.filter(full)
    groups = pa.table({"l": lang.indices, "s": source.indices})
    in_doc = pa.table({"row": row, "t": terms.indices}).group_by(["row", "t"], use_threads=False).aggregate([([], "count_all")])
    of_row = groups.take(in_doc["row"])
    counted = (
        pa.table({"l": of_row["l"], "s": of_row["s"], "t": in_doc["t"], "n": in_doc["count_all"]})
        .group_by(["l", "s", "t"], use_threads=False)
        .aggregate([("n", "sum"), ("n", "count")])
    )
    there = groups.group_by(["l", "s"], use_threads=False).aggregate([])
    nothing = pa.nulls(len(there), pa.int64()).fill_null(0)
    named = lambda codes, names: names.dictionary.take(codes.combine_chunks())
    return pa.concat_tables([
        pa.Table.from_arrays([
            named(counted["l"], lang), named(counted["s"], source), named(counted["t"], terms),
            counted["n_sum"].combine_chunks(), counted["n_count"].combine_chunks(),
        ], schema=COUNTS),
        pa.Table.from_arrays([
            named(there["l"], lang), named(there["s"], source), pa.nulls(len(there), pa.string()), nothing, nothing,
        ], schema=COUNTS),
    ])


def _added(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("uses", "sum"), ("docs", "sum")])
    return pa.Table.from_arrays([found[c] for c in (*KEYS, "uses_sum", "docs_sum")], schema=COUNTS)


def term_counts(docs: DataFrame) -> DataFrame:
    """Counts of each (language, source, term), added up over all documents."""

    def make():
        held: list[pa.Table] = []

        def step(batch):
            if batch is not None:
                held.append(count_terms(batch))
            if held and (batch is None or sum(map(len, held)) > HELD):
                whole = _added(held)
                held.clear()
                if batch is None or len(whole) > HELD // 2:
                    yield from whole.to_batches()
                else:
                    held.append(whole)

        return step

    parts = map_rows(docs.select("text", "lang", "source"), make, "lang string, source string, term string, uses long, docs long", last=True)
    return parts.groupBy(*KEYS).agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))


def shares(uses: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * uses / total), exact: three digits of base 1000 with remainders below total."""
    digits, rest = np.zeros(np.broadcast_shapes(uses.shape, total.shape), np.int64), uses
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        digits = digits * 1000 + digit
    return digits + 1


def _foremost(names: pa.Array, terms: pa.Array, source: np.ndarray, term: np.ndarray, value: np.ndarray) -> pa.Table:
    """The TOP greatest values of each source, ties by term."""
    table = pa.table({"source": source, "value": value, "item": terms.take(pa.array(term))})
    table = table.take(pc.sort_indices(table, [("source", "ascending"), ("value", "descending"), ("item", "ascending")]))
    own = table["source"].to_numpy()
    start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    place = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
    table = table.filter(pa.array(place < TOP))
    return pa.table({"source": names.take(table["source"].combine_chunks()), "item": table["item"], "value": table["value"]})


def diverge(held: pa.Table, stats: pa.Table) -> pa.Table:
    """One shard of a language: parts of the distances between sources (each pair once), and foremost terms.

    ``held`` has ``source, term, uses`` of the shard's terms, all sources of each; ``stats`` has
    ``source, n, kept, lang_n`` of every source of the language.
    """
    stats = stats.take(pc.sort_indices(stats, [("source", "ascending")]))
    names, many = stats["source"].combine_chunks(), len(stats)
    added = ADDED * stats["kept"].to_numpy()
    totals, whole = stats["n"].to_numpy() + added, stats["lang_n"].to_numpy()[:1] + added[:1]
    coded = held["term"].combine_chunks().dictionary_encode()
    term, terms = coded.indices.to_numpy(), coded.dictionary
    source = pc.index_in(held["source"].combine_chunks(), names).to_numpy()
    uses = held["uses"].to_numpy()
    order = np.argsort(term, kind="stable")
    term, source, uses = term[order], source[order], uses[order]

    in_lang = np.zeros(len(terms), np.int64)
    np.add.at(in_lang, term, uses)
    above = shares(uses + ADDED, totals[source]) - shares(in_lang + ADDED, whole)[term]
    up = (above > 0) & (uses > 0)
    best = _foremost(names, terms, source[up], term[up], above[up])

    apart, width = np.zeros((many, many), np.int64), max(1, CELLS // many)
    for first in range(0, len(terms), width):
        a, b = np.searchsorted(term, [first, first + width])
        counts = np.zeros((many, min(width, len(terms) - first)), np.int64)
        counts[source[a:b], term[a:b] - first] = uses[a:b]
        p = shares(counts + ADDED, totals[:, None])
        for g in range(many - 1):
            apart[g, g + 1 :] += np.abs(p[g + 1 :] - p[g]).sum(1)
    g, h = np.triu_indices(many, 1)
    parts = pa.table({"source": names.take(pa.array(g)), "item": names.take(pa.array(h)), "value": apart[g, h]})
    both = pa.concat_tables([parts, best])
    return both.append_column("part", pa.array(["pair"] * len(parts) + ["term"] * len(best), pa.string()))


def source_divergence(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` of the sources of each language of ``text, lang, source``.

    Null text, lang and source count as empty text; each row is a document, so repeated rows
    count again. A group without terms, and one of a language without kept terms, has its pair
    rows too (distance 0 in the latter); a language's only source has none. Equal values are
    ranked by the bytes of the item. No rows give no rows. Other columns are not read.
    """
    of_term = Window.partitionBy("lang", "term")
    known = F.col("term").isNotNull()
    held = land(
        term_counts(docs)
        .withColumn("in_docs", F.sum("docs").over(of_term))
        .withColumn("first", (F.row_number().over(of_term.orderBy("source")) == 1) & known)
        .where(~known | (F.col("in_docs") >= LEAST_DOCUMENTS))
        .select(*KEYS, "uses", F.col("first").cast("long").alias("first")),
        "terms",
    )
    of_lang = Window.partitionBy("lang")
    stats = land(
        held.groupBy("lang", "source")
        .agg(F.sum("uses").alias("n"), F.sum("first").alias("first"), F.count("term").alias("rows"))
        .select(
            "lang", "source", "n", F.sum("first").over(of_lang).alias("kept"), F.sum("n").over(of_lang).alias("lang_n"),
            F.ceil(
                F.sum("rows").over(of_lang) / F.greatest(F.lit(SHARD), 4 * F.pow(F.count("source").over(of_lang), F.lit(2)))
            ).alias("shards"),
        )
        .withColumn("shards", F.greatest("shards", F.lit(1)).cast("int")),
        "sources",
    )
    langs = stats.select("lang", "shards").distinct()
    dealt = (
        held.where(known).join(langs, "lang")
        .select("lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "source", "term", "uses")
    )
    every = stats.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", "n", "kept", "lang_n"
    )

    def work(key, left, right):
        found = diverge(left, right)
        lang = pa.array([key[0].as_py()] * len(found), pa.string())
        return pa.table([lang, *(found[c] for c in ("source", "part", "item", "value"))], ["lang", "source", "part", "item", "value"])

    by = ["lang", "shard"]
    found = land(
        dealt.groupBy(*by).cogroup(every.groupBy(*by)).applyInArrow(work, "lang string, source string, part string, item string, value long"),
        "divergence",
    )
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "part", "value").select("lang", "x.source", "part", "x.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")).alias("rank")
    terms = found.where("part = 'term'").select("*", rank).where(F.col("rank") <= TOP)
    return pairs.select("*", rank).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
