"""From raw documents to token ids: score, join near copies, decontaminate, mix and encode.

Each stage takes what its predecessor kept and returns the rows it keeps, with the columns of
``documents``; the last returns where each document's ids lie in the token files.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.llm.common import WORD, land, map_rows, rows, table, texts
from dripline.llm.decontamination import contaminated
from dripline.llm.jaccard import jaccard_classes
from dripline.llm.mixing import mixed
from dripline.llm.quality import quality_scores
from dripline.llm.registry import query
from dripline.llm.tokens import token_digests

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject. Rows without doc_id can't be scored by id and go."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    rejected = scores.where("predicted = 0").select("doc_id").distinct()
    return docs.select(COLUMNS).where("doc_id is not null").join(rejected, "doc_id", "left_anti").select(COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document that names it, once; blank texts are classes of their own."""
    classes = jaccard_classes(docs)
    kept = classes.where("doc_id = component_id").select("doc_id").distinct()
    return docs.select(COLUMNS).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(COLUMNS)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, whole or edited."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.select(COLUMNS).join(found, "doc_id", "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents cut to the words that the mix takes; words taken twice stand twice.

    Runs of words keep the blanks between them. Documents of which nothing is taken go.
    """
    import re

    word = re.compile(WORD)

    def taken_text(text: str, pieces) -> str:
        edges = [m.span() for m in word.finditer(text)]
        parts = []
        for again in range(1, max(p["times"] for p in pieces) + 1):
            for p in pieces:
                if p["times"] >= again:
                    a, b = edges[p["first"]][0], edges[p["last"] - 1][1]
                    if parts and parts[-1][1] == p["first"]:
                        parts[-1] = [parts[-1][0], p["last"], text[edges[parts[-1][0]][0] : b]]
                    else:
                        parts.append([p["first"], p["last"], text[a:b]])
        return "\n".join(t for _, _, t in parts)

    def make():
        def step(batch):
            out = [taken_text(t, p) for t, p in zip(texts(batch), batch.column("pieces").to_pylist())]
            same = {c: batch.column(c) for c in ("doc_id", "lang", "source")}
            yield rows(
                doc_id=same["doc_id"], text=pa.array(out, pa.string()), lang=same["lang"], source=same["source"],
                n_chars=pa.array(map(len, out), pa.int64()),
            )

        return step

    plan = mixed(docs, pieces=True).where("taken > 0").select("doc_id", "pieces")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    return map_rows(own.join(plan, "doc_id"), make, "doc_id long, text string, lang string, source string, n_chars long")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, written as ORC and described as read back."""
    return token_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_each),
    ("decontamination", keep_clean),
    ("mixing", mix_sources),
    ("token_ids", encode),
]

#: The stages are models, seeded choices and a tokenizer's merges, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
