"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark
decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``.  All but the last return the
columns of ``documents``: the quality rules and the decontamination drop
documents, line dedup rewrites ``text`` (and ``n_chars``), the Jaccard join
keeps the smallest doc_id of each group; packing returns the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import free_name, staged, table
from flowlens.llm.decontaminate import find_contamination
from flowlens.llm.jaccard_join import keep_one_of_each
from flowlens.llm.line_dedup import dedup_lines
from flowlens.llm.packing import pack_documents
from flowlens.llm.quality_rules import judge_quality


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judge_quality(docs).filter(F.col(free_name(docs.columns, "kept"))).select(*columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col(free_name(docs.columns, "contaminated"))).select(*columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Decontamination (alignment) and packing (tokeniser) are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{i}")
    return docs
