"""A corpus pipeline over ``documents``: each stage reads what its predecessor wrote.

Languages, exact copies, near copies and benchmark passages each take documents away and
leave the columns as they are; the last stage packs what is left into training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrublens.llm import decontamination, exact_dedup, language_id, packing, simhash
from scrublens.llm.common import fold, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Rejected: ``und``, that is, no text or no letter. Columns
    of any name stay, ``lang_pred`` and ``score`` too."""
    train = fold(F.col("doc_id"), 3) != 1
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang")
    found = language_id.identify_languages(rows, "text", "lang", train)
    return found.filter(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts agree without white space."""
    return exact_dedup.drop_exact_duplicates(docs, "doc_id", "text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each component of near fingerprints."""
    return simhash.drop_near_duplicates(docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    items = table(spark, sf_dir, "benchmark")
    return decontamination.drop_contaminated(docs, "doc_id", "text", items, "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, one row per piece."""
    return packing.pack(docs, "doc_id", "text")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: No SQL: languages, fingerprints, templates and token ids are beyond it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
