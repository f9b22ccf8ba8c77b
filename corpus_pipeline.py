"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language_id as languages
from tidemark.llm.common import Scratch
from tidemark.llm.decontaminate import drop_leaks
from tidemark.llm.language_gate import fit_gate
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import drop_near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: a line of so many documents is boilerplate; its first occurrence stays
LINE_DOCS = 10


def _aside(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with columns of these names under others, so that an operator's own columns do not replace them."""
    return docs.withColumnsRenamed({c: f"_aside_{c}" for c in docs.columns if c.lower() in names})


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, under their own names."""
    return rows.select(*[F.col(f"_aside_{c}").alias(c) if f"_aside_{c}" in rows.columns else F.col(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows.

    It is trained on the labelled rows whose crc32 of the id is not 0 mod 5; the others tell which scores a text of a length has, and so from which on it is rejected. Null,
    empty and letterless texts go, as do scripts of which no labelled text has letters. Texts are read whole, equal ones share their fate. Rows without a label, or all
    of one language, are judged by their letters alone; an empty table stays empty. All columns stay as they are.
    """
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    seen, unseen = (docs.where(which).select("lang", "text") for which in (part != 0, part == 0))
    network = languages.fit_network(seen)
    gate = fit_gate(network, seen, unseen)
    told = languages.identify_language(_aside(docs, "lang_pred", "score"), network)
    known = F.col("lang_pred") if network else F.when(languages.has_letters(F.col("text")), "any").otherwise(languages.UNKNOWN)
    return _back(told.where(gate.accepts(F.col("text"), known, F.col("score"))), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ``LINE_DOCS`` documents or more stay in the first of them; documents that this leaves without text go.

    A null or empty text is one empty line, which is never dropped, so it stays as an empty text. A repeated row counts as a document; of texts of any length all lines are read. An empty table
    stays empty. All columns but ``text`` stay as they are.
    """
    cleaned = dedup_lines(_aside(docs, "n_lines", "n_dropped"), min_docs=LINE_DOCS, keep_first=True)
    emptied = (F.col("n_dropped") > 0) & ~F.col("text").rlike(r"\S")
    return _back(cleaned.where(~emptied), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more: the smallest id.

    Texts without words are linked with nothing and stay; a text of fewer than five words is one shingle. Rows equal in id and text are one document and all stay or go. An empty table stays
    empty. All columns stay as they are.
    """
    return drop_near_duplicates(docs, n=5, similarity=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, re-parameterised items included.

    Null and empty texts hold none; repeated rows share their fate; long texts are read whole. Without items all documents stay; an empty table stays empty. All columns stay as they are.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words it takes of each: ``size``, ``source_size``, ``target`` and ``taken`` follow the columns of documents.

    Texts without words have size 0 and are not taken. A null source is one of its own. Equal rows are exchangeable. An empty table stays empty. Columns named like the four new ones are replaced.
    """
    return mix_sources(docs, keep=docs.columns).where("taken > 0")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL cannot train the network of the first stage; the tests hold the stages against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
