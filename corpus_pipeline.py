"""From raw documents to packed training sequences: five stages on Spark tables.

Every stage takes whole tables and texts. A null text is a document without words: the
quality rules reject it, and each later stage would pass it on (the last one as its end
id alone). Empty texts are treated alike. Very long texts are worked on whole, in blocks
where memory asks for it. Repeated rows are judged alike; near-duplicate removal keeps
one of them, of equal doc_ids the one with the least text. Extra columns stay up to the
last stage, whatever their names, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.decontaminate import without_leaks
from strata.llm.minhash import without_near_duplicates
from strata.llm.names import unused
from strata.llm.packing import pack_documents
from strata.llm.pii import find_pii, fit_on
from strata.llm.quality import judge_quality
from strata.llm.queries import END_ID, read, vocabulary
from strata.sources import layer_path, scratch_dir, write_layer

CAPACITY = 1024


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """The documents' columns with another text; its length in code points follows it."""
    columns = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their hosts' boilerplate lines.

    Near copies all pass, since their common lines are no boilerplate."""
    judged = judge_quality(docs).where("kept")
    return _with_text(judged, "clean_text").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a shingle similarity of 0.8 and more: the least doc_id,
    of equal ones the least text. Documents without words are no copies of each other."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty items are held by none."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets, a stretch of spans that
    overlap by its first kind. Texts without any stay as they are."""
    (own,) = unused(docs, "_pii")
    found = docs.withColumn(own, find_pii(F.col("text"), fit_on(docs)))
    return _with_text(found, f"{own}.masked").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens; equal pieces,
    and pieces of a null doc_id, get places of their own."""
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), END_ID, CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL has neither the tokenizer nor the random field; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as a table that the next one reads."""
    docs = read(spark, sf_dir, "documents")
    folder = scratch_dir(spark)
    for number, (name, stage) in enumerate(STAGES):
        path = layer_path(folder, "pipeline", f"{number}_{name}")
        docs = write_layer(stage(spark, docs, sf_dir), path).frame
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
