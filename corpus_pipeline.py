"""A training corpus from ``documents``: five stages, each an operator of ``quarry.llm``.

Language ID, exact dedup, SimHash near-dedup, redaction of personal data, and
packing.  Every stage is written and read again before the next one starts, so
each works on what its predecessor kept and a lost executor repeats no more
than a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import exact_dedup, langid, packing, pii, simhash
from quarry.llm.common import save, with_row_id, without_rows
from quarry.llm.queries import TOKENIZERS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has a language: null texts and texts without a letter go."""
    judged = langid.predict(with_row_id(docs, "__rid").select("__rid", "text"), langid.train(docs))
    return without_rows(docs, judged.where("lang_pred = 'und'"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of exact copies."""
    index = exact_dedup.new_index(spark)
    kept = exact_dedup.keep_first(docs, index, "documents")
    index.close()
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component (4-word shingles, 4 bits)."""
    return simhash.keep_one(docs, shingle=4, bits=4)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in every text; no document is lost."""
    return pii.redact(docs, *pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, mixed in proportion to the sources."""
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language), ("exact_dedup", drop_copies), ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data), ("packing", pack_sequences)]

#: No SQL says what a SimHash or a trained model does; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the packed corpus."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
