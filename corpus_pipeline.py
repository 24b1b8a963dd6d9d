"""Corpus pipeline over documents: language ID, quality rules, SimHash near-dedup, packing.

Each stage takes all that its predecessor kept.  The first three return the columns of documents, whatever these are;
the last returns the pieces of packed sequences with their token ids.

* language ID learns from the rows of its input that have a language, and rejects texts without a letter (null and empty
  ones too) and those whose best language has a probability under :func:`least_language_score`, which depends on
  the number of languages learned and on the scores of the calibration rows: a text in none of them has a lower one;
* quality rules reject what the base rules or the cascade reject;
* near-dedup keeps one row of each component: the smallest doc_id, nulls last, the first of equal rows;
* packing lays every document, with its end id, into sequences of 2048 tokens or a power of two.

Repeated rows are near copies of each other, so one stays; an empty table passes through all stages as such; further
columns stay, and names that clash with the operators' own do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlens.llm import language_id
from claimlens.llm.common import free_name, stage_table, vocabulary_file
from claimlens.llm.packing import pack
from claimlens.llm.quality_rules import apply_rules
from claimlens.llm.simhash import deduplicate

#: The least score of a text, from an even share of all languages towards certainty, and as a part of what texts of the
#: learned languages usually reach.
LANGUAGE_MARGIN, USUAL_PART = 1 / 15, 2 / 3


def least_language_score(languages: int, usual: float) -> float:
    """The score under which a text counts as in none of the learned languages."""
    return max(1 / languages + (1 - 1 / languages) * LANGUAGE_MARGIN, USUAL_PART * usual)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs, "doc_id", "text", "lang")
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    kept = F.col(lang) != "und"
    if model is not None:
        kept &= F.col(score) >= least_language_score(len(model["langs"]), model["usual"]) - 1e-9
    else:                                                         # nothing to learn from: only the letters decide
        kept = language_id.letters(F.col("text"))
    return language_id.predict(docs, "text", model).where(kept).select(*_names(docs))


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return apply_rules(docs, "text").where(F.col(free_name(docs, "kept"))).select(*_names(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(docs, "doc_id", "text", words_per_shingle=3, max_distance=3).select(*_names(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with open(vocabulary_file("byte_bpe_50k.json"), "rb") as f:
        return pack(docs, "doc_id", "text", f.read(), spaced=True, end_id=1)


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c.replace('`', '``')}`" for c in docs.columns]


STAGES = [("language ID", identify_language), ("quality rules", check_quality),
          ("SimHash near-dedup", drop_near_duplicates), ("packing", pack_sequences)]

#: Classifiers, SimHash and a tokenizer: not for SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
