"""The corpus pipeline: toxicity, language, near-duplicates, benchmark passages, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. The first four return the
columns of ``documents``; the last returns what the tokenizer gives for each document. Models are learned from the
labelled documents in ``sf_dir``, outside the held-out fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm import bpe, language, simhash, tiling, toxicity
from billscope.llm.common import table, written
from billscope.llm.queries import fitted_language, fitted_toxicity, prepared, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine does not predict as toxic."""
    scored = toxicity.score(docs, fitted_toxicity(prepared(spark), sf_dir), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def of_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; ``und`` goes."""
    found = language.identify(docs, fitted_language(prepared(spark), sf_dir), keep=COLUMNS)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the smallest id; of rows with that id the one whose text has the
    smallest digest; of rows equal in both the one with the smallest other columns. So texts that are no duplicates stay,
    also under one id. Rows without an id come after those with one: a component of such rows only keeps one of them.

    Whole rows are exchanged once, by a key of 16 bytes: the least of the rows with one key is taken before and after that exchange,
    and the list of rows that go meets them there.
    """
    prepared(spark)
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.unhex(digest).alias("digest"))
    rows = docs.select(*COLUMNS, place.alias("_row"))

    def key(row: str):
        return F.unhex(F.md5(F.concat(F.coalesce(F.col(f"{row}.id").cast("string"), F.lit("-")).cast("binary"), F.col(f"{row}.digest")))).alias("_key")

    groups = simhash.near_duplicates(rows, words=4, limit=4, id_col="_row")
    gone = written(groups.where(~F.col("_row").eqNullSafe(F.col("component_id"))).select(key("_row")).distinct(), "gone")
    once = rows.select(key("_row"), F.struct(*COLUMNS).alias("row")).groupBy("_key").agg(F.min("row").alias("row"))
    return once.join(gone, "_key", "left_anti").select("row.*")


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return tiling.free_of(docs.select(*COLUMNS), table(prepared(spark), sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document's ids and of the text decoded from them."""
    import public_tokenizers

    prepared(spark)
    return bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("language", of_known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", free_of_benchmarks),
    ("bpe", encoded),
]

# The stages hold trained models, fingerprints and a tokenizer; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
