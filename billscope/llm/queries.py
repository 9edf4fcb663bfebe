"""The registered queries ``opN_<name>``: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm import bpe, language, manifest, neighbours, pieces, prefixtrie, quality, sharding, simhash, sitetree, suffixes, tiling, toxicity
from billscope.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, and a session without a checkpoint folder (tests) one of its own."""
    context = spark.sparkContext
    if not getattr(context, "_billscope_sent", False):
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='billscope-')}/billscope", "zip", root, "billscope")
        context.addPyFile(archive)
        context._billscope_sent = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # long texts: a batch stays small on both sides
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="billscope-"))
    return spark


def query(name: str):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


def tokenizer_path(name: str) -> str:
    """File of a public tokenizer; the folder is the installed package's, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fitted_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.Model | None:
    """The toxicity model of a data set, learned from the labelled documents outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), fitted_toxicity(spark, sf_dir))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, limit=4)


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def fitted_language(spark: SparkSession, sf_dir: str) -> language.Model | None:
    """The language model of a data set, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return language.fit(docs.where(~held_out("doc_id", 3, 1)))


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"), fitted_language(spark, sf_dir))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(table(spark, sf_dir, "pages"))


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op6_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.row_shards(table(spark, sf_dir, "documents"), shards=8)


@query("op11_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.checked_documents(table(spark, sf_dir, "documents"), fan=8)


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_nodes(table(spark, sf_dir, "conversations"))


@query("op12_suffix_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"), length=400).drop("spans")
