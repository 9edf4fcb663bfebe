"""The pipeline's stages, each held against its operator and a plain rule."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from billscope.llm.queries import prepared

SF = "/root/testdata/sf0.001"
NAMES = ["toxicity", "language", "near_duplicates", "decontamination", "bpe"]


@pytest.fixture(scope="module")
def docs(spark):
    return prepared(spark).read.parquet(f"{SF}/documents.parquet")


def test_stages_and_registration():
    assert [name for name, _ in pipeline.STAGES] == NAMES
    assert "pipeline" in entry.queries() and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op") and q[2].isdigit()}


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_each_stage_keeps_the_columns_and_drops_what_it_rejects(spark, docs):
    from billscope.llm.queries import QUERIES

    columns = list(pipeline.COLUMNS)
    clean = pipeline.clean_of_toxicity(spark, docs, SF)
    assert clean.columns == columns == docs.columns
    assert ids(clean) == ids(QUERIES["op1_toxicity"](spark, SF).where("predicted = 0"))
    known = pipeline.of_known_language(spark, docs, SF)
    assert known.columns == columns and ids(known) == ids(docs)
    one = pipeline.one_of_each_group(spark, docs, SF)
    assert one.columns == columns and ids(one) == ids(QUERIES["op7_simhash"](spark, SF).select(F.col("component_id").alias("doc_id")).distinct())
    free = pipeline.free_of_benchmarks(spark, docs, SF)
    leaked = {r["doc_id"] for r in QUERIES["op2_decontamination"](spark, SF).collect()}
    assert free.columns == columns and ids(free) == [i for i in ids(docs) if i not in leaked] and leaked


def test_odd_documents_pass_through(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the of and words", "en", "s", 3), (3, "Wort ist der", None, "s", 5), (3, "Wort ist der", None, "s", 5)]
    odd = prepared(spark).createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, lang string, source string, n_chars long, predicted string")
    assert pipeline.clean_of_toxicity(spark, odd, SF).count() == 5
    assert pipeline.of_known_language(spark, odd, SF).count() == 3  # no letters, no language
    assert ids(pipeline.one_of_each_group(spark, odd.where("doc_id is not null"), SF)) == [1, 3]
    assert pipeline.free_of_benchmarks(spark, odd, SF).count() == 5
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd.where("false"), SF).count() == 0


def test_rows_of_one_id_are_told_apart_by_their_texts(spark):
    near = " ".join(f"word{i}" for i in range(400))
    rows = [
        (5, "alpha beta gamma delta epsilon zeta", "en", "s", 1),
        (5, near, "en", "t", 2),
        (5, near, "en", "s", 2),
        (7, near, "en", "s", 2),
        (None, near, "en", "s", 2),
        (None, "eins zwei drei vier fuenf sechs sieben", "de", "s", 3),
        (None, "eins zwei drei vier fuenf sechs sieben", "de", "r", 3),
        (None, "", "de", "s", 0),
        (9, None, None, None, None),
        (9, "", None, None, None),
    ]
    odd = prepared(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.one_of_each_group(spark, odd, SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[6], rows[8]], key=str)


def test_run_gives_the_tokens_of_what_is_left(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = pipeline.run(spark, SF).collect()
    assert 0 < len(got) < len(texts)
    for row in got:
        found = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(found) and row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_near_duplicates_read_and_exchange_whole_rows_once(spark, docs):
    plan = pipeline.one_of_each_group(spark, docs, SF)._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 2  # the documents and the list of rows that go
