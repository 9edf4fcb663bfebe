"""Batches, samples of labels and the tables of a run."""

from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc

from billscope.llm import common
from billscope.llm.queries import prepared
from billscope.session import RunTables


def test_pieces_keep_texts(monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 50)
    texts = [None if i % 7 == 0 else f"Word{i} ÄÖ \n" * (i % 5) for i in range(60)] + ["x" * 500, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "n"]).slice(3)
    seen = list(common.pieces([batch, batch.slice(0, 0)]))
    assert len(seen) > 10 and [n for p in seen for n in p.column("n").to_pylist()] == list(range(3, len(texts)))
    want = [t or "" for t in texts[3:]]
    assert [t for p in seen for t in common.texts_of(p).to_pylist()] == want
    assert [t for p in seen for t in pc.utf8_lower(common.texts_of(p)).to_pylist()] == [t.lower() for t in want]
    words = []
    for piece in seen:
        distinct, codes, starts = common.split_words(common.texts_of(piece))
        names = distinct.to_pylist()
        words += [[names[c] for c in codes[a:b]] for a, b in zip(starts, starts[1:])]
    assert words == [t.split() for t in want]


def test_a_sample_of_the_most_frequent_values(spark):
    rows = [(i, f"text {i}", "de" if i < 60 else "en" if i < 100 else f"stray{i}") for i in range(160)]
    rows += [(None, "no id", "de"), (1, "twice", "de"), (200, "no label", None)]
    docs = prepared(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    found = common.labelled_sample(docs, docs, "lang", per_value=50, most_values=3).collect()
    by = {lang: sorted(r["doc_id"] for r in found if r["lang"] == lang) for lang in {r["lang"] for r in found}}
    assert {lang: len(ids) for lang, ids in by.items()} == {"de": 50, "en": 40, "stray100": 1}
    assert {r["text"] for r in found if r["doc_id"] == 1} <= {"text 1"} and set(by["de"]) <= set(range(60))
    few = common.labelled_sample(docs, docs, "lang", per_value=50, most_values=3, most_rows=30).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in few} == {"de": 10, "en": 10, "stray100": 1}
    assert common.labelled_sample(docs.where("false"), docs.where("false"), "lang", 50).count() == 0


def test_tables_go_with_their_run(spark, tmp_path):
    prepared(spark)
    with RunTables(spark, str(tmp_path)) as run:
        kept = common.written(spark.range(5), "five")
        assert kept.count() == 5 and list(Path(run.path).rglob("five/*.parquet"))
    assert not Path(run.path).exists()
