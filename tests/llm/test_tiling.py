"""Greedy string tiling against a direct formulation."""

import random
import time
import tracemalloc

import pyarrow as pa

from billscope.llm import tiling
from billscope.llm.queries import prepared


def brute_tiles(item, doc, least):
    item, doc, found = list(item), list(doc), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n] and item[a + n] is not None:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return sum(n for *_, n in found)
        a, b, n = best
        item[a : a + n] = [None] * n
        doc[b : b + n] = [float("nan")] * n
        found.append(best)


def test_tiles_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        least = rng.choice([2, 3, 5])
        item = [rng.randrange(4) for _ in range(rng.randrange(least, 25))]
        doc = [rng.randrange(5) for _ in range(rng.randrange(0, 40))]
        cut = rng.randrange(len(item))
        doc += item[cut:] + [9] + item[:cut]
        got = tiling.Text(pa.array([str(x) for x in doc], pa.large_string())).tiled([str(x) for x in item], least, 0.0)
        share = brute_tiles(item, doc, min(least, len(item))) / len(item)
        assert (got[0] if got else 0) == share


def test_repeated_words_cost_their_number():
    text = tiling.Text(pa.array(["same"] * 20_000, pa.large_string()))
    tracemalloc.start()
    began = time.time()
    assert text.tiled(["same"] * 2_000, 5, 0.8) == (1.0, 1)
    assert time.time() - began < 5 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


ITEM = "One two three, four five six seven. Eight nine ten eleven twelve thirteen fourteen!"
REORDERED = "eight NINE ten eleven twelve thirteen fourteen -- and then one two three four five six seven"


def test_contaminated_documents(spark):
    words = ITEM.split()
    docs = [
        (1, f"before {ITEM} after"),
        (2, f"x {REORDERED} y"),
        (3, " ".join(words[:11])),  # 11 of 14 words: below the threshold
        (4, " ".join(words[:12])),
        (5, " ".join(words[i] for i in range(0, 14, 2))),
        (6, None),
        (7, ""),
        (8, "tiny item"),
        (8, "a tiny item, twice"),
        (None, ITEM),
        (9, " ".join(f"{w} ." for w in words)),  # punctuation alone is no word
    ]
    items = [(10, ITEM), (11, None), (12, ""), (13, "Tiny item"), (14, "..."), (15, ITEM)]
    spark = prepared(spark)
    got = tiling.contaminated(
        spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, item_id string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    found = sorted(((r["doc_id"], r["item_id"]) for r in got), key=str)
    full = [(i, k) for i in (1, 2, 4, 9, None) for k in (10, 15)] + [(8, 13), (8, 13)]
    assert found == sorted(full, key=str)
    assert {r["tiles"] for r in got if r["doc_id"] == 2} == {2}


def brute_found(docs, items, least=5, threshold=0.8):
    out = []
    for i, text in docs:
        for k, item in items:
            words, least_here = item.split(), min(least, len(item.split()))
            share = brute_tiles(words, text.split(), least_here) / len(words)
            if share >= threshold:
                out.append((i, k, share))
    return sorted(out)


def test_lookup_by_rare_windows_loses_nothing(spark, monkeypatch):
    """Many items share a phrase, words are few, texts hold pieces of items in any order; texts of many items are divided."""
    spark = prepared(spark)
    rng = random.Random(4)
    phrase = "read this one again and"
    items = [(k, " ".join([phrase] * (k % 3 == 0) + [f"w{rng.randrange(4)}" for _ in range(rng.choice([1, 3, 5, 8, 14]))])) for k in range(30)]
    docs = []
    for i in range(50):
        parts = [part for _ in range(2) for part in cut_up(rng, rng.choice(items)[1])]
        rng.shuffle(parts)
        docs.append((i, " ".join([*parts, phrase] if i % 2 else parts)))
    docs += [(100 + i, docs[i][1]) for i in range(5)]
    expected = brute_found(docs, items)
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for at_once in (4096, 2):
        monkeypatch.setattr(tiling, "ITEMS_PER_TEXT", at_once)
        got = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in tiling.contaminated(*tables).collect())
        assert got == expected and len(got) > 50
    left = sorted(r["doc_id"] for r in tiling.free_of(*tables).collect())
    assert left == sorted({i for i, _ in docs} - {i for i, *_ in expected})


def cut_up(rng, text):
    words = text.split()
    at = rng.randrange(len(words))
    return [" ".join(words[:at]), " ".join(words[at:])]


def test_ids_of_any_type_and_clashing_columns(spark):
    spark = prepared(spark)
    docs = spark.createDataFrame([("a", ITEM, "x", 1), (None, REORDERED, "y", 2)], "doc_id string, text string, item_id string, coverage int")
    for kind, ids in (("int", [1, None]), ("string", ["p", None]), ("decimal(10,0)", [None, None])):
        items = spark.createDataFrame([(ITEM, ids[0], 5), (ITEM.upper(), ids[1], 6)], f"text string, item_id {kind}, tiles int")
        got = tiling.contaminated(docs, items)
        assert dict(got.dtypes)["item_id"] == kind and got.columns == ["doc_id", "item_id", "coverage", "tiles"]
        assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=str) == sorted([(d, i) for d in ("a", None) for i in ids], key=str)
    assert tiling.free_of(docs.union(docs.selectExpr("doc_id", "null", "item_id", "coverage")), items).columns == docs.columns
    assert tiling.free_of(docs.union(docs.selectExpr("doc_id", "null", "item_id", "coverage")), items).count() == 2


def test_empty_tables(spark):
    spark = prepared(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert tiling.contaminated(docs, items).collect() == []
    assert tiling.contaminated(spark.createDataFrame([(1, ITEM)], "doc_id long, text string"), items).collect() == []
