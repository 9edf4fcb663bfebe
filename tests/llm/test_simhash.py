"""SimHash near-duplicates against comparing every pair."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from billscope.llm import simhash
from billscope.llm.components import components
from billscope.llm.queries import prepared


def brute_print(text, words=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 150]))] for _ in range(40)]
    rows = []
    for i in range(160):
        tokens = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            tokens[rng.randrange(len(tokens))] = rng.choice(vocabulary).upper()
        rows.append((i, "  ".join(tokens)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "İstanbul É one two"), (204, "x")] + [rows[5], rows[5]]
    docs = prepared(spark).createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string").repartition(4)
    got = simhash.near_duplicates(docs).collect()
    prints = {i: brute_print(t) for i, t in rows}
    want = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert len(got) == len(rows)
    for row in got:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}" and row["component_id"] == want[row["doc_id"]]


@pytest.mark.parametrize("limit, block", [(1, 1024), (2, 7), (4, 5), (4, 1024), (6, 1024)])
def test_links_find_every_close_pair(spark, monkeypatch, limit, block):
    rng = random.Random(limit)
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(12):
            value = centre
            for bit in rng.sample(range(64), rng.randrange(0, limit + 3)):
                value ^= 1 << bit
            prints.add(value)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = prepared(spark).createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = simhash.links(frame, limit).collect()
    assert all(0 < (signed[e["a"]] ^ signed[e["b"]]).bit_count() <= limit for e in edges)
    got = {r["node"]: r["root"] for r in components(simhash.links(frame, limit)).collect()}
    want = brute_components(sorted(signed), lambda a, b: (signed[a] ^ signed[b]).bit_count() <= limit)
    assert {n: got.get(n, n) for n in signed} == want


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 3), (7, None), (100, 101)]
    frame = prepared(spark).createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}


def test_empty_table(spark):
    empty = prepared(spark).createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []


def test_one_class_for_many_copies(spark):
    docs = prepared(spark).range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c d e f").otherwise(F.concat(F.lit("t "), "id")).alias("text"))
    got = simhash.near_duplicates(docs).where("doc_id % 3 = 0").select("component_id").distinct().collect()
    assert len(got) == 1
