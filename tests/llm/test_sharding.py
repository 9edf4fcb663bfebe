"""Balanced label propagation."""

import zlib
from collections import Counter

import pytest

from billscope.llm import sharding
from billscope.llm.queries import prepared


def check(rows, got, shards):
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None
    )
    counts = Counter(r["shard"] for r in got)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert {(r["law"], r["grown_shard"]) for r in got} <= {("rows", None)}


def test_groups_stay_together(spark):
    rows = [(i, f"single {i}") for i in range(300)] + [(1000 + i, f"group {i % 40}") for i in range(160)]
    frame = prepared(spark).createDataFrame([(*row, 7) for row in rows], "doc_id long, text string, shard int").repartition(5)
    got = sharding.row_shards(frame).collect()
    check(rows, got, 8)
    spread = {}
    for r in got:
        if r["doc_id"] >= 1000:
            spread.setdefault((r["doc_id"] - 1000) % 40, set()).add(r["shard"])
    assert sum(len(s) == 1 for s in spread.values()) >= 38


def test_a_group_of_most_rows_fills_few_shards(spark):
    rows = [(i, "the same") for i in range(200)] + [(500 + i, f"single {i}") for i in range(200)]
    got = sharding.row_shards(prepared(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got, 8)
    held = Counter(r["shard"] for r in got if r["doc_id"] < 500)
    assert len(held) <= 6  # 4 full ones at least


@pytest.mark.parametrize(
    "rows",
    [[], [(1, "a")], [(1, None), (2, ""), (3, None), (None, "x"), (None, "x"), (4, "y"), (4, "y"), (5, "z" * 100_000)], [(i, "all equal") for i in range(50)]],
)
def test_odd_tables(spark, rows):
    got = sharding.row_shards(prepared(spark).createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got, 8)


def test_quotas_never_overfill():
    import numpy as np

    asked = [{"shard": a, "target": b, "level": k, "part": p, "n": 3} for a in range(3) for b in range(3) if a != b for k in range(2) for p in range(2)]
    room = np.array([4, 0, 5])
    left = room.copy()
    for shard, target, *_ in sharding.quotas(asked, room):
        left[target] -= 3
        left[shard] += 3
    assert (left >= 0).all()
