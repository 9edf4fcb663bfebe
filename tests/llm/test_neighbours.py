"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from billscope.llm import neighbours
from billscope.llm.queries import QUERIES, prepared

SF = "/root/testdata/sf0.01"


def brute(rows, k=5, every=50):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[i, tuple(v)] = np.array(v, dtype=np.float64)
    out = {}
    for i, v in fine:
        if i % every == 0:
            q = fine[i, v]
            scores = sorted((-float(q @ x) / float(np.linalg.norm(q) * np.linalg.norm(x)), j) for (j, _), x in fine.items() if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores(spark):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, want = by_query(QUERIES["op9_nearest_neighbours"](spark, SF).collect()), brute(data)
    assert set(got) == set(want) and all(len(got[q]) == 5 for q in got)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    vectors = {i: np.array(v, dtype=np.float64) for i, v in data}
    for q, found in got.items():
        assert all(abs(s - vectors[q] @ vectors[j] / np.linalg.norm(vectors[q]) / np.linalg.norm(vectors[j])) < 1e-12 for j, s in found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))


def test_clustered_vectors_in_small_steps(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 32))
    rows = [(i, (centres[i % 30] + 0.3 * rng.normal(size=32)).tolist()) for i in range(3000)]
    frame = prepared(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(neighbours.nearest(frame, settings=neighbours.Settings(sample=800, vectors=64, queries=8)).collect())
    want = brute(rows)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_a_tiny_list_is_topped_up(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(neighbours, "fit_lists", lambda *_: neighbours.Lists(np.eye(8), np.eye(8)[:4], 1))
    at = [0] * 200 + [1] * 200 + [2] * 3 + [3] * 2
    rows = [(i + 48, (np.eye(8)[c] + 0.02 * rng.normal(size=8)).tolist()) for i, c in enumerate(at)]
    frame = prepared(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(neighbours.nearest(frame).collect())
    assert 450 in got and all(len(found) == 5 for found in got.values())
    assert {j for j, _ in got[450][:2]} == {448, 449}


def test_scan_leaves_no_query_short():
    """Vectors whose distance lies in the first columns are not abandoned below the wanted number."""
    x = np.concatenate([np.tile([1.0, 0, 0, 0], (6, 1)) + 0.01 * np.arange(6)[:, None], np.eye(4)[1:]])
    a, _ = neighbours.scan(np.array([[0.0, 0, 0, 1.0]]), x[:8], 6, np.eye(4), neighbours.Settings(columns=1, doubt=0.0))
    assert len(a) >= 6


def test_odd_rows_and_copies(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 120)] + [(200, [-1.0, 0.5, 2.0]), (200, [-1.0, 0.5, 2.0]), (250, [0.0, 0.0, 0.0]), (300, None), (350, [1.0, None, 2.0]), (400, [1.0, float("nan"), 2.0]), (450, [1.0, float("inf"), 0.0]), (500, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (550, [2.0, 4.0, 6.0])]
    frame = prepared(spark).createDataFrame([(*row, 1.0) for row in rows], "vec_id long, embedding array<double>, score double")
    got = by_query(neighbours.nearest(frame).collect())
    assert set(got) == {0, 50, 100, 200, 550}
    assert [j for j, _ in got[50]] == [0, 1, 2, 3, 4] and [j for j, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [j for j, _ in got[200]] == [0, 1, 2, 3, 4] and [j for j, _ in got[550]] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("rows, n", [([], 0), ([(50, [1.0, 0.0])], 0), ([(50, [1.0, 0.0]), (51, [0.5, 0.5]), (100, [0.0, 1.0])], 4)])
def test_few_candidates(spark, rows, n):
    frame = prepared(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    assert neighbours.nearest(frame).count() == n
