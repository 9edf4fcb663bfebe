"""Repeated strings against a direct formulation, and deep-shallow sorting against sorted()."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from billscope.llm import deepshallow, suffixes
from billscope.llm.queries import prepared


def expected(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        covered = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                covered[p + 1 : p + 1 + length] = True
        flags = covered[1 : len(b) + 1]
        kept = bytes(c for c, gone in zip(b, flags) if not gone)
        out.append((i, len(b), int(flags.sum()), int((np.diff(covered.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length):
    frame = prepared(spark).createDataFrame([(*row, b"x", 1) for row in rows], "doc_id long, text string, id binary, low int").repartition(3)
    got = suffixes.without_repeats(frame, length).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add((t or "").encode())
    for r in got:
        if r["spans"] is not None:
            assert sum(s["high"] - s["low"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(expected(rows, length), key=repr)


def near_copies(n, size, edits, seed, alphabet="abcd é"):
    rng = random.Random(seed)
    base = "".join(rng.choice(alphabet) for _ in range(size))
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = rng.choice(["X", "", "yy", "é"])
        out.append("".join(text))
    return out


def passages(n, seed):
    """Texts of their own around one common passage, and pieces of each other."""
    rng = random.Random(seed)
    common, out = "".join(rng.choice("pqrs") for _ in range(90)), []
    for _ in range(n):
        own = "".join(rng.choice("tuvw ") for _ in range(rng.randrange(0, 120)))
        at = rng.randrange(len(own) + 1)
        out.append(own[:at] + common[rng.randrange(30) : 90 - rng.randrange(30)] + own[at:])
        if out and rng.random() < 0.3:
            other = rng.choice(out)
            out.append(other[rng.randrange(len(other) + 1) :] + "|" + own)
    return out


TEXTS = {
    "empty": [],
    "odd": [None, None, "", "a" * 50, "a" * 300, "\0" * 90, "ab" * 100, "abc" * 60, "x", "short copy", "short copy"] + ["a copy that is long enough " * 4] * 3,
    "near": near_copies(60, 400, 4, 1) + near_copies(20, 200, 1, 2, "ab"),
    "passages": passages(80, 3),
    "periods": [("0123456789" * k)[: 37 * k] + "z" * k for k in range(1, 14)] + ["line one\n" * 40, "line two\n" * 40 + "line one\n" * 9],
}


@pytest.mark.parametrize("group", [256, 2])
@pytest.mark.parametrize("name", TEXTS)
def test_repeats_equal_brute_force(spark, name, group, monkeypatch):
    if group == 2 and name == "empty":
        return
    monkeypatch.setattr(suffixes, "GROUP", group)
    check(spark, [(None if k % 11 == 0 else k // 2, t) for k, t in enumerate(TEXTS[name])], 40)


def test_segments_cover_every_start_in_chunks(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.randrange(0, 300))) for _ in range(30)]
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    by_string = {}
    count = 0
    for of, anchor, x, low, high in suffixes.segments_of(memoryview(b"".join(texts)), starts, sizes, 40):
        for o, h, c, a, b in zip(of, anchor, x, low, high):
            for p in range(a - starts[o], b - starts[o] + 1):
                count += 1
                assert p + 40 <= len(texts[o])
                by_string.setdefault(texts[o][p : p + 40], set()).add((h, c - starts[o] - p))
    assert count == sum(max(len(t) - 39, 0) for t in texts)
    assert all(len(places) == 1 for places in by_string.values())


def test_deep_shallow_order():
    rng = random.Random(1)
    for _ in range(150):
        base = [bytes(rng.choice(b"\0\1ab") for _ in range(rng.randrange(0, 200))) for _ in range(4)]
        strings, groups = [], []
        for _ in range(rng.randrange(1, 60)):
            b = rng.choice(base)
            s = bytearray(b[: rng.randrange(0, len(b) + 1)]) if rng.random() < 0.5 else bytearray(b)
            if s and rng.random() < 0.6:
                s[rng.randrange(len(s))] = rng.choice(b"\0\1ab")
            strings.append(bytes(s))
            groups.append(rng.randrange(3))
        order, shared = deepshallow.ordered(strings, np.array(groups))
        assert [(groups[i], strings[i]) for i in order] == sorted(zip(groups, strings))
        for k in range(1, len(order)):
            a, b = strings[order[k - 1]], strings[order[k]]
            same = next((i for i, (c, d) in enumerate(zip(a, b)) if c != d), min(len(a), len(b)))
            assert shared[k] == (same if groups[order[k - 1]] == groups[order[k]] else 0)
