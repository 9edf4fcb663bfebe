"""The trie over conversations against a direct formulation."""

import hashlib
import random
import zlib

import pytest

from billscope.llm import prefixtrie
from billscope.llm.queries import prepared

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string"


def expected(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    if not paths:
        return []
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    nodes = sorted(members, key=len, reverse=True)
    saved, leaves, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    out = []
    for p in nodes:
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        leaves[p] = leaves[p] or 1
        ends = ",".join(map(str, sorted(c for c in members[p] if paths[c] == p)))
        up = p[:-1]
        out.append((min(members[p]), len(p), min(members[up]) if p else None, len(members[p]), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
        if p:
            saved[up] += saved[p]
            leaves[up] += leaves[p]
            children[up] += 1
    return out


def made(n, longest, words, seed=3, step=1):
    """Conversations that share prefixes of many lengths."""
    rng = random.Random(seed)
    rows, kept = [], []
    for i in range(n):
        path = list(rng.choice(kept)[: rng.randrange(0, longest + 1)]) if kept and rng.random() < 0.7 else []
        path += [rng.choice(words) for _ in range(rng.randrange(0 if path else 1, longest + 1 - len(path)) if longest > len(path) else 0)]
        path = path or [words[0]]
        kept.append(path)
        rows += [(i * step, t, rng.choice(["user", "user", "bot"]) if step == 1 else "user", w) for t, w in enumerate(path)]
    rng.shuffle(rows)
    return rows


CASES = {
    "empty": [],
    "one": [(7, 0, "user", "hi"), (7, 1, "bot", "yes")],
    "nulls": [(1, None, "user", "last"), (1, 0, None, "a"), (1, 0, "user", None), (None, 1, "user", "x"), (2, None, None, None), (2, None, None, None), (3, 5, "", "é" * 50_000)],
    "made": made(250, 12, ["a", "bb", "ccc"]),
    "families": made(200, 40, ["a", "é"], step=5),
    "copies": [(5 * c, t, "user", f"turn {t}") for c in range(150) for t in range(4)] + [(c + 10_001, *rest) for c, *rest in made(50, 6, ["a", "b"], seed=9)],
    "nested": [(5 * c, t, "user", f"turn {t}") for c in range(40) for t in range(c + 1)],
}


@pytest.mark.parametrize("name", CASES)
def test_nodes_equal_brute_force(spark, name, monkeypatch):
    monkeypatch.setattr(prefixtrie, "FIRST_BATCH", 8)
    monkeypatch.setattr(prefixtrie, "GROWTH", 5)
    frame = prepared(spark).createDataFrame([(*row, 1, "k") for row in CASES[name]], SCHEMA).repartition(3)
    assert sorted(map(tuple, prefixtrie.prefix_nodes(frame).collect()), key=repr) == sorted(expected(CASES[name]), key=repr)


def test_trie_holds_branches_and_ends_only(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "FIRST_BATCH", 8)
    rng = random.Random(5)
    words = [[rng.choice("ab") for _ in range(rng.randrange(1, 30))] for _ in range(120)]
    paths = sorted({"".join(w) for w in words})

    def units(word):
        mark, out = b"", b""
        for i, c in enumerate(word):
            mark = hashlib.blake2b(mark + c.encode(), digest_size=16).digest()
            out += mark + (i + 1).to_bytes(8, "big")
        return out

    frame = prepared(spark).createDataFrame([(bytearray(units(p)), len(p)) for p in paths], "path binary, n int")
    got = prefixtrie.trie(frame).collect()
    prefixes = {p[:d] for p in paths for d in range(1, len(p) + 1)}
    want = {p for p in prefixes if p in paths or len({q[len(p)] for q in prefixes if q.startswith(p) and len(q) > len(p)}) > 1}
    by_key = {units(p)[-24:-8]: p for p in prefixes}
    assert sorted(by_key[bytes(r["key"])] for r in got) == sorted(want)
    for r in got:
        p = by_key[bytes(r["key"])]
        up = max((q for q in [*want, ""] if p.startswith(q) and len(q) < len(p)), key=len)
        assert (r["lo"], r["hi"]) == (len(up), len(p)) and bytes(r["edge"]) == units(p)[24 * len(up) :]
        fat = max(range(len(up) + 1, len(p) + 1), key=lambda f: f & -f)
        assert by_key[bytes(r["handle"])] == p[:fat]


def test_chunks_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK", 100)
    rows = [(bytearray(b"k%d" % (i % 3 and 1)), i * 7 - 50) for i in range(600)]
    got = prefixtrie.end_digests(prepared(spark).createDataFrame(rows, "key binary, conv_id long").repartition(7)).collect()
    for r in got:
        ids = ",".join(map(str, sorted(c for k, c in rows if bytes(k) == bytes(r["key"]))))
        assert r["ends"] == hashlib.sha256(ids.encode()).hexdigest()
    assert len(got) == 2
