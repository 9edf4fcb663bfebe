"""Merkle proofs against a direct formulation."""

import hashlib
import random
import zlib

import pytest

from billscope.llm import manifest
from billscope.llm.queries import prepared

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, up int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n_chars, text):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)])


def climb(digests):
    """Root, and of each digest its siblings level by level as (left, right)."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [(digests[i : i + 8], owners[i : i + 8]) for i in range(0, len(digests), 8)]
        for kids, owned in runs:
            for k, mine in enumerate(owned):
                for i in mine:
                    paths[i].append((kids[:k], kids[k + 1 :]))
        digests, owners = [sha(*kids) for kids, _ in runs], [[i for mine in owned for i in mine] for _, owned in runs]
    return digests[0], paths


def expected(rows):
    trees = {}
    for doc, text, lang, source, n_chars in rows:
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf(doc, source, lang, n_chars, text), (doc, text, lang, source, n_chars)))
    names = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    subroots, inner = [], {}
    for name in names:
        trees[name].sort(key=lambda t: t[:3])
        subroot, inner[name] = climb([t[2] for t in trees[name]])
        subroots.append(subroot)
    root, outer = climb(subroots)
    out = []
    for name, subroot, upper in zip(names, subroots, outer):
        for (*_, digest, (doc, text, lang, source, n_chars)), path in zip(trees[name], inner[name]):
            path = path + upper
            start = digest
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0:
                start = leaf(doc, source, lang, n_chars, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path:
                start = sha(*left, start, *right)
            out.append((doc, digest, subroot, root, sha(*[x for left, right in path for x in (*left, *right)]), start, start == root))
    return out


def table(n, langs, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["Capital É", "none", None, "", "A" * 50]), rng.choice(langs), rng.choice(["a", None]), rng.choice([None, i])) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(3, "One", "en", "s", 3)],
        [(1, "One", "en", "s", 3), (2, "Two", "fr", "s", 3)],
        table(9, ["en"]),
        table(64, ["en"]),
        table(700, ["en"] * 9 + ["fr", None, "é", "", "z"]),
        table(150, [f"l{i}" for i in range(70)] + ["en"] * 70),
        [(None, "X", None, None, None)] * 3 + [(5, "Y" * 200_000, "en", "s", 1), (5, "Y", "en", "s", 1), (5, "Y", "en", "s", 1)],
    ],
)
def test_proofs_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", 40_000 if len(rows) > 100 else 4 << 20)
    frame = prepared(spark).createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in manifest.checked_documents(frame).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows) if rows else [], key=repr)


def test_tampering_is_seen(spark):
    rows = table(60, ["en", "fr"])
    got = manifest.checked_documents(prepared(spark).createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)).collect()
    texts = {row[0]: row[1] for row in rows}
    for r in got:
        capital = any("A" <= c <= "Z" for c in texts[r["doc_id"]] or "")
        assert r["verified"] == (not capital or zlib.crc32(str(r["doc_id"]).encode()) % 3 != 0)
