"""SimHash near-duplicates, candidates by pigeonring chains.

A 64-bit fingerprint is a ring of ``SEGMENTS`` segments. Two fingerprints at distance d at most ``limit`` have a segment
from which every chain of consecutive segments stays within its share of d: the first l segments differ in at most
l * limit / SEGMENTS bits. With five segments and four bits the chain starts with an equal segment, the next differs in
one bit at most, so one of its halves is equal too: these two make the join key. Longer chains are checked before the
full distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import pieces, split_words, texts_of, written
from billscope.llm.components import components

BITS = 64
# Fingerprints compared with each other in one task step; larger buckets are cut into blocks of about this size.
BLOCK = 1024


def segments_of(limit: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``limit + 1`` segments, widths at most one apart."""
    m = limit + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id and its 64-bit ``fingerprint`` (signed long).

    Letters A-Z are lowered, words stand between ASCII white space, shingles of ``words`` words are joined by blanks and
    counted as often as they occur; fewer words make one shingle, none (or a null text) the fingerprint 0. A bit is set
    if more than half of the shingle hashes (XXH64) have it.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in pieces(batches, text_col):
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts_of(batch, text_col)))
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for row, tokens in enumerate(lists):
                tokens = [t for t in tokens.values.cast(pa.large_binary()).to_pylist() if t]
                if not tokens:
                    continue
                joined = b" ".join(tokens)
                ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
                starts = [0, *(ends[:-1] + 1).tolist()]
                stops = ends[words - 1 :].tolist() or [len(joined)]
                hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype=np.uint64)
                votes = np.zeros(BITS, dtype=np.int64)
                for at in range(0, len(hashes), 4096):
                    part = np.ascontiguousarray(hashes[at : at + 4096]).view(np.uint8).reshape(-1, 8)
                    votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                out[row] = weights[2 * votes > len(hashes)].sum(dtype=np.uint64)
            yield pa.RecordBatch.from_pydict({id_col: batch.column(id_col), "fingerprint": pa.array(out.view(np.int64))})

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, fingerprint long")


def chain_keys(limit: int):
    """The join keys of a fingerprint as an array of longs, each with the number of its kind in the top bits.

    A kind is a first segment and, where the second segment may differ in one bit at most, one of its halves.
    """
    print_ = F.col("fingerprint")
    parts = segments_of(limit)
    m, keys = len(parts), []

    def bits(lo: int, width: int):
        return F.shiftrightunsigned(print_, lo).bitwiseAND(F.lit((1 << width) - 1))

    for i, (lo, width) in enumerate(parts):
        lo2, width2 = parts[(i + 1) % m]
        half = width2 // 2
        for h, (at, size) in enumerate([(lo2, half), (lo2 + half, width2 - half)]):
            kind = 2 * i + h
            keys.append(F.shiftleft(F.lit(kind).cast("long"), 56) + F.shiftleft(bits(lo, width), 24) + bits(at, size))
    return F.array(*keys)


def close_pairs(prints: np.ndarray, others: np.ndarray, limit: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of fingerprints within ``limit`` bits whose chains from the key's first segment stay in budget."""
    parts = segments_of(limit)
    m = len(parts)
    first = kind // 2
    a = np.repeat(np.arange(len(prints)), len(others))
    b = np.tile(np.arange(len(others)), len(prints))
    d, spent = prints[a] ^ others[b], np.zeros(len(a), dtype=np.int64)
    for length in range(1, m + 1):
        lo, width = parts[(first + length - 1) % m]
        spent = spent + np.bitwise_count((d >> np.uint64(lo)) & np.uint64((1 << width) - 1))
        kept = spent <= length * limit // m
        a, b, d, spent = a[kept], b[kept], d[kept], spent[kept]
    return a, b


def spanning(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Enough of the index pairs to connect all that they connect."""
    root = list(range(len(prints)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def links(distinct: DataFrame, limit: int) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within ``limit`` bits, directly or through each other.

    Each bucket of a key hands on a spanning forest of its links, never its pairs. A bucket above ``BLOCK`` fingerprints
    is cut into blocks, and every pair of blocks is a step of its own, so no task holds a bucket whole.
    """
    keyed = distinct.select("fingerprint", F.explode(chain_keys(limit)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks").cast("long")).cast("int")
    placed = (
        keyed.join(sizes, "key")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fingerprint")
    )
    grouped = placed.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "own")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last, maybe unfinished, group
        for batch in batches:
            cols = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "p", "q", "own", "fingerprint")], axis=1)
            if not len(cols):
                continue
            held.append(cols)
            rows = np.concatenate(held)
            change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            if len(change):
                yield joined(rows[: change[-1]], change)
                held = [rows[change[-1] :]]
            else:
                held = [rows]
        if held:
            rows = np.concatenate(held)
            yield joined(rows, np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1)

    def joined(rows: np.ndarray, change: np.ndarray) -> pa.RecordBatch:
        left, right = [], []
        bounds = sorted({0, *change.tolist(), len(rows)})
        for start, end in zip(bounds, bounds[1:]):
            if end - start < 2:
                continue
            group = rows[start:end]
            prints = group[:, 4].copy().view(np.uint64)
            kind = int(group[0, 0] >> 56)
            if end - start == 2 and np.bitwise_count(prints[0] ^ prints[1]) > limit:
                continue
            cut = int(np.searchsorted(group[:, 3], group[0, 2])) if group[0, 1] != group[0, 2] else 0
            if cut:  # two blocks: only pairs across; pairs inside a block are its own step
                a, b = close_pairs(prints[:cut], prints[cut:], limit, kind)
                b = b + cut
            else:
                a, b = close_pairs(prints, prints, limit, kind)
                a, b = a[a < b], b[a < b]
            for x, y in spanning(prints, a, b):
                left.append(group[x, 4]), right.append(group[y, 4])
        return pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return grouped.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, limit: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, ``fingerprint`` (16 hex digits) and ``component_id``: the smallest id reachable over links.

    Two rows link if their fingerprints differ in at most ``limit`` bits. Rows with one fingerprint are one node from
    the start, so exact copies cost nothing more. Null and empty texts have fingerprint 0 and link like any other; a row
    with a null id takes part and gets the component of its fingerprint (null if no id is in it). Repeated rows come out
    repeated, an empty table gives an empty result, other columns are ignored.
    """
    prints = written(fingerprints(docs, words, id_col=id_col, text_col=text_col), "prints")
    distinct = written(prints.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "distinct")
    roots = components(links(distinct, limit)) if limit else docs.sparkSession.createDataFrame([], "node long, root long")
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least")
    named = written(named, "named")
    firsts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(firsts, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
