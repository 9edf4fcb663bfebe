"""Removal of repeated strings with a sparse suffix array built by deep-shallow sorting.

A string of ``length`` bytes is looked up by its anchor, the least hash among its grams: equal strings have equal anchors at
equal places, so all starts whose strings share an anchor occurrence are one segment of the text, and segments with one anchor
are a group. A group whose segments agree is decided by counting. In all others one segment of each kind goes to a task, where
the suffixes that begin at the anchors, and the reversed ones that end there, are sorted deep-shallow; two strings are equal
where their anchors' contexts share enough to the left and to the right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import PIECE_BYTES, pieces, written
from billscope.llm.deepshallow import ordered

GRAM = 16  # bytes of an anchor; hashed by doubling, so a power of two
CHUNK = 1 << 20  # starts handled at once; also the range of positions beside a hash
GROUP = 256  # kinds of segments of an anchor that one task sorts together; larger groups are divided first
BATCH_ROWS = 4000

SEGMENT = "id binary, anchor long, kind long, x int, low int, high int"


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    rng = np.random.default_rng(20240229)
    h = rng.integers(1 << 63, size=256, dtype=np.uint64)[text]
    span = 1
    while span < GRAM:
        h = h[:-span] * np.uint64(0x9E3779B97F4A7C15 + 2 * span) + h[span:]
        h ^= h >> np.uint64(31)
        span *= 2
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0x94D049BB133111EB)


def anchors(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of a string of ``length`` bytes the position of its least gram, the first of equals, and all gram hashes."""
    hashes = gram_hashes(text)
    bits = np.uint64(CHUNK * 2 - 1)
    least = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
    width, span = length - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return (least & bits).astype(np.int64), hashes


def segments_of(buffer: memoryview, starts: np.ndarray, sizes: np.ndarray, length: int) -> Iterator[tuple]:
    """(text, anchor hash, x, low, high, bytes) of each segment: starts low..high of a text share the anchor at x."""
    ends = starts + sizes
    base = 0
    total = len(buffer)
    while base + length <= total:
        text = np.frombuffer(buffer[base : base + CHUNK + length - 1], np.uint8)
        at, hashes = anchors(text, length)
        here = np.arange(base, base + len(at))
        owner = np.searchsorted(starts, here, side="right") - 1
        inside = np.flatnonzero((here + length <= ends[owner]) & (here >= starts[owner]))
        if len(inside):
            at, owner = at[inside], owner[inside]
            new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            low, high, x, of = inside[first] + base, inside[last] + base, at[first] + base, owner[first]
            yield of, hashes[at[first]].astype(np.int64), x, low, high
        base += CHUNK


def found_segments(length: int):
    """Segments of whole texts, cut where a chunk of starts ends; a kind is a hash of the bytes and the anchor's place in them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = batch.column("text").take(pa.array(np.arange(batch.num_rows))).cast(pa.large_binary())
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            view = memoryview(texts.buffers()[2])[: int(sizes.sum())]
            for of, anchor, x, low, high in segments_of(view, starts, sizes, length):
                kinds = [
                    int.from_bytes(hashlib.blake2b(view[a : b + length], digest_size=8, salt=int(c - a).to_bytes(8, "big")).digest(), "big", signed=True)
                    for a, b, c in zip(low.tolist(), high.tolist(), x.tolist())
                ]
                base = starts[of]
                columns = [pa.array(v, t) for v, t in ((kinds, pa.int64()), (x - base, pa.int32()), (low - base, pa.int32()), (high - base, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of)), pa.array(anchor), *columns], ["id", "anchor", "kind", "x", "low", "high"])

    return run


PART = "key binary, id binary, x int, first int, last int, sure boolean, big boolean, data binary"


def cut_parts(length: int):
    """The bytes of a text's listed segments. A segment's starts are told by their distance to the anchor, first..last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        names = ["key", "id", "x", "first", "last", "sure", "big", "data"]
        for batch in batches:
            rows, size = [], 0
            for i, text, parts in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("parts").to_pylist()):
                view = memoryview(text.as_buffer())
                for p in parts:
                    x, low, high = p["x"], p["low"], p["high"]
                    data = bytes(view[low : high + length])
                    rows.append((p["anchor"].to_bytes(8, "big", signed=True), i, x, x - high, x - low, p["sure"], p["big"], data))
                    size += len(data)
                    if size > PIECE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    return run


def repeated_starts(order_r, shared_r, order_l, shared_l, first, last, length: int) -> list[tuple[int, int, int]]:
    """(member, first, last): distances at which a member's string equals another's.

    At distance j two strings are equal if the contexts share ``length - j`` bytes to the right and j to the left. Between two
    distances at which neither sorted order divides differently, the classes stay the same, so one of each stretch is looked at.
    """
    n = len(first)
    cuts = np.unique(np.concatenate([length - shared_r[1:], shared_l[1:] + 1, first, last + 1]))
    cuts = cuts[(cuts >= first.min()) & (cuts <= last.max() + 1)]
    at, until = cuts[:-1], cuts[1:] - 1
    right, left = np.empty((len(at), n), np.int64), np.empty((len(at), n), np.int64)
    right[:, order_r] = np.cumsum(shared_r[None, :] < (length - at)[:, None], axis=1)
    left[:, order_l] = np.cumsum(shared_l[None, :] < at[:, None], axis=1)
    valid = (first[None, :] <= at[:, None]) & (at[:, None] <= last[None, :])
    code = ((np.arange(len(at))[:, None] * (n + 1) + right) * (n + 1) + left)[valid]
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = np.zeros(valid.shape, bool)
    again[valid] = counts[inverse] > 1
    stretch, member = np.nonzero(again)
    return list(zip(member.tolist(), at[stretch].tolist(), until[stretch].tolist()))


def compared(length: int):
    """Ranges of bytes that groups of parts, sorted by key, have in common: (id, low, high)."""

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Whole groups, some thousand rows at a time."""
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("key", "id", "x", "first", "last", "sure", "data")]))
            held += rows
            if len(held) >= BATCH_ROWS:
                cut = len(held)
                while cut and held[cut - 1][0] == held[-1][0]:
                    cut -= 1
                if cut:
                    yield held[:cut]
                    held = held[cut:]
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            keys = [r[0] for r in rows]
            group = np.cumsum([0, *[a != b for a, b in zip(keys, keys[1:])]])
            last = np.array([r[4] for r in rows])
            order_r, shared_r = ordered([r[6][r[4] :] for r in rows], group)
            order_l, shared_l = ordered([r[6][: r[4]][::-1] for r in rows], group)
            first = np.array([r[3] for r in rows])
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            out: dict[str, list] = {"id": [], "low": [], "high": []}
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b - a < 2:
                    continue
                sr, sl = shared_r[a:b].copy(), shared_l[a:b].copy()
                for member, j, k in repeated_starts(order_r[a:b] - a, sr, order_l[a:b] - a, sl, first[a:b], last[a:b], length):
                    row = rows[a + member]
                    if not row[5]:
                        out["id"].append(row[1])
                        out["low"].append(row[2] - k)
                        out["high"].append(row[2] - j + length)
            yield pa.RecordBatch.from_arrays([pa.array(out["id"], pa.binary()), pa.array(out["low"], pa.int32()), pa.array(out["high"], pa.int32())], ["id", "low", "high"])

    return run


def divided(parts: DataFrame, length: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Groups too large for one task: ranges found by counting, and the groups that remain, small enough to sort.

    A group's distances are halved in rounds. All strings of a half contain the same stretch of bytes around the anchor, its
    core, which joins the key: groups fall apart by what follows and precedes. Parts that are alike in a whole half are counted
    and go on as one; a half of a single distance consists of alike parts only. What goes on is about two parts for every
    place where a text stops agreeing with others, whatever the size of the group.
    """
    ranges, small = [], []
    state = parts.withColumn("a", F.lit(0)).withColumn("b", F.lit(length - GRAM + 1))
    while True:
        halves = F.explode(F.expr("array(struct(a as a, cast(floor((a + b) / 2) as int) as b), struct(cast(floor((a + b) / 2) as int) as a, b as b))"))
        pair = state.select("key", "id", "x", "first", "last", "sure", "data", halves.alias("h")).select("*", "h.a", "h.b").drop("h")
        pair = pair.where("first < b and last >= a and a < b").select(
            # the bytes that every string with a distance in [a, b) has: from a before the anchor to length - b + 1 after it
            F.md5(F.expr(f"concat(key, cast(concat(a, ':') as binary), substring(data, last - a + 1, {length} - b + 1 + a))")).alias("key"),
            "id", "x", F.expr("greatest(first, a)").alias("f"), F.expr("least(last, b - 1)").alias("l"), "sure", "a", "b", "last", "data",
        )
        pair = pair.select(F.unhex("key").alias("key"), "id", "x", F.col("f").alias("first"), F.col("l").alias("last"), "sure", "a", "b", F.expr(f"substring(data, last - l + 1, l - f + {length})").alias("data"))
        kind = F.unhex(F.md5(F.expr("concat(cast(concat(first, ':', last, ':') as binary), data)")))
        pair = written(pair.withColumn("kind", kind), "halves")
        kinds = written(pair.groupBy("key", "kind").agg(F.count("*").alias("n"), F.min(F.struct("id", "x")).alias("one")), "kinds")
        alike = kinds.where("n > 1").select("key", "kind")
        ranges.append(pair.where("not sure").join(alike, ["key", "kind"]).select("id", F.expr("x - last").alias("low"), F.expr(f"x - first + {length}").alias("high")))
        groups = written(kinds.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        ones = kinds.join(groups, "key").select("key", "kind", F.col("one.id").alias("id"), F.col("one.x").alias("x"), "size", (F.col("n") > 1).alias("_sure"))
        on = written(pair.join(ones, ["key", "kind", "id", "x"]).withColumn("sure", F.col("sure") | F.col("_sure")), "on")
        small.append(on.where(F.col("size") <= GROUP).select("key", "id", "x", "first", "last", "sure", "data"))
        state = on.where(F.col("size") > GROUP)
        if state.isEmpty():
            return ranges, small


MARKS = "id binary, n_removed long, n_spans long, kept_sha256 string, spans array<struct<low:int,high:int>>"


def removed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its ranges, and the maximal ranges themselves."""
    for batch in batches:
        rows = []
        for i, text, lows, highs in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("lows").to_pylist(), batch.column("highs").to_pylist()):
            spans: list[list[int]] = []
            for low, high in sorted(zip(lows, highs)):
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], high)
                else:
                    spans.append([low, high])
            view, kept, at = memoryview(text.as_buffer()), hashlib.sha256(), 0
            for low, high in spans:
                kept.update(view[at:low])
                at = high
            kept.update(view[at:])
            rows.append((i, sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"low": a, "high": b} for a, b in spans]))
        types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["id", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Distinct ``texts`` (id, text: binary) that hold an anchor met elsewhere, and their ranges (id, low, high) that are covered
    by a string of ``length`` bytes met elsewhere. Rows with one id are copies of one text.
    """
    long = texts.where(F.octet_length("text") >= length)
    found = written(long.mapInArrow(found_segments(length), SEGMENT), "segments")
    # small sides of joins are written: a join of two plain tables can split the rows of a key met very often
    met = written(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "met")
    alike = found.join(met, "anchor", "left_semi").groupBy("id", "anchor", "kind", "x", "low", "high").agg(F.count("*").alias("copies"))
    alike = written(alike, "alike")
    kinds = written(alike.groupBy("anchor", "kind").agg(F.sum("copies").alias("n"), F.min(F.struct("id", "x")).alias("one")), "kinds")
    sizes = written(kinds.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    # one segment of every kind goes on where an anchor has several; all segments of a kind that is met twice are covered
    on = kinds.join(sizes, "anchor").select("anchor", "kind", F.col("one.id").alias("id"), F.col("one.x").alias("x"), (F.col("n") > 1).alias("sure"), (F.col("size") > GROUP).alias("big"))
    twice = alike.join(kinds.where("n > 1").select("anchor", "kind"), ["anchor", "kind"]).select("id", "low", F.expr(f"high + {length}").cast("int").alias("high"))
    parts = alike.select("anchor", "kind", "id", "x", "low", "high").join(on, ["anchor", "kind", "id", "x"]).groupBy("id").agg(F.collect_list(F.struct("anchor", "x", "low", "high", "sure", "big")).alias("parts"))
    ids = alike.select("id").distinct().join(parts, "id", "left")
    # a text may be very long, so copies are merged where they lie before one of each is sent
    once = long.groupBy("id").agg(F.first("text").alias("text"))
    held = written(once.join(ids, "id"), "texts")
    cut = written(held.where("parts is not null").select("id", "text", "parts").mapInArrow(cut_parts(length), PART), "parts")
    ranges, small = [twice], [cut.where("not big").select("key", "id", "x", "first", "last", "sure", "data")]
    if not cut.where("big").isEmpty():
        more, rest = divided(cut.where("big").drop("big"), length)
        ranges += more
        small += rest
    for frame in small:
        sorted_parts = frame.repartition("key").sortWithinPartitions("key")
        ranges.append(sorted_parts.mapInArrow(compared(length), "id binary, low int, high int"))
    every = ranges[0]
    for frame in ranges[1:]:
        every = every.unionByName(frame)
    return held.select("id", "text"), every


def without_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row: each byte covered by a string of ``length`` bytes
    that starts at another place of any text too is removed.

    Texts are UTF-8 bytes, null counts as empty; matches do not cross texts but may lie in one text and overlap. Strings are
    judged on the input. Copies of a text of ``length`` bytes or more vanish whole, the first as well; shorter ones stay. Rows
    are kept as they are: repeated rows, equal ids and null ids each give their row. An empty table gives an empty result,
    other columns are ignored, whatever their names. ``spans`` are byte ranges, null where the whole text goes as a copy.

    Only hashes of segments are shuffled for all texts; bytes travel where an anchor is met twice. Fingerprints are hashes of 128
    bits (anchor and kind); whatever differs is compared byte by byte.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("_doc"), body.alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    named = rows.select("_doc", "text", digest.alias("digest")).withColumn("id", F.expr("substring(digest, 1, 16)"))
    keys = written(named.select("_doc", "id", "digest", F.octet_length("text").cast("long").alias("n")), "keys")
    copies = keys.where(F.col("n") >= length).groupBy("id").agg(F.count("*").alias("c"), F.first("n").alias("n")).where("c > 1")
    nothing = hashlib.sha256(b"").hexdigest()
    whole = copies.select("id", F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(nothing).alias("kept_sha256"), F.lit(None).cast("array<struct<low:int,high:int>>").alias("spans"))
    texts, ranges = repeated(named.select("id", "text"), length)
    merged = ranges.groupBy("id").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    single = texts.join(merged, "id").join(copies.select("id"), "id", "left_anti")
    marks = whole.unionByName(single.select("id", "text", "lows", "highs").mapInArrow(removed, MARKS))
    out = keys.join(marks, "id", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("_doc").alias(id_col), F.col("n").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("digest"))).alias("kept_sha256"), "spans",
    )
