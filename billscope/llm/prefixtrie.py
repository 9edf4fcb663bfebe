"""Z-fast trie over the turns of conversations.

A path is a conversation's sequence of turns, kept as one unit per turn: a 16-byte fingerprint of the whole prefix up to that
turn and the prefix's bytes of text. Compacted nodes (where paths branch or end) are rows: the edge from depth ``lo`` to ``hi``
with its units, and a handle, the prefix fingerprint at the two-fattest depth of (lo, hi], the number there with the most
trailing zero bits. A path finds its exit node by fat binary search: one equi join with the handles per power of two, from the
highest down, not one per turn. Paths are inserted in batches of random members, each eight times the one before: edges
are split where paths leave them, and what hangs below a split is built from the sorted remainders in one pass.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import written

MARK, UNIT = 16, 24  # bytes of a prefix fingerprint, and of a unit: fingerprint and 8 bytes of length
FIRST_BATCH, GROWTH = 256, 8  # expected paths of the first batch, and the factor to the next
CHUNK = 64 << 10  # characters of conversation ids that travel as one row
ROOT = "cast('' as binary)"  # key of the root, as SQL
NO_ENDS = hashlib.sha256(b"").hexdigest()


def unit_mark(path: str, depth: Column | str) -> Column:
    """Fingerprint of the prefix of the given depth (from 1)."""
    return F.expr(f"substring({path}, ({depth} - 1) * {UNIT} + 1, {MARK})")


def unit_bytes(path: str, depth: Column | str) -> Column:
    """Bytes of text up to the given depth (from 1)."""
    return F.conv(F.hex(F.expr(f"substring({path}, ({depth} - 1) * {UNIT} + {MARK + 1}, {UNIT - MARK})")), 16, 10).cast("long")


def sequences(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's (digest, bytes) in order of turn, null first, ties by digest.

    Texts are hashed where they lie; a conversation's row holds 24 bytes a turn. Rows without conversation are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct(F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n"))
    grouped = rows.where("conv_id is not null").select("conv_id", turn.alias("turn")).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", F.expr("transform(turns, t -> struct(t.digest, t.n))").alias("turns"))


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c begins with the first h turns of conversation ``c - c % family`` instead of its own first h,
    h = crc32(decimals of c) % ``heads``. Only those few turns travel to the conversation.
    """
    head = turns.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_family"), F.slice("turns", 1, heads).alias("_head"))
    own = turns.withColumn("_family", F.col("conv_id") - F.col("conv_id") % family)
    own = own.withColumn("_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"))
    both = own.join(head, "_family", "left")
    return both.select("conv_id", F.expr("concat(slice(coalesce(_head, array()), 1, _h), slice(turns, _h + 1, greatest(size(turns), 1)))").alias("turns"))


def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of each conversation's path."""
    for batch in batches:
        paths = []
        for turns in batch.column("turns").to_pylist():
            mark, total, units = b"", 0, []
            for turn in turns:
                mark = hashlib.blake2b(mark + turn["digest"], digest_size=MARK).digest()
                total += turn["n"]
                units += [mark, total.to_bytes(UNIT - MARK, "big")]
            paths.append(b"".join(units))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, pa.binary())], ["conv_id", "path"])


def shared_units(a: bytes, b: bytes) -> int:
    """Leading units two paths share; a fingerprint covers all before it, so halving the range finds the number."""
    low, high = 0, min(len(a), len(b)) // UNIT
    while low < high:
        middle = (low + high + 1) // 2
        at = (middle - 1) * UNIT
        if a[at : at + MARK] == b[at : at + MARK]:
            low = middle
        else:
            high = middle - 1
    return low


def leave(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Depth ``lam`` at which each path leaves its exit node's edge."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("path", "lo", "edge")]
        lam = [lo + shared_units(path[lo * UNIT :], edge) for path, lo, edge in zip(*columns)]
        kept = ["path", "n", "node", "lo", "hi"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(lam, pa.int32())], [*kept, "lam"])


NODE = "key binary, parent binary, lo int, hi int, before long, edge binary"


def compacted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compacted nodes of sorted remainders of paths. Only the open nodes of one path are held, whatever a group's size."""
    names = ["key", "parent", "lo", "hi", "before", "edge"]
    types = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    rows: list[tuple] = []
    held, at, attach, before, ends = b"", 0, b"", 0, []

    def close(depth: int) -> None:
        """Emit the open nodes that end below ``depth``; one that a new path splits there stays open down to it."""
        while ends and ends[-1] > depth:
            end = ends.pop()
            start = max(ends[-1] if ends else 0, depth)
            mark = held[(start - 1) * UNIT : (start - 1) * UNIT + MARK] if start else attach
            base = int.from_bytes(held[start * UNIT - UNIT + MARK : start * UNIT], "big") if start else before
            rows.append((held[(end - 1) * UNIT : (end - 1) * UNIT + MARK], mark, at + start, at + end, base, held[start * UNIT : end * UNIT]))
            if start and (not ends or ends[-1] < start):
                ends.append(start)

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
        rows.clear()
        return out

    for batch in batches:
        for rest, new_at, new_attach, new_before in zip(*[batch.column(c).to_pylist() for c in ("rest", "lam", "attach", "before")]):
            close(shared_units(held, rest))
            held, at, attach, before = rest, new_at, new_attach, new_before
            ends.append(len(rest) // UNIT)
            if len(rows) > 5000:
                yield flushed()
    close(0)
    if rows:
        yield flushed()


def with_handles(nodes: DataFrame) -> DataFrame:
    """``handle``: the fingerprint at the two-fattest depth of (lo, hi], and that depth's trailing zero bits as ``level``."""
    step = F.expr("shiftleft(1, cast(floor(log2(lo ^ hi)) as int))")
    fat = nodes.withColumn("_f", (F.col("hi") - F.col("hi") % step).cast("int"))
    fat = fat.withColumn("handle", unit_mark("edge", "(_f - lo)")).withColumn("level", F.expr("cast(round(log2(_f & (-_f))) as int)"))
    return fat.drop("_f")


def exits(paths: DataFrame, nodes: DataFrame | None, longest: int) -> DataFrame:
    """``path, n, node, lo, hi, lam`` of each path: its exit node and the depth at which it leaves that node's edge.

    The search ends at the deepest node whose handle lies on the path; one more join finds the edge below it, if the path takes
    one. A path enters at the power of two below its length. One probe per power: a hit moves the lower bound to the node's depth,
    a miss the upper bound below the probe. Paths without a probe at a power carry a key of their own that no handle equals.
    """
    start = paths.select("path", "n", F.lit(0).alias("l"), F.col("n").alias("r"), F.expr(ROOT).alias("node"), F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.expr(ROOT).alias("edge"))
    state = start.where("n = 0")
    if nodes is None:
        state = start
    for level in range(int(math.log2(longest)) if nodes is not None and longest else -1, -1, -1):
        state = state.unionByName(start.where(F.col("n").between(1 << level, (2 << level) - 1)))
        probe = state.withColumn("_f", F.expr(f"r - r % {1 << level}"))
        probe = probe.withColumn("_key", F.expr(f"case when _f > l then substring(path, (_f - 1) * {UNIT} + 1, {MARK}) else path end"))
        table = nodes.where(F.col("level") == level).select(F.col("handle").alias("_key"), F.col("key").alias("_node"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("edge").alias("_edge"))
        found, tried = F.col("_node").isNotNull(), F.col("_f") > F.col("l")
        state = probe.join(table, "_key", "left").select(
            "path", "n",
            F.when(found, F.col("_hi")).otherwise(F.col("l")).alias("l"),
            F.when(tried & ~found, F.col("_f") - 1).otherwise(F.col("r")).alias("r"),
            *[F.when(found, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("node", "lo", "hi", "edge")],
        )
    if nodes is not None:
        # a path that leaves an edge above its handle is seen at the node before; that edge is found by its first unit
        probe = state.withColumn("_key", F.expr(f"case when n > hi then substring(path, hi * {UNIT} + 1, {MARK}) else path end"))
        table = nodes.select(F.expr(f"substring(edge, 1, {MARK})").alias("_key"), F.col("key").alias("_node"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("edge").alias("_edge"))
        state = probe.join(table, "_key", "left").select(
            "path", "n", *[F.when(F.col("_node").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("node", "lo", "hi", "edge")]
        )
    return state.select("path", "n", "node", "lo", "hi", "edge").mapInArrow(leave, "path binary, n int, node binary, lo int, hi int, lam int")


def inserted(nodes: DataFrame | None, left: DataFrame) -> DataFrame:
    """The nodes after a batch: edges split where paths left them, and new nodes below the places they left at."""
    rest = left.where("n > lam").select(
        F.expr(f"substring(path, lam * {UNIT} + 1)").alias("rest"), "lam",
        F.when(F.col("lam") == 0, F.expr(ROOT)).otherwise(unit_mark("path", "lam")).alias("attach"),
        F.when(F.col("lam") == 0, F.lit(0)).otherwise(unit_bytes("path", "lam")).cast("long").alias("before"),
    )
    rest = rest.repartition(F.expr(f"substring(rest, 1, {MARK})")).sortWithinPartitions("rest")
    new = rest.mapInArrow(compacted, NODE)
    if nodes is None:
        return with_handles(new)
    cuts = left.where("lam < hi").groupBy(F.col("node").alias("key")).agg(F.collect_set("lam").alias("cuts"))
    split = nodes.join(cuts, "key", "left").select("parent", "lo", "before", "edge", F.expr("array_sort(concat(coalesce(cuts, array()), array(hi)))").alias("ends"))
    split = split.select("parent", F.col("lo").alias("_lo"), F.col("before").alias("_before"), F.col("edge").alias("_edge"), "ends", F.posexplode("ends").alias("i", "hi"))
    split = split.withColumn("lo", F.expr("if(i = 0, _lo, element_at(ends, greatest(i, 1)))"))
    parts = split.select(
        unit_mark("_edge", "(hi - _lo)").alias("key"),
        F.when(F.col("i") == 0, F.col("parent")).otherwise(unit_mark("_edge", "(lo - _lo)")).alias("parent"),
        "lo", "hi",
        F.when(F.col("i") == 0, F.col("_before")).otherwise(unit_bytes("_edge", "(lo - _lo)")).alias("before"),
        F.expr(f"substring(_edge, (lo - _lo) * {UNIT} + 1, (hi - lo) * {UNIT})").alias("edge"),
    )
    return with_handles(parts.unionByName(new))


def trie(paths: DataFrame) -> DataFrame:
    """Compacted nodes ``key, parent, lo, hi, before, edge, handle, level`` of distinct paths (path, n); the root is not a row.

    Batches are drawn by a hash of the path. A random batch finds a trie an eighth of its size, so few of its paths
    leave at one place; the first, of some ``FIRST_BATCH`` paths, is the only one that meets an empty trie.
    """
    total, longest = paths.agg(F.count("*"), F.max("n")).first()
    draw = F.pmod(F.xxhash64("path"), F.lit(1 << 30))
    nodes, low, share = None, 0, min(1.0, FIRST_BATCH / max(total, 1))
    while low < 1 << 30:
        high = 1 << 30 if share >= 1 else max(low + 1, int(share * (1 << 30)))
        batch = paths.where((draw >= low) & (draw < high))
        left = exits(batch, nodes, longest or 0)
        nodes = written(inserted(nodes, written(left, "exits") if nodes is not None else left), "trie")
        low, share = high, share * GROWTH
    return nodes


def joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, conv_id) as comma-joined chunks of ids."""
    out: list[tuple] = []
    key, ids, size = None, [], 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["key", "first", "ids"])

    for batch in batches:
        for new_key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (new_key != key or size > CHUNK):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids, size = [], 0
                if len(out) > 500:
                    yield batch_of(out)
                    out = []
            key = new_key
            ids.append(conv)
            size += 8
    if ids:
        out.append((key, ids[0], ",".join(map(str, ids))))
    if out:
        yield batch_of(out)


def digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (key, first) as one digest per key."""
    key, running, done = None, None, []
    for batch in batches:
        for new_key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if running is not None and new_key == key:
                running.update(b"," + ids.encode())
                continue
            if running is not None:
                done.append((key, running.hexdigest()))
            key, running = new_key, hashlib.sha256(ids.encode())
        if len(done) > 2000:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends"])
            done = []
    if running is not None:
        done.append((key, running.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends"])


def end_digests(members: DataFrame) -> DataFrame:
    """``key, ends``: sha256 of each key's ids in ascending order, comma-joined.

    Ids are sorted through range partitions and joined to chunks there; a digest is sequential by nature, so one task reads
    a key's chunks, some thousands of ids a row, and holds one at a time.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = members.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(joined_ids, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digested, "key binary, ends string")


def prefix_nodes(rows: DataFrame) -> DataFrame:
    """One row per node of the trie over all rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    ``rows`` has conv_id, turn, role and text; null role or text is empty, a null turn comes first, turns with one number are
    ordered by their content's digest, rows without conversation are left out, other columns are ignored. Conversations that
    end up without turns belong to the root. An empty table gives an empty result. Equal conversations are one path from the
    start, so copies cost one row each. Counts are partial sums per prefix, so a first turn that a third of all share is no
    hot key. A conversation is the unit of work: its 24 bytes a turn are one value.

    Sums over a subtree need no walk: the smallest conversation of a node owns it, and with it all deeper nodes of its path, so
    the bytes of distinct nodes below a depth are sums over conversations of what each owns there.
    """
    whole = rebuilt(written(sequences(rows), "turns")).mapInArrow(chain, "conv_id long, path binary")
    members = written(whole.withColumn("n", F.expr(f"cast(length(path) / {UNIT} as int)")), "paths")
    key = F.when(F.col("n") == 0, F.expr(ROOT)).otherwise(unit_mark("path", "n"))
    classes = members.groupBy("path", "n").agg(F.count("*").alias("copies"), F.min("conv_id").alias("least")).withColumn("key", key)
    classes = written(classes.withColumn("total", F.when(F.col("n") == 0, 0).otherwise(unit_bytes("path", "n")).cast("long")), "classes")
    nodes = trie(classes.where("n > 0").select("path", "n"))
    ends = end_digests(members.select(key.alias("key"), "conv_id"))
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))

    along = F.posexplode(F.expr("sequence(1, n)")).alias("_i", "d")
    counted = classes.where("n > 0").select("path", "copies", "least", along).groupBy(unit_mark("path", "d").alias("key")).agg(F.sum("copies").alias("convs"), F.min("least").alias("conv"))
    stats = nodes.select("key", "parent", "lo", "hi", "before", "edge").join(counted, "key").join(children, "key", "left")
    stats = written(stats.withColumn("children", F.coalesce("children", F.lit(0))), "stats")

    owned = stats.groupBy(F.col("conv").alias("least")).agg((F.min("lo")).alias("own"))
    owners = classes.join(owned, "least", "left").join(stats.select("key", "children"), "key", "left")
    free = F.when(F.col("own").isNull(), F.col("total")).when(F.col("own") == 0, 0).otherwise(unit_bytes("path", "own"))
    owners = owners.select("path", "n", "copies", "least", "total", free.cast("long").alias("free"), F.coalesce((F.col("children") == 0).cast("long"), F.lit(0)).alias("leaf"))
    owners = written(owners, "owners")

    def below(upto: Column) -> Column:
        """Bytes saved below a depth whose prefix has ``upto`` bytes: all copies' bytes less those of distinct nodes."""
        return F.sum(F.col("copies") * (F.col("total") - upto) - (F.col("total") - F.greatest("free", upto)))

    spread = owners.where("n > 0").select("path", "copies", "total", "free", "leaf", along)
    spread = spread.select(unit_mark("path", "d").alias("key"), "copies", "total", "free", "leaf", unit_bytes("path", "d").alias("upto"))
    sums = spread.groupBy("key").agg(below(F.col("upto")).alias("below"), F.sum("leaf").alias("leaves"))
    top = owners.agg(F.sum("copies").alias("convs"), F.min("least").alias("conv"), below(F.lit(0)).alias("below"), F.sum("leaf").alias("leaves"))
    parents = stats.select(F.col("key").alias("_up"), F.col("conv").alias("_up_conv"))
    first = owners.agg(F.min("least")).first()[0]

    whole_nodes = stats.join(sums, "key").join(ends, "key", "left").withColumn("_up", F.when(F.col("parent") == F.expr(ROOT), F.col("key")).otherwise(F.col("parent")))
    whole_nodes = whole_nodes.join(parents, "_up")
    each = whole_nodes.select("*", F.explode(F.expr("sequence(lo + 1, hi)")).alias("depth"))
    last, start = F.col("depth") == F.col("hi"), F.when(F.col("depth") == F.col("lo") + 1, F.col("before")).otherwise(unit_bytes("edge", "(depth - 1 - lo)"))
    above = F.when(F.col("depth") > F.col("lo") + 1, F.col("conv")).when(F.col("parent") == F.expr(ROOT), F.lit(first)).otherwise(F.col("_up_conv"))
    expanded = each.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), above.cast("long").alias("parent_conv_id"), F.col("convs").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("below") + (F.col("convs") - 1) * (unit_bytes("edge", "(hi - lo)") - start)).cast("long").alias("saved_tokens"),
        F.when(last, F.coalesce("ends", F.lit(NO_ENDS))).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    # the root's row is put together from one row of each of its parts
    parts = [top, ends.where(F.col("key") == F.expr(ROOT)).select("ends"), children.where(F.col("key") == F.expr(ROOT)).select("children")]
    root = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    root = root.agg(*[F.max(c).alias(c) for c in root.columns]).where("conv is not null").select(
        F.col("conv").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("convs").alias("n_convs"),
        F.coalesce("children", F.lit(0)).cast("long").alias("n_children"), F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.col("below").cast("long").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return expanded.unionByName(root)
