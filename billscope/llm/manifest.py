"""Merkle manifest of a table, and the proof of every leaf by pointer jumping.

Leaves of one tree (here: one language) are hashed in runs of ``fan`` until one node is left, its subroot; the subroots are
hashed the same way up to one root. Every node holds the digests of its run's other nodes, its sibling segment, and points at
its parent. Repeated self-joins replace each pointer by the pointer's pointer and append the segment found there, so that the
distance covered doubles with each join and a tree of any size is proven in a number of joins that grows with the logarithm of
its height.

Digests are kept as 32 bytes and hashed as lowercase hex text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import written
from billscope.operators.windows import in_sequence

FAN = 8
DIGEST = 32
# Ancestors are broadcast up to this many bytes, computed from their counted number; above it they are joined by key.
BROADCAST_BYTES = 4 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def hashed(*parts: Column) -> Column:
    """Binary sha256 of the concatenated parts (strings)."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A field as leaves hash it: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return hashed(*[field(value) for value in values])


def code_of(tree: Column) -> Column:
    """A non-null name of a tree that sorts null first, then by the UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-"))


def level_runs(level: DataFrame, fan: int) -> DataFrame:
    """``tree, run, kids, digest, last`` of nodes (tree, idx, node, digest, sub, row); ``last``: a single node is left of the tree."""
    kid = F.struct("idx", "node", "digest", "sub", "row")
    runs = level.groupBy("tree", F.floor(F.col("idx") / fan).alias("run")).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    joined = F.array_join(F.transform("kids", lambda k: text_of(k["digest"])), "")
    return runs.select("tree", "run", "kids", hashed(joined).alias("digest"), ((F.col("run") == 0) & (F.size("kids") == 1)).alias("last"))


def pointers(runs: DataFrame, up: Column, height: int) -> DataFrame:
    """The nodes of the runs: ``node, up, height, seg, sub, row`` with one sibling segment each."""
    kids = runs.select(up.alias("up"), F.expr("unhex(array_join(transform(kids, k -> hex(k.digest)), ''))").alias("run"), F.posexplode("kids").alias("pos", "kid"))
    left = F.expr(f"substring(run, 1, {DIGEST} * pos)")
    right = F.expr(f"substring(run, {DIGEST} * pos + {DIGEST + 1})")
    return kids.select(
        F.col("kid.node").alias("node"), "up", F.lit(height).alias("height"), F.array(F.struct(left.alias("left"), right.alias("right"))).alias("seg"),
        F.col("kid.sub").alias("sub"), F.col("kid.row").alias("row"),
    )


def climbed(level: DataFrame, fan: int, mark: str, top: bool) -> tuple[list[DataFrame], DataFrame | None, int]:
    """All trees of ``level`` built up to one node each: pointer tables of the levels, the single nodes left, the height.

    A level is written once and read for its pointers and for the next level; it has 1/``fan`` of the rows below it.
    """
    tables, singles, height = [], None, 0
    while True:
        runs = written(level_runs(level, fan), f"{mark}{height}")
        single = runs.where("last").select("tree", F.explode("kids").alias("kid")).select("tree", "kid.*")
        singles = single if singles is None else singles.unionByName(single)
        more = runs.where("not last")
        name = F.concat(F.lit(f"{mark}{height + 1}:"), F.col("run").cast("string"), F.lit(":"), F.col("tree"))
        if more.isEmpty():
            return tables, singles, height
        # a node of the upper tree may stand a few steps above a leaf; none of the lower one is nearer than its level
        tables.append(pointers(more, name, 1 << 20 if top else height))
        row = F.lit(None).cast(dict(level.dtypes)["row"])
        level = more.select("tree", F.col("run").alias("idx"), name.alias("node"), "digest", F.lit(None).cast("binary").alias("sub"), row.alias("row"))
        height += 1


def proofs(leaves: DataFrame, tree: str, order: Sequence[str], digest: str, carry: Sequence[str], fan: int = FAN) -> tuple[DataFrame, str | None]:
    """Each leaf with its proof, and the root as hex text (None for an empty table).

    ``leaves`` has a tree name (null is a tree of its own, the first), the columns its leaves are ordered by, a binary digest
    and columns to carry. The result has ``tree``'s code, the carried columns, ``digest``, ``subroot`` (binary) and ``seg``: an
    array from leaf to root of (left, right), the concatenated digests of a run's other nodes before and after. Leaves that
    agree in ``order`` take neighbouring places; let ``order`` end in the digest, so that only equal leaves are exchanged.

    Leaves are numbered through range partitions, so a tree may hold any share of the rows. A pointer at distance d is
    shared by at most fan^d nodes; the far ancestors are few, and broadcast once their counted size is below a bound.
    """
    kept = [c for c in dict.fromkeys([*order, *carry])]
    base = leaves.select(code_of(F.col(tree)).alias("_tree"), F.col(digest).alias("_digest"), F.struct(*kept).alias("_row"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    numbered = in_sequence(written(base, "leaves"), ["_tree"], [f"_o{i}" for i in range(len(order))], number="_n")
    none = F.lit(None).cast("binary")
    name = F.concat(F.lit("leaf:"), (F.col("_n") - 1).cast("string"), F.lit(":"), F.col("_tree"))
    level = numbered.select(F.col("_tree").alias("tree"), (F.col("_n") - 1).alias("idx"), name.alias("node"), F.col("_digest").alias("digest"), none.alias("sub"), F.struct("_tree", "_digest", "_row").alias("row"))
    low, subroots, height = climbed(level, fan, "low", top=False)
    subroots = written(subroots.withColumn("sub", F.col("digest")).drop("idx"), "subroots")
    placed = in_sequence(subroots, [], ["tree"], number="idx").withColumn("idx", F.col("idx") - 1).withColumn("tree", F.lit(""))
    top, roots, above = climbed(placed.select("tree", "idx", "node", "digest", "sub", "row"), fan, "top", top=True)
    found = roots.select("digest").first()
    root = None if found is None else bytes(found["digest"]).hex()
    ends = roots.select("node", F.lit(None).cast("string").alias("up"), F.lit(1 << 20).alias("height"), F.expr("cast(array() as array<struct<left:binary,right:binary>>)").alias("seg"), "sub", "row")
    nodes = ends
    for table in [*low, *top]:
        nodes = nodes.unionByName(table)
    distance, reach = 1, height + above
    nodes = written(nodes, "pointers") if distance < reach else nodes
    while distance < reach:
        last = 2 * distance >= reach
        nodes = jumped(nodes, distance, last)
        nodes = nodes if last else written(nodes, "pointers")
        distance *= 2
    out = nodes.where("row is not null").select(F.col("row._tree").alias("tree"), "row._row.*", F.col("row._digest").alias("digest"), "sub", "seg")
    # a pointer that reaches the root has not looked at it: where no subroot was passed, the root is the subroot
    out = out.withColumn("subroot", F.coalesce("sub", F.unhex(F.lit(root).cast("string"))))
    return out.select("tree", *carry, "digest", "subroot", "seg"), root


def jumped(nodes: DataFrame, distance: int, leaves_only: bool) -> DataFrame:
    """Every pointer replaced by its target's, every segment followed by the target's."""
    targets = nodes.where((F.col("height") >= distance) & F.col("row").isNull())
    targets = targets.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("seg").alias("_seg"), F.col("sub").alias("_sub"))
    size = targets.count() * (distance * (FAN * DIGEST + 16) + 128)
    targets = F.broadcast(targets) if size <= BROADCAST_BYTES else targets
    wanted = nodes.where("row is not null") if leaves_only else nodes
    # a top node's parent pointer may be shorter than the distance: it has reached the root and has no pointer left
    going = wanted.where("up is not null").join(targets, "up").select(
        "node", F.col("_up").alias("up"), "height", F.concat("seg", "_seg").alias("seg"), F.coalesce("sub", "_sub").alias("sub"), "row"
    )
    return going.unionByName(wanted.where("up is null"))


def folded(start: Column, seg: str = "seg") -> Column:
    """The root (hex text) that a leaf digest and a proof lead to."""
    return F.aggregate(seg, text_of(start), lambda now, s: F.sha2(F.concat(text_of(s["left"]), now, text_of(s["right"])).cast("binary"), 256))


def siblings_digest(seg: str = "seg") -> Column:
    """sha256 over the hex text of all siblings, from leaf to root, left to right."""
    return F.sha2(F.array_join(F.transform(seg, lambda s: F.concat(text_of(s["left"]), text_of(s["right"]))), "").cast("binary"), 256)


def checked_documents(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: a proof for every row of a documents table.

    Where 3 divides the crc32 of the id's decimals, the proof is tried on a tampered row, its text's A-Z in lower case; it
    fails there if the text had a capital. Trees are languages, ordered by id and, where ids repeat, by the leaf's digest.
    Null fields hash as ``-``; a null id comes first and is not tampered with; equal rows are leaves of their own; a null
    language is a tree of its own. Texts of any length are hashed whole. An empty table gives an empty result; other columns
    are ignored, whatever their names.
    """
    text, doc = F.col("text"), F.col("doc_id")
    tampers = F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 0, F.lit(False)) & text.rlike("[A-Z]")
    lowered = F.translate(text, UPPER, UPPER.lower())
    rows = docs.select("doc_id", "lang", leaf_digest(doc, F.col("source"), F.col("lang"), F.col("n_chars"), text).alias("leaf"),
                       F.when(tampers, leaf_digest(doc, F.col("source"), F.col("lang"), F.col("n_chars"), lowered)).alias("tampered"))
    proven, root = proofs(rows, "lang", ["doc_id", "leaf"], "leaf", ["doc_id", "tampered"], fan)
    out = proven.select(
        "doc_id", text_of(F.col("digest")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"), F.lit(root).cast("string").alias("root"),
        siblings_digest().alias("proof_sha256"), folded(F.coalesce("tampered", "digest")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
