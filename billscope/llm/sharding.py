"""Sharding by balanced label propagation.

Documents are linked by what they share (a link value each). In rounds, every linked document looks at how its links'
members are spread over the shards and moves towards the shard that holds most of them, as far as quotas allow.
Documents without links fill the shards at the end, which makes the sizes exactly even.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import written
from billscope.operators.windows import in_sequence


@dataclass(frozen=True)
class Settings:
    rounds: int = 6
    levels: int = 24  # gains are sorted into powers of two for the quotas
    slices: int = 64  # part of a level that may move: whole slices of links


def placed_at_first(links: DataFrame, shards: int) -> Column:
    return F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")


def propagate(members: DataFrame, shards: int, capacity: int, settings: Settings = Settings()) -> DataFrame:
    """``node, link, shard`` for linked nodes after propagation; no shard holds more than ``capacity`` nodes at the end
    of a round unless it did before.

    ``members`` has a row (node, link) for each link of a node. A round counts the members of every link per shard (partial
    sums first), hands each node these ``shards`` counts through a join on the link (a frequent link is split by the
    engine, since its other side is one row), and sums them per node. What moves is decided from a table of at most
    shards x shards x levels x slices counts; the driver sees nothing else.
    """
    state = written(members.withColumn("shard", placed_at_first(members, shards)), "state")
    for _ in range(settings.rounds):
        spread = written(
            state.groupBy("link", "shard").agg(F.count("*").alias("n")).groupBy("link").agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("spread")),
            "spread",
        )
        # ties between shards fall by a hash of the link, so that all its members agree on one
        pull = [
            (F.coalesce(F.element_at("spread", F.lit(s)), F.lit(0)) + F.pmod(F.xxhash64("link", F.lit(s)), F.lit(1000)) / 2000.0).alias(f"p{s}")
            for s in range(shards)
        ]
        pulls = state.join(spread, "link").select("node", "link", "shard", *pull)
        nodes = pulls.groupBy("node").agg(F.first("shard").alias("shard"), F.min("link").alias("first_link"), *[F.sum(f"p{s}").alias(f"p{s}") for s in range(shards)])
        held = {row["shard"]: row["n"] for row in nodes.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = np.array([capacity - held.get(s, 0) for s in range(shards)])
        # a shard without room is not worth wishing for, unless the node is there
        wish = F.greatest(*[F.struct(F.when((F.lit(int(room[s])) > 0) | (F.col("shard") == s), F.col(f"p{s}")).otherwise(-1.0).alias("p"), F.lit(s).alias("s")) for s in range(shards)])
        here = F.element_at(F.array(*[F.col(f"p{s}") for s in range(shards)]), F.col("shard") + 1)
        wishes = nodes.withColumn("wish", wish).withColumn("target", F.col("wish.s")).withColumn("gain", F.col("wish.p") - here)
        level = F.least(F.greatest(F.floor(F.log2(F.greatest(F.col("gain"), F.lit(1e-3)))) + 10, F.lit(0)), F.lit(settings.levels - 1)).cast("int")
        part = F.pmod(F.xxhash64("first_link", F.lit(7)), F.lit(settings.slices)).cast("int")
        wishes = wishes.withColumn("level", level).withColumn("part", part)
        wishes = written(wishes.select("node", "shard", "target", "level", "part", (F.col("target") != F.col("shard")).alias("moves")), "wishes")
        asked = wishes.where("moves").groupBy("shard", "target", "level", "part").agg(F.count("*").alias("n")).collect()
        if not asked:
            break
        granted = quotas(asked, room)
        if not granted:
            break
        allowed = state.sparkSession.createDataFrame(granted, "shard int, target int, level int, part int")
        moved = wishes.where("moves").join(F.broadcast(allowed), ["shard", "target", "level", "part"]).select("node", F.col("target").alias("to"))
        state = written(state.join(moved, "node", "left").select("node", "link", F.coalesce("to", "shard").alias("shard")), "state")
    return state


def quotas(asked: list, room: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The groups of wishes that may move: highest gain first, as long as the target has room, counting what leaves it."""
    room, granted = room.astype(np.int64).copy(), []
    waiting = sorted(((-row["level"], row["part"], row["shard"], row["target"], row["n"]) for row in asked))
    progress = True
    while progress:
        progress, rest = False, []
        for level, part, shard, target, n in waiting:
            if n <= room[target]:
                granted.append((shard, target, -level, part))
                room[target] -= n
                room[shard] += n
                progress = True
            else:
                rest.append((level, part, shard, target, n))
        waiting = rest
    return granted


def row_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` with law ``rows``: counts of shards differ by one at most.

    Links are equal texts. Size is the text's UTF-8 bytes plus one; a null text counts as empty, for its links as well.
    ``slot`` numbers a shard's rows from 0 without gaps. ``grown_shard`` is null, since this law follows the counts. Rows
    are nodes: repeated rows and rows without id each take a place of their own. An empty table gives an empty result,
    other columns are ignored.

    Rows beyond a shard's share, and all rows without links, are numbered through range partitions and dealt to the
    free places; no task holds a shard or a group of copies.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text.cast("binary"), 256).alias("link")
    )
    rows = written(rows.withColumn("node", F.monotonically_increasing_id()), "rows")
    shared = written(rows.groupBy("link").agg(F.count("*").alias("n")).where("n > 1").select("link"), "shared")
    members = written(rows.join(shared, "link", "left_semi").select("node", "link"), "members")
    total = rows.count()
    share = [total // shards + (s < total % shards) for s in range(shards)]
    state = propagate(members, shards, max(total // shards, 1), settings)
    ranked = in_sequence(state, ["shard"], ["link", "node"], number="place")
    take = F.element_at(F.array(*[F.lit(n).cast("long") for n in share]), F.col("shard") + 1)
    ranked = written(ranked.withColumn("kept", F.col("place") <= take), "ranked")
    kept = ranked.where("kept").select("node", "shard", (F.col("place") - 1).alias("slot"))
    held = {row["shard"]: row["n"] for row in kept.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    # the free places of all shards, one behind the other
    free = [share[s] - held.get(s, 0) for s in range(shards)]
    ends = np.cumsum(free).tolist()
    rest = ranked.where("not kept").select("node", "link").unionByName(rows.select("node", "link").join(members.select("node"), "node", "left_anti"))
    rest = in_sequence(written(rest, "rest"), [], ["link", "node"], number="place")
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in reversed(range(shards)):
        inside = F.col("place") <= ends[s]
        shard = F.when(inside, s).otherwise(shard)
        slot = F.when(inside, F.col("place") - 1 - (ends[s] - free[s]) + held.get(s, 0)).otherwise(slot)
    dealt = rest.select("node", shard.alias("shard"), slot.alias("slot"))
    places = kept.unionByName(dealt)
    return rows.join(places, "node").select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
