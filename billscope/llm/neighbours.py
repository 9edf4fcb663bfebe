"""Approximate nearest neighbours: inverted lists scanned with adaptive numbers of dimensions.

Vectors are scaled to length one and turned by a random rotation, after which a few columns estimate a distance. A list
is scanned in blocks of columns: a candidate whose partial distance, scaled up, exceeds the best known one by more
than its sampling error allows is abandoned. Survivors are scored exactly on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billscope.llm.common import written
from billscope.llm.groups import sorted_groups


@dataclass(frozen=True)
class Settings:
    """Bounds of the index; every vector is in it whatever they are."""

    sample: int = 16_000  # vectors the lists are fitted on
    most_lists: int = 4096
    recall: float = 0.97  # on the sample, decides how many lists a query visits
    columns: int = 16  # a block of the scan
    doubt: float = 2.1  # standard errors a partial distance may be off before its candidate is abandoned
    vectors: int = 4096  # candidates in one step of a task
    queries: int = 1024  # queries in one step of a task


@dataclass
class Lists:
    rotation: np.ndarray
    centres: np.ndarray
    visits: int

    def order(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists with the nearest centres, nearest first."""
        return np.argsort(-(unit @ self.centres.T), axis=1, kind="stable")[:, :n]

    def visited(self, unit: np.ndarray, sizes: np.ndarray, least: int) -> list[list[int]]:
        """The lists each query visits: ``visits`` of them, and more until they hold ``least`` vectors."""
        out = []
        for part in np.array_split(unit, max(1, len(unit) // 256)):
            order = self.order(part, len(self.centres))
            short = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1)
            out += [row[: max(self.visits, n + 1)].tolist() for row, n in zip(order, short)]
        return out


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_lists(sample: np.ndarray, total: int, k: int, settings: Settings) -> Lists:
    """Rotation, list centres (spherical k-means) and the number of lists to visit, from a bounded sample."""
    rng = np.random.default_rng(20)
    unit = unit_rows(sample)
    rotation = np.linalg.qr(rng.normal(size=(unit.shape[1], unit.shape[1])))[0]
    unit = unit @ rotation
    n_lists = int(max(1, min(settings.most_lists, len(unit) // 8, np.sqrt(total) / 2)))
    centres = unit[rng.choice(len(unit), n_lists, replace=False)]
    for _ in range(8):
        nearest = np.concatenate([np.argmax(part @ centres.T, axis=1) for part in np.array_split(unit, max(1, len(unit) // 2000))])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    lists = Lists(rotation, centres, n_lists)
    nearest = np.argmax(unit @ centres.T, axis=1)
    tried = np.arange(0, len(unit), max(1, len(unit) // 400))
    near = unit[tried] @ unit.T
    near[np.arange(len(tried)), tried] = -2
    best = np.argpartition(-near, min(k, len(unit) - 1), axis=1)[:, : min(k, len(unit))]
    place = np.argsort(lists.order(unit[tried], n_lists), axis=1)  # how late a query visits each list
    late = np.sort(np.take_along_axis(place, nearest[best], axis=1).ravel())
    lists.visits = int(late[min(len(late) - 1, int(np.ceil(settings.recall * len(late))))]) + 1
    return lists


def scan(queries: np.ndarray, vectors: np.ndarray, keep: int, rotation: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) index pairs that may be among each query's ``keep`` nearest of these vectors, ``keep`` at least."""
    q, x = (unit_rows(queries) @ rotation).astype(np.float32), (unit_rows(vectors) @ rotation).astype(np.float32)
    width = x.shape[1]
    if len(x) <= keep:
        return np.repeat(np.arange(len(q)), len(x)), np.tile(np.arange(len(x)), len(q))
    # distances to a first few vectors give each query a bound
    first = x[: max(keep, min(len(x), 8 * keep))]
    known = 2 - 2 * (q @ first.T)
    nearest = np.argpartition(known, keep - 1, axis=1)[:, :keep]
    bound = np.take_along_axis(known, nearest, axis=1).max(axis=1)
    sure = np.zeros((len(q), len(x)), dtype=bool)  # never abandoned, so that none is left with fewer
    np.put_along_axis(sure, nearest, True, axis=1)
    step = min(settings.columns, width)
    partial = (q[:, :step] ** 2).sum(1)[:, None] + (x[:, :step] ** 2).sum(1)[None, :] - 2 * (q[:, :step] @ x[:, :step].T)
    seen = step

    def limit(seen: int) -> np.ndarray:
        slack = (1 + settings.doubt / np.sqrt(seen)) ** 2 if seen < width else 1.0
        return bound * (seen / width) * slack + 1e-5

    a, b = np.nonzero((partial <= limit(seen)[:, None]) | sure)
    d = partial[a, b]
    while seen < width:
        end = min(width, seen + step)
        d = d + ((q[a, seen:end] - x[b, seen:end]) ** 2).sum(1)
        seen = end
        kept = (d <= limit(seen)[a]) | sure[a, b]
        a, b, d = a[kept], b[kept], d[kept]
    order = np.lexsort((d, a))
    a, b, d = a[order], b[order], d[order]
    opens = np.searchsorted(a, np.arange(len(q)))
    rank = np.arange(len(a)) - opens[a]
    last = np.full(len(q), np.inf, dtype=np.float32)
    at = rank == keep - 1
    last[a[at]] = d[at]
    kept = d <= last[a] + 1e-5
    return a[kept], b[kept]


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part, with the 128-bit key of their vector."""
    value = F.col("embedding")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    rows = vectors.select("vec_id", value.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & value.isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.reverse("embedding"), F.lit(1)))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row whose id is a multiple of ``every``.

    Nearness is the cosine in double precision on the original vectors, ties go to the smaller id; the query's own id
    is no candidate. Rows take no part if their id or vector is null, or the vector is zero, holds a null or
    non-finite component, or has not the most frequent length (ties: the shorter). Rows equal in id and vector count once.
    Fewer are returned only where fewer candidates exist, then all: a query goes on to further lists until those visited
    hold ``k + 1`` vectors beside its own. An empty table gives an empty result; other columns are ignored.

    Equal vectors are one node of the index with its ``k + 1`` smallest ids, all that a result can show of them, so a
    vector that fills a third of the table costs no more than another. Lists and their queries are cut into steps of
    bounded size; query rows travel to the lists they visit, nothing is broadcast but the list centres.
    """
    rows = usable(vectors)
    size = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)["vec_id"]
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("embedding") == size["size"])
    ids = written(rows.groupBy("h1", "h2", "vec_id").agg(F.count("*").alias("n")).drop("n"), "ids")
    key = ["h1", "h2"]
    by_id = Window.partitionBy(*key).orderBy("vec_id")
    members = written(ids.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1).drop("place"), "members")
    firsts = members.groupBy(*key).agg(F.min("vec_id").alias("least"))
    asks = ids.where(F.col("vec_id") % every == 0)
    asked = asks.select(*key).distinct().withColumn("asked", F.lit(True))
    nodes = rows.groupBy(*key).agg(F.first("embedding").alias("embedding")).join(firsts, key).join(asked, key, "left")
    nodes = written(nodes, "nodes")
    total = nodes.count()
    drawn = nodes.orderBy("h1", "h2").limit(settings.sample).select("embedding").collect()
    lists = spark.sparkContext.broadcast(fit_lists(np.array([row["embedding"] for row in drawn]), total, k, settings))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = lists.value
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = unit_rows(matrix_of(batch.column("embedding"))) @ index.rotation
            yield pa.RecordBatch.from_pydict({**{name: batch.column(name) for name in node}, "list": pa.array(np.argmax(unit @ index.centres.T, axis=1), pa.int32())})

    node = ["h1", "h2", "least", "embedding", "asked"]
    schema = f"h1 long, h2 long, least {kind}, embedding array<double>"
    placed = written(nodes.select(*node).mapInArrow(place, f"{schema}, asked boolean, list int"), "placed")
    held = written(placed.groupBy("list").agg(F.count("*").alias("vectors")), "held")  # one row per list
    sizes = np.zeros(len(lists.value.centres), dtype=np.int64)
    for row in held.collect():
        sizes[row["list"]] = row["vectors"]
    filled = spark.sparkContext.broadcast(sizes)

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = lists.value
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = unit_rows(matrix_of(batch.column("embedding"))) @ index.rotation
            visits = index.visited(unit, filled.value, k + 2)  # the query's own and k + 1 others
            yield pa.RecordBatch.from_pydict({**{name: batch.column(name) for name in node[:4]}, "visits": pa.array(visits, pa.list_(pa.int32()))})

    asking = written(placed.where("asked").select(*node[:4]).mapInArrow(visit, f"{schema}, visits array<int>"), "asking")
    # how many steps each list is cut into
    wanted = asking.select(F.explode("visits").alias("list")).groupBy("list").agg(F.count("*").alias("queries"))
    cuts = held.join(wanted, "list").select("list", F.ceil(F.col("vectors") / settings.vectors).cast("int").alias("nv"), F.ceil(F.col("queries") / settings.queries).cast("int").alias("nq"))
    cuts = written(cuts, "cuts")
    part = lambda n: F.pmod(F.col("h1"), F.col(n).cast("long")).cast("int")
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["list", "v", "q", "role", "h1", "h2", "least", "embedding"]
    candidates = placed.join(F.broadcast(cuts), "list").withColumn("v", part("nv")).withColumn("q", steps("nq")).withColumn("role", F.lit(0))
    queries = asking.withColumn("list", F.explode("visits")).join(F.broadcast(cuts), "list").withColumn("q", part("nq")).withColumn("v", steps("nv")).withColumn("role", F.lit(1))
    grouped = candidates.select(*columns).unionByName(queries.select(*columns)).repartition("list", "v", "q").sortWithinPartitions("list", "v", "q", "role")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = lists.value
        for group in sorted_groups(batches, ["list", "v", "q"]):
            n = int((group.column("role").to_numpy() == 0).sum())
            every_row = matrix_of(group.column("embedding").combine_chunks())
            x, q = every_row[:n], every_row[n:]
            if not len(x) or not len(q):
                continue
            a, b = scan(q, x, k + 1, index.rotation, settings)
            exact = (q[a] * x[b]).sum(1) / (np.linalg.norm(q, axis=1)[a] * np.linalg.norm(x, axis=1)[b])
            least = group.column("least").to_numpy()
            order = np.lexsort((least[b], -exact, a))
            a, b, exact = a[order], b[order], exact[order]
            rank = np.arange(len(a)) - np.searchsorted(a, np.arange(len(q)))[a]
            a, b, exact = (values[rank <= k] for values in (a, b, exact))
            h1, h2 = group.column("h1").to_numpy(), group.column("h2").to_numpy()
            yield pa.RecordBatch.from_pydict({"q1": pa.array(h1[n + a]), "q2": pa.array(h2[n + a]), "h1": pa.array(h1[b]), "h2": pa.array(h2[b]), "least": pa.array(least[b]), "score": pa.array(exact)})

    found = grouped.mapInArrow(score, f"q1 long, q2 long, h1 long, h2 long, least {kind}, score double")
    ask = ["q1", "q2"]
    top = Window.partitionBy(*ask).orderBy(F.desc("score"), "least")
    found = written(found.withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1).drop("place", "least"), "found")
    order = Window.partitionBy(*ask).orderBy(F.desc("score"), "vec_id")
    shown = found.join(members, key).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).select(*ask, "vec_id", "score")
    asks = asks.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("vec_id").alias("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = asks.join(written(shown, "shown"), ask).where("vec_id != query_id")
    return pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix_of(column) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)
