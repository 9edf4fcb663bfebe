"""Helpers the operators of this subpackage share: inputs, label folds, Arrow batches of bounded size, words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.session import cut

# A batch is handled in pieces of about this many bytes of text; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the folder all executors share: computed once, readable after the loss of any executor.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset (tests) the caller sets it first. Inside
    ``with RunTables(spark): …`` the table belongs to that run and goes with it; results are written elsewhere in the block.
    """
    return cut(df, name)


def fold(doc_id: str | object, parts: int):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def held_out(doc_id: str, parts: int, part: int):
    """True for the fold that learning never sees; a null id is not held out."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, per_value: int, most_values: int = 100, most_rows: int | None = None) -> DataFrame:
    """``doc_id, key, text`` of at most ``per_value`` documents for each value of ``key``, chosen by a hash of the id.

    ``labels`` has (doc_id, key) rows; null ids and values are left out, repeated ones count once, and of documents with one
    id the smallest text stands for all. Of more than ``most_values`` values the most frequent are learned from (ties: the
    smaller), so a column full of stray values bounds what is fitted, and no more than about ``most_rows`` in all, shared
    equally. Only labels are shuffled, thinned beforehand to about
    the wanted number; the chosen ids, at most ``per_value * most_values``, go to the documents as a broadcast, so texts
    stay where they are.
    """
    from pyspark.sql import Window

    known = labels.select("doc_id", key).where(F.col("doc_id").isNotNull() & F.col(key).isNotNull()).distinct()
    counts = {row[key]: row["count"] for row in known.groupBy(key).count().orderBy(F.desc("count"), key).limit(most_values).collect()}
    if not counts:
        return docs.sparkSession.createDataFrame([], known.schema.add("text", "string"))
    if most_rows is not None:
        per_value = min(per_value, max(1, most_rows // len(counts)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    bound = F.element_at(F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, int((1 << 30) * min(1.0, 1.2 * per_value / n + 20 / n)))]), F.col(key))
    order = Window.partitionBy(key).orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.where(draw <= bound).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_value).drop("_rank")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", key).agg(F.min("text").alias("text"))


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``size`` bytes (``PIECE_BYTES``) of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        filled = np.cumsum(sizes) // (size or PIECE_BYTES)
        cuts = [0, *(np.flatnonzero(np.diff(filled)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


def schema_of(docs: DataFrame, columns: list[str], more: str) -> str:
    """DDL of the given columns followed by ``more``."""
    kinds = dict(docs.dtypes)
    return ", ".join([f"`{name}` {kinds[name]}" for name in columns] + [more] * bool(more))


def carried(batch: pa.RecordBatch, columns: list[str], **more: pa.Array) -> pa.RecordBatch:
    """The batch's columns followed by new ones."""
    return pa.RecordBatch.from_arrays([batch.column(name) for name in columns] + list(more.values()), [*columns, *more])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large strings, null as empty.

    Taken row by row into buffers of its own: text kernels misread a piece whose first offset is not zero.
    """
    texts = batch.column(column).take(pa.array(np.arange(batch.num_rows)))
    return pc.fill_null(texts.cast(pa.large_string()), "")


def split_words(texts: pa.Array, ascii_only: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between white space: the distinct words, each word's index into them, and where each text's words start.

    The third array has one entry more than there are texts.
    """
    lists = (pc.ascii_split_whitespace if ascii_only else pc.utf8_split_whitespace)(texts)
    flat = lists.flatten()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    kept = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not kept.all():
        starts = np.concatenate([[0], np.cumsum(kept)])[starts].astype(np.int64)
        flat = flat.filter(pa.array(kept))
    encoded = flat.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), starts


def give_back() -> None:
    """Hand the pages of freed objects back to the machine where the C library can, so that what comes next has them."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def word_table(forget: Callable[[], None]) -> Iterator[None]:
    """A task that keeps a table of words: no full collector passes over it (it holds no cycles; they cost a third of the
    time), and nothing of it left in a worker that goes on to other tasks.
    """
    gc.disable()
    try:
        yield
    finally:
        forget()
        gc.enable()
        give_back()


def per_text(values: np.ndarray, starts: np.ndarray, ufunc, empty):
    """``ufunc`` reduced over each text's values; ``empty`` where a text has none."""
    out = np.full(len(starts) - 1, empty, dtype=values.dtype)
    some = starts[1:] > starts[:-1]
    if some.any():
        out[some] = ufunc.reduceat(values, starts[:-1][some])
    return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
