"""Benchmark decontamination by greedy string tiling, as joins of shared windows.

1. Every window of ``least`` words of every item is a row; an item of fewer words is one window.
2. Texts emit their windows that items have too. A bit table of fixed size, built by an aggregate over the items' windows,
   keeps all others from being shuffled; what it lets through by chance finds no partner in the join.
3. An item is looked up by its rarest windows only: the commonest ones are left out as long as they alone cover less of
   the item than the threshold, so a text that shares none of the others cannot cover it.
4. A text meets its candidate items in one pass over one copy of it; each pair is tiled exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import pieces, split_words, texts_of, written

BASE = np.uint64(0x9E3779B97F4A7C15)
# The bit table of windows: 2**27 bits, 16 MB, whatever the number of items.
TABLE_BITS = 27
BITMAP_BITS = 15  # bits in one bitmap of Spark's bitmap aggregates
# A text with more candidate items than this is handed to several tasks.
ITEMS_PER_TEXT = 4096
DIGEST = "__text_digest"


def bare(words: pa.Array) -> pa.Array:
    """Words lowered, without what is no letter, digit or mark at their ends."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"^[^\pL\pN\pM]+|[^\pL\pN\pM]+$", "")


class Rolling:
    """Karp-Rabin hashes (modulo 2**64) of the windows of any length of one sequence, from one array of prefix hashes."""

    def __init__(self, symbols: np.ndarray):
        size = len(symbols) + 1
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        powers = np.multiply.accumulate(np.full(size, BASE, dtype=np.uint64))
        self.inverses = np.multiply.accumulate(np.full(size, inverse, dtype=np.uint64))
        self.prefix = np.concatenate([[np.uint64(0)], np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)])

    def windows(self, length: int) -> np.ndarray:
        if len(self.prefix) <= length:
            return np.zeros(0, dtype=np.uint64)
        return (self.prefix[length:] - self.prefix[:-length]) * self.inverses[: len(self.prefix) - length]


def covered_by(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in windows of ``length`` that begin at ``starts``."""
    edges = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges)[:-1] > 0


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (start in item, start in doc, length) of the longest non-overlapping matches, longest first.

    Ties go to the first place in the item, then in the document. Negative numbers match nothing. In each round the
    greatest length that unmarked words share is searched by halving, and its matches are marked from left to right:
    places of a hash are kept in one list, so repeated words cost their number, not the pairs they make.
    """
    sides = Rolling(item), Rolling(doc)
    free = item >= 0, doc >= 0

    def open_windows(side: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        sums = np.concatenate([[0], np.cumsum(free[side])])
        places = np.flatnonzero(sums[length:] - sums[:-length] == length) if len(sums) > length else np.zeros(0, np.int64)
        return places, sides[side].windows(length)[places]

    def shared(length: int) -> bool:
        return bool(np.isin(open_windows(0, length)[1], open_windows(1, length)[1]).any())

    found, top = [], min(len(item), len(doc))
    while top >= least and shared(least):
        low, high = least, top
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        ours, hashes = open_windows(0, low)
        theirs, their_hashes = open_windows(1, low)
        order = np.argsort(their_hashes, kind="stable")
        their_hashes, theirs = their_hashes[order], theirs[order]
        first = np.searchsorted(their_hashes, hashes).tolist()
        last = np.searchsorted(their_hashes, hashes, side="right").tolist()
        passed: dict[int, int] = {}  # by hash: places before this one are marked
        for a, at, end in zip(ours.tolist(), first, last):
            if at == end or not free[0][a : a + low].all():
                continue
            place = passed.get(at, at)
            while place < end and not free[1][theirs[place] : theirs[place] + low].all():
                place += 1
            passed[at] = place
            while place < end:
                b = int(theirs[place])
                if free[1][b : b + low].all() and (item[a : a + low] == doc[b : b + low]).all():
                    free[0][a : a + low] = free[1][b : b + low] = False
                    found.append((a, b, low))
                    break
                place += 1
        top = low - 1
    return found


class Text:
    """The words of one text as numbers, and the hashes of its windows."""

    def __init__(self, words: pa.Array):
        encoded = words.dictionary_encode()
        self.ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.number = {word: n for n, word in enumerate(encoded.dictionary.to_pylist())}
        self.rolling = Rolling(self.ids)
        self.hashes: dict[int, np.ndarray] = {}

    def tiled(self, words: list[str], least: int, threshold: float) -> tuple[float, int] | None:
        """(covered share, tiles) of an item that the text covers to ``threshold``."""
        length = min(least, len(words))
        item = np.array([self.number.get(word, -1) for word in words], dtype=np.int64)
        if length not in self.hashes:
            self.hashes[length] = self.rolling.windows(length)
        known = covered_by(np.flatnonzero(item < 0), 1, len(item))
        whole = np.convolve(known, np.ones(length, dtype=np.int64), "valid") == 0
        hashes = Rolling(item).windows(length)
        starts = np.flatnonzero(whole & np.isin(hashes, self.hashes[length]))
        if covered_by(starts, length, len(item)).sum() < threshold * len(item):  # tiles lie inside shared windows
            return None
        places = np.flatnonzero(np.isin(self.hashes[length], hashes[starts]))
        inside = np.flatnonzero(covered_by(places, length, len(self.ids)))
        gaps = np.flatnonzero(np.diff(inside) > 1) + 1  # a word that matches nothing stands for what is left out
        found = tiles(item, np.insert(self.ids[inside], gaps, -1), length)
        share = sum(size for *_, size in found) / len(item)
        return (share, len(found)) if found and share >= threshold else None


def word_lists(batch: pa.RecordBatch) -> list[pa.Array]:
    """The words of each of a batch's texts, bare; what was punctuation only is no word."""
    distinct, codes, starts = split_words(texts_of(batch))
    plain = bare(distinct)
    real = pc.greater(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, dtype=bool)
    starts, codes = np.concatenate([[0], np.cumsum(real)])[starts].tolist(), codes[real]
    return [plain.take(pa.array(codes[lo:hi])) for lo, hi in zip(starts, starts[1:])]


def symbols_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The words of a batch's texts as 64-bit hashes, and the row of each word."""
    distinct, codes, starts = split_words(texts_of(batch))
    plain = bare(distinct).to_pylist()
    symbols = np.array([xxhash.xxh64_intdigest(word) for word in plain] or [0], dtype=np.uint64)[codes]
    real = np.array([word != "" for word in plain] or [False])[codes]
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return symbols[real], rows[real]


def windows_in(symbols: np.ndarray, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of all windows within a row; windows of other lengths have other hashes."""
    hashes = Rolling(symbols).windows(length)
    places = np.flatnonzero(rows[: len(hashes)] == rows[length - 1 :][: len(hashes)])
    return places, hashes[places] * np.uint64(2 * length + 1)


def item_windows(least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(_item, _window, at, length, words)`` of each item's windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            symbols, rows = symbols_of(batch)
            sizes = np.bincount(rows, minlength=batch.num_rows)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for length in range(1, least + 1):
                places, hashes = windows_in(symbols, rows, length)
                of = rows[places]
                chosen = (sizes[of] >= least) if length == least else (sizes[of] == length)
                places, hashes, of = places[chosen], hashes[chosen], of[chosen]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_item": batch.column("_item").take(pa.array(of)),
                        "_window": pa.array(hashes.view(np.int64)),
                        "at": pa.array((places - starts[of]).astype(np.int32)),
                        "length": pa.array(np.full(len(of), length, dtype=np.int32)),
                        "words": pa.array(sizes[of].astype(np.int32)),
                    }
                )

    return run


def text_windows(lengths: list[int], shared) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(__text_digest, _window)`` of each text's distinct windows whose bit is set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in pieces(batches):
            symbols, rows = symbols_of(batch)
            for length in lengths:
                places, hashes = windows_in(symbols, rows, length)
                bit = hashes >> np.uint64(64 - TABLE_BITS)
                kept = (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                of, hashes = rows[places[kept]], hashes[kept]
                order = np.lexsort((hashes, of))
                of, hashes = of[order], hashes[order]
                new = np.concatenate([[True], (np.diff(of) != 0) | (hashes[1:] != hashes[:-1])])[: len(of)]
                yield pa.RecordBatch.from_pydict(
                    {DIGEST: batch.column(DIGEST).take(pa.array(of[new])), "_window": pa.array(hashes[new].view(np.int64))}
                )

    return run


def bit_table(windows: DataFrame) -> np.ndarray:
    """The highest ``TABLE_BITS`` bits of each window as a table of bits, gathered from bitmaps that Spark aggregates."""
    place = F.shiftrightunsigned("_window", 64 - TABLE_BITS)
    maps = windows.groupBy(F.shiftright(place, BITMAP_BITS).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND((1 << BITMAP_BITS) - 1)).alias("bits"))
    table = np.zeros(1 << (TABLE_BITS - 3), dtype=np.uint8)
    size = 1 << (BITMAP_BITS - 3)
    for row in maps.collect():  # at most 2 ** (TABLE_BITS - BITMAP_BITS) rows
        table[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return table


def rare_windows(threshold: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(_window, _item)``: the windows that an item is looked up by, from its windows and their numbers of texts.

    Windows that no text has are not in the input: an item whose other windows cover less than the threshold has none.
    """

    def keys(windows: list[dict], length: int, words: int) -> list[int]:
        places: dict[int, list[int]] = {}
        texts: dict[int, int] = {}
        for window in windows:
            places.setdefault(window["_window"], []).append(window["at"])
            texts[window["_window"]] = window["texts"]
        order = sorted(places, key=lambda w: (-texts[w], w))
        covered, count = np.zeros(words, dtype=bool), 0
        for n, window in enumerate(order):
            for at in places[window]:
                count += int((~covered[at : at + length]).sum())
                covered[at : at + length] = True
            if count >= threshold * words:
                return order[n:]
        return []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(row["_item"], key) for row in batch.to_pylist() for key in keys(row["windows"], row["length"], row["words"])]
            yield pa.RecordBatch.from_pydict({"_window": pa.array([key for _, key in found], pa.int64()), "_item": pa.array([item for item, _ in found], pa.binary())})

    return run


def tiled_pairs(least: int, threshold: float) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(__text_digest, _item, coverage, tiles)`` from rows sorted so that a text is followed by its candidate items."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in pieces(batches):
            found = []
            for digest, item, words in zip(batch.column(DIGEST), batch.column("_item"), word_lists(batch)):
                if not item.is_valid:
                    held = Text(words)
                elif (match := held.tiled(words.to_pylist(), least, threshold)) is not None:
                    found.append((digest.as_py(), item.as_py(), *match))
            yield pa.RecordBatch.from_pydict(
                {
                    DIGEST: pa.array([row[0] for row in found], pa.binary()),
                    "_item": pa.array([row[1] for row in found], pa.binary()),
                    "coverage": pa.array([row[2] for row in found], pa.float64()),
                    "tiles": pa.array([row[3] for row in found], pa.int32()),
                }
            )

    return run


def digest(text: str = "text"):
    return F.unhex(F.md5(F.col(text).cast("binary")))


def covering_texts(docs: DataFrame, benchmark: DataFrame, least: int, threshold: float) -> DataFrame | None:
    """``(__text_digest, _item, coverage, tiles)`` of distinct texts and the distinct items they cover; None without items."""
    items = written(benchmark.where("text is not null").select(digest().alias("_item"), "text").dropDuplicates(["_item"]), "items")
    windows = written(items.mapInArrow(item_windows(least), "_item binary, _window long, at int, length int, words int"), "item_windows")
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())  # at most ``least`` rows
    if not lengths:
        return None
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(windows))
    texts = docs.where("text is not null").select(digest().alias(DIGEST), "text")
    seen = written(texts.mapInArrow(text_windows(lengths, bits), f"{DIGEST} binary, _window long").distinct(), "text_windows")
    counted = windows.join(seen.groupBy("_window").agg(F.count("*").alias("texts")), "_window")
    gathered = counted.groupBy("_item", "length", "words").agg(F.collect_list(F.struct("_window", "at", "texts")).alias("windows"))
    keys = written(gathered.mapInArrow(rare_windows(threshold), "_window long, _item binary"), "keys")
    pairs = written(seen.join(keys, "_window").select(DIGEST, "_item").distinct(), "pairs")
    parts = F.ceil(F.count("*") / ITEMS_PER_TEXT).cast("int")
    wanted = written(pairs.groupBy(DIGEST).agg(parts.alias("parts")), "wanted")
    copies = texts.join(wanted, DIGEST).groupBy(DIGEST, "parts").agg(F.first("text").alias("text"))
    copies = copies.select(DIGEST, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_part"), F.lit(None).cast("binary").alias("_item"), "text")
    partners = pairs.join(wanted, DIGEST).join(items, "_item")
    partners = partners.select(DIGEST, F.pmod(F.xxhash64("_item"), F.col("parts")).cast("int").alias("_part"), "_item", "text")
    rows = copies.unionByName(partners).repartition(DIGEST, "_part").sortWithinPartitions(DIGEST, "_part", F.col("_item").asc_nulls_first())
    return written(rows.mapInArrow(tiled_pairs(least, threshold), f"{DIGEST} binary, _item binary, coverage double, tiles int"), "covering")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.8, id_col: str = "doc_id") -> DataFrame:
    """``(id, item_id, coverage, tiles)`` of every document that covers an item to ``threshold`` or more.

    Coverage is the share of the item's words in non-overlapping matches of at least ``least`` words, in any order, so
    reordered passages count. Words stand between white space, lowered and without punctuation at their ends. An item
    of fewer words must appear whole; an item without words (null, empty) matches nothing, as does a null or empty text.
    Repeated documents come out repeatedly, repeated items under each of their ids, null ids among them; ids are of any
    type; empty tables give an empty result; columns other than the id and the text play no part.

    Equal texts are one from the start. Of the documents only windows that items may have are shuffled, and the texts of
    candidates. The workers need this package: ``queries.prepared`` sends it.
    """
    found = covering_texts(docs, benchmark, least, threshold)
    kinds = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)["item_id"]
    if found is None:
        return docs.sparkSession.createDataFrame([], f"`{id_col}` {kinds[0]}, item_id {kinds[1]}, coverage double, tiles int")
    rows = docs.select(F.col(id_col).alias("_id"), digest().alias(DIGEST)).join(found, DIGEST)
    named = rows.join(benchmark.select("item_id", digest().alias("_item")), "_item")
    return named.select(F.col("_id").alias(id_col), "item_id", "coverage", "tiles")


def free_of(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that cover no item, as ``contaminated`` defines it.

    Rows with a null or empty text stay, repeated rows stay or go together, and without items or documents all stay.
    """
    found = covering_texts(docs, benchmark, least, threshold)
    if found is None:
        return docs
    names = docs.columns
    return docs.withColumn(DIGEST, digest()).join(found.select(DIGEST).distinct(), DIGEST, "left_anti").select(*names)
