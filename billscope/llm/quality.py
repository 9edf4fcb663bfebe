"""Quality classifier: gradient-boosted trees on histograms of document statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import carried, labelled_sample, per_text, pieces, schema_of, sigmoid, split_words, texts_of

# Classes of bytes whose shares are statistics; every byte is in one class.
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "blank": " \t",
    "line_end": "\n\r",
    "stop": ".",
    "comma": ",;:",
    "shout": "!",
    "question": "?",
    "bar": "|",
    "symbol": "*#$%&@^~_+=<>\\/",
    "bracket": "()[]{}\"'`",
    "hyphen": "-",
}
SHARES = (*CLASSES, "other_ascii", "lead", "tail")
NAMES = (
    "log_bytes",
    *SHARES,
    "log_words",
    "mean_word",
    "long_words",
    "distinct_words",
    "distinct_pairs",
    "repeats",
    "top_word",
    "upper_words",
    "capital_words",
    "symbol_ends",
    "shout_ends",
    "plain_words",
    "log_lines",
    "mean_line",
    "distinct_lines",
    "stops_per_word",
)


def byte_classes() -> np.ndarray:
    out = np.full(256, len(CLASSES), dtype=np.int64)
    for number, characters in enumerate(CLASSES.values()):
        out[[ord(ch) for ch in characters]] = number
    out[0x80:0xC0] = len(CLASSES) + 2
    out[0xC0:] = len(CLASSES) + 1
    return out


def distinct_share(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the share of different values, and the share of the most frequent one (1 and 0 without values)."""
    total = np.bincount(owner, minlength=n)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    opens = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])])) if len(owner) else owner
    different = np.bincount(owner[opens], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, owner[opens], np.diff(np.append(opens, len(owner))))
    return np.where(total > 0, different / np.maximum(total, 1), 1.0), most / np.maximum(total, 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text, over the whole text. An empty text has zero counts and shares."""
    n, classes = len(texts), byte_classes()
    out = {}
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)
    counts = np.zeros((n, len(SHARES)))
    for row, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        counts[row] = np.bincount(classes[np.frombuffer(text, dtype=np.uint8)], minlength=len(SHARES))
    out["log_bytes"] = np.log1p(sizes)
    for number, name in enumerate(SHARES):
        out[name] = counts[:, number] / np.maximum(sizes, 1)
    distinct, codes, starts = split_words(texts)
    codes = codes.astype(np.int64)
    words = np.diff(starts)
    owner = np.repeat(np.arange(n), words)
    some = np.maximum(words, 1)

    def mean_of(per_word: np.ndarray) -> np.ndarray:
        return per_text(per_word.astype(np.float64)[codes], starts, np.add, 0.0) / some if len(codes) else np.zeros(n)

    length = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    flag = lambda values: pc.fill_null(values, False).to_numpy(zero_copy_only=False)
    out["log_words"] = np.log1p(words)
    out["mean_word"] = mean_of(length)
    out["long_words"] = mean_of(length > 15)
    same = np.concatenate([[False], (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])]) if len(codes) else np.zeros(0, bool)
    out["distinct_words"], out["top_word"] = distinct_share(owner, codes, n)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    out["distinct_pairs"], _ = distinct_share(owner[pair], codes[pair] << 32 | codes[pair + 1], n)
    out["repeats"] = np.bincount(owner, weights=same, minlength=n) / some
    out["upper_words"] = mean_of(flag(pc.utf8_is_upper(distinct)) & (length > 1))
    out["capital_words"] = mean_of(flag(pc.match_substring_regex(distinct, r"^\p{Lu}")))
    out["symbol_ends"] = mean_of(flag(pc.match_substring_regex(distinct, r"[*#$%&@^~|]$")))
    out["shout_ends"] = mean_of(flag(pc.match_substring_regex(distinct, r"!$")))
    out["plain_words"] = mean_of(flag(pc.match_substring_regex(distinct, r"^\pL+[.,]?$")))
    lines = pc.split_pattern(texts, "\n")
    line_counts = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    line_codes = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    out["log_lines"] = np.log1p(line_counts)
    out["mean_line"] = np.log1p(sizes / np.maximum(line_counts, 1))
    out["distinct_lines"], _ = distinct_share(np.repeat(np.arange(n), line_counts), line_codes, n)
    out["stops_per_word"] = counts[:, SHARES.index("stop")] / some
    return np.stack([out[name] for name in NAMES], axis=1).astype(np.float32)


@dataclass
class Trees:
    """Complete binary trees as flat arrays: node i's children are 2i + 1 and 2i + 2, leaves stand behind the nodes."""

    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # a value above it goes right
    leaf: np.ndarray  # trees x leaves
    start: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total, inner = np.full(len(rows), self.start), self.feature.shape[1]
        each = np.arange(len(rows))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(rows), dtype=np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (rows[each, feature[node]] > limit[node])
            total += leaf[node - inner]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(rows)) if len(rows) else np.zeros(0)


def boost(rows: np.ndarray, y: np.ndarray, n_trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosting with logistic loss. Values are put into quantile bins once; a level's splits come from one histogram."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(edge, column, side="left") for edge, column in zip(edges, rows.T)], axis=1)
    n, width = binned.shape
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((n_trees, inner), dtype=np.int64)
    limit = np.full((n_trees, inner), np.inf, dtype=np.float32)
    leaf = np.zeros((n_trees, leaves))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    columns = np.arange(width) * bins
    for tree in range(n_trees):
        p = sigmoid(margin)
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, here = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (width * bins) + columns[None, :] + binned).ravel()
            shape = here, width, bins
            g = np.bincount(cell, weights=np.repeat(gradient, width), minlength=here * width * bins).reshape(shape)
            h = np.bincount(cell, weights=np.repeat(weight, width), minlength=here * width * bins).reshape(shape)
            gl, hl = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            gt, ht = g.sum(axis=2)[:, :, None], h.sum(axis=2)[:, :, None]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            for k in range(here):
                column, cut = divmod(int(best[k]), bins - 1)
                if gain[k, column, cut] > 1e-6 and cut < len(edges[column]):
                    feature[tree, first + k] = column
                    limit[tree, first + k] = edges[column][cut]
            at, lim = feature[tree, node], limit[tree, node]
            node = 2 * node + 1 + (rows[np.arange(n), at] > lim)
        g = np.bincount(node - inner, weights=gradient, minlength=leaves)
        h = np.bincount(node - inner, weights=weight, minlength=leaves)
        leaf[tree] = -rate * g / (h + ridge)
        margin += leaf[tree][node - inner]
    return Trees(feature, limit, leaf, start)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 10_000) -> Trees | None:
    """Trees from documents and rows (doc_id, quality), or None without labelled documents.

    At most ``per_class`` documents of each label are used, chosen by a hash of the id; only their statistics reach the
    driver.
    """
    labels = labels.where("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = labelled_sample(docs, labels, "quality", per_class)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = statistics(texts_of(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "row": pa.array(list(found), pa.list_(pa.float32()))})

    kind = dict(rows.dtypes)["doc_id"]
    sample = rows.mapInArrow(run, f"doc_id {kind}, quality int, row array<float>")
    seen = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["row"]))
    if not seen:
        return None
    return boost(np.array([r["row"] for r in seen], dtype=np.float32), np.array([r["quality"] for r in seen], dtype=np.float64))


def score(docs: DataFrame, trees: Trees | None, threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of each row with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``threshold`` on).

    Only the text counts; a null text counts as empty and gets a score like any other. Without a model every score is
    0. Rows are independent: repeated rows come out repeated, an empty table gives an empty result, other columns are
    ignored. Nothing is shuffled.
    """
    columns = list(keep)
    if trees is None:
        return docs.select(*columns, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            value = shared.value.probability(statistics(texts_of(batch, text_col)))
            yield carried(batch, columns, score=pa.array(value, pa.float64()))

    rows = docs.select(*dict.fromkeys([*columns, text_col]))
    scored = rows.mapInArrow(run, schema_of(docs, columns, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
