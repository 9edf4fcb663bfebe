"""Toxicity: a support vector machine over a gapped subsequence string kernel with Nyström landmarks.

A text is a stream of letters; words, punctuation and blanks only mark where words begin. The kernel of two windows of the
stream sums, over all subsequences of three or four letters that span at most three letters more, the product of
``DECAY`` to the power of both spans. Inserted letters lengthen a span and lower the value, they do not remove it, and
blanks inside an insult or words joined to a run change nothing. A subsequence that begins with a word's second or third letter counts as
one of its own, so that ``closer`` is not ``loser``.

Landmarks are windows of labelled documents; a window's kernel values with them, whitened by the kernel among them, are
its features. The machine is linear in them, so a trained model folds into one weight per subsequence, a window's margin is a
sum over the subsequences that begin in it, and a text is judged by its best window, whatever the length of the text or its words.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import carried, give_back, labelled_sample, per_text, pieces, schema_of, sigmoid, texts_of, written
from billscope.llm.svm import fit_svm

LETTERS = 27  # a-z, and one that stands between texts and in no subsequence
PAD = 26
DECAY = 0.6
GAPS = 3  # letters that may lie between the letters of a subsequence
WINDOW = 12  # letters at which a window's subsequences may begin
REACH = 4 + GAPS - 1  # how far the last of them may end behind it
BETWEEN = WINDOW + REACH + 1
# (offset in the weight table, offsets of the letters, weight), one for each form of subsequence
FORMS = tuple(
    (base, (0, *rest), share * DECAY ** (rest[-1] + 1))
    for n, base, share in ((3, 0, 0.4), (4, LETTERS**3, 1.0))
    for rest in combinations(range(1, n + GAPS), n - 1)
)
TABLE = LETTERS**3 + LETTERS**4  # one table each for subsequences that begin at a word's start, just behind it, and further on
CHUNK = 1 << 17
PIECE = 1 << 19  # bytes of text whose streams a task holds at once
# Digits and signs written for letters, where a letter stands beside them.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@dataclass(frozen=True)
class Sizes:
    """Bounds of what the model is fitted on; the fitted model, never the scoring, depends on them."""

    documents: int = 4000  # labelled documents of each class
    picks: int = 6  # windows of a toxic document, and of a clean one
    cores: int = 300  # letter sequences that several toxic windows share
    hard: int = 1500  # windows of clean documents that a round finds most toxic
    plain: int = 2500  # random ones
    landmarks: int = 500
    rounds: int = 5


def letter_classes() -> np.ndarray:
    """Class of each code point: 0-25 a letter, -1 a break, -2 a mark on a letter, -3 a look-alike. Letters outside a-z share the
    classes by number."""
    out = np.full(0x110000, -1, dtype=np.int8)
    for point in range(0x80, 0x3000):
        kind = unicodedata.category(chr(point))
        out[point] = point % 26 if kind.startswith("L") else -2 if kind == "Mn" else -1
    out[0x3000:] = np.arange(0x3000, 0x110000) % 26
    out[ord("a") : ord("z") + 1] = range(26)
    for sign in LOOKALIKES:
        out[ord(sign)] = -3
    return out


class Letters:
    """The letter streams of texts in one array, ``BETWEEN`` pads behind each: codes, and for each letter how many of its word precede it
    (3 for more)."""

    table: np.ndarray | None = None
    alike: np.ndarray | None = None

    def __init__(self, texts: pa.Array):
        if Letters.table is None:
            Letters.alike = np.zeros(128, np.int8)
            for sign, letter in LOOKALIKES.items():
                Letters.alike[ord(sign)] = ord(letter) - ord("a")
            Letters.table = letter_classes()
        folded = pc.utf8_normalize(pc.utf8_lower(texts), form="NFKD")
        counts = pc.utf8_length(folded).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = folded.cast(pa.large_binary())
        joined = b"".join(raw.to_pylist()).decode()
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
        classes = Letters.table[points]
        plain = classes != -2
        classes, owner, points = classes[plain], owner[plain], points[plain]
        sign = np.flatnonzero(classes == -3)
        if len(sign):
            beside = np.zeros(len(sign), bool)
            for step in (-1, 1):
                at = np.clip(sign + step, 0, len(classes) - 1)
                beside |= (classes[at] >= 0) & (owner[at] == owner[sign])
            classes = classes.copy()
            classes[sign] = np.where(beside, Letters.alike[points[sign]], -1)
        kept = np.flatnonzero(classes >= 0)
        owner = owner[kept]
        first = np.concatenate([[True], (np.diff(kept) > 1) | (np.diff(owner) > 0)]) if len(kept) else np.zeros(0, bool)
        self.sizes = np.bincount(owner, minlength=len(texts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + BETWEEN)]).astype(np.int64)
        place = np.arange(len(kept)) + BETWEEN * owner.astype(np.int64)
        self.codes = np.full(int(self.starts[-1]) + REACH + 1, PAD, dtype=np.int32)
        self.codes[place] = classes[kept]
        since = np.arange(len(kept)) - np.maximum.accumulate(np.where(first, np.arange(len(kept)), 0)) if len(kept) else np.zeros(0, np.int64)
        self.since = np.zeros(len(self.codes), np.int8)
        self.since[place] = np.minimum(since, 3)
        self.total = int(self.starts[-1])

    def subsequences(self, low: int, high: int) -> Iterator[tuple[np.ndarray, float]]:
        """(table index of each position in low..high, weight) for each form; a pad inside gives an entry without weight."""
        codes = self.codes
        part = TABLE * np.array([0, 1, 1, 2], dtype=np.int32)[self.since[low:high]]
        # beginnings that several forms share are computed once; a closure over them would keep them alive in a cycle
        heads: dict[tuple[int, ...], np.ndarray] = {(0,): codes[low:high]}
        for base, offsets, weight in FORMS:
            for n in range(2, len(offsets) + 1):
                if offsets[:n] not in heads:
                    heads[offsets[:n]] = heads[offsets[: n - 1]] * LETTERS + codes[low + offsets[n - 1] : high + offsets[n - 1]]
            yield heads[offsets] + (part + base), weight

    def sums(self, table: np.ndarray) -> np.ndarray:
        """For each position the weighted sum of the table's entries over the subsequences that begin there."""
        out = np.zeros(self.total, np.float32)
        for low in range(0, self.total, CHUNK):
            high = min(low + CHUNK, self.total)
            for index, weight in self.subsequences(low, high):
                out[low:high] += np.float32(weight) * table[index]
        return out

    def windows(self, table: np.ndarray) -> np.ndarray:
        """For each position the sum over the window that begins there."""
        run = np.concatenate([[0.0], np.cumsum(self.sums(table), dtype=np.float64)])
        return run[np.minimum(np.arange(self.total) + WINDOW, self.total)] - run[:-1]

    def spelled(self, at: int, size: int) -> str:
        """The letters from a position on, a blank before each that begins a word."""
        part = zip(self.codes[at : at + size].tolist(), self.since[at : at + size].tolist())
        return "".join((" " if since == 0 and k else "") + chr(97 + c) for k, (c, since) in enumerate(part) if c != PAD)


def rows_of(words: list[str], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence weights of short strings whose subsequences begin in their first ``WINDOW`` letters: a row for each string and
    a column for each index in ``used`` (all that occur), scaled alike for all."""
    letters = Letters(pa.array(words, pa.large_string()))
    inside = np.concatenate([np.arange(a, a + WINDOW) for a in letters.starts[:-1]]) if words else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), WINDOW)
    found = [(index[inside], weight) for index, weight in letters.subsequences(0, letters.total)]
    real = [((letters.codes[inside] != PAD) & np.all([letters.codes[inside + o] != PAD for o in offsets], axis=0)) for _, offsets, _ in FORMS]
    if used is None:
        used = np.unique(np.concatenate([index[keep] for (index, _), keep in zip(found, real)])) if words else np.zeros(0, np.int64)
    out = np.zeros((len(words), len(used)), dtype=np.float32)
    if len(used):
        for (index, weight), keep in zip(found, real):
            column = np.minimum(np.searchsorted(used, index), len(used) - 1)
            known = keep & (used[column] == index)
            np.add.at(out, (owner[known], column[known]), np.float32(weight / SCALE))
    return out, used


SCALE = float(np.sqrt(sum(6 * weight**2 for *_, weight in FORMS)))  # about the norm of a word of six letters


@dataclass
class Model:
    """Weight of each subsequence, bias of the machine, and the calibration of document scores."""

    weights: np.ndarray
    bias: float
    scale: np.ndarray
    shift: float


def evidence(model: Model, texts: pa.Array) -> np.ndarray:
    """Per text: the margin of its best window, at most 1, and the logarithm of one plus the number of windows above zero."""
    letters = Letters(texts)
    margins = letters.windows(model.weights) + model.bias
    margins[letters.codes[: letters.total] == PAD] = model.bias  # a window from a pad may reach the next text
    best = per_text(margins, letters.starts, np.maximum, model.bias) if letters.total else np.full(len(texts), model.bias)
    above = per_text((margins > 0).astype(np.int64), letters.starts, np.add, 0) if letters.total else np.zeros(len(texts), np.int64)
    return np.stack([np.clip(best, -1.5, 1.0), np.log1p(above / WINDOW)], axis=1)


def gram_counts(sample: DataFrame) -> DataFrame:
    """Of each sequence of four letters: how many toxic and clean documents of the sample hold it."""
    base, offsets = LETTERS**3, (0, 1, 2, 3)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=PIECE):
            letters = Letters(texts_of(batch))
            index = np.zeros(letters.total, np.int64)
            for offset in offsets:
                index = index * LETTERS + letters.codes[offset : offset + letters.total]
            whole = np.all([letters.codes[o : o + letters.total] != PAD for o in offsets], axis=0)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(letters.starts))
            seen = np.unique(owner[whole] << 32 | index[whole])
            gram, toxic = seen & 0xFFFFFFFF, (batch.column("toxic").to_numpy(zero_copy_only=False) == 1)[seen >> 32]
            counts = [np.bincount(gram[m], minlength=LETTERS**4) for m in (toxic, ~toxic)]
            met = np.flatnonzero(counts[0] + counts[1])
            yield pa.RecordBatch.from_pydict({"gram": pa.array(met + base), "toxic": pa.array(counts[0][met], pa.int64()), "clean": pa.array(counts[1][met], pa.int64())})

    return sample.select("text", "toxic").mapInArrow(run, "gram long, toxic long, clean long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def surprising(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """Rows far more frequent in toxic documents than in clean ones, with ``surprise``, the log likelihood ratio.

    Both conditions hold for samples of any balance: four times the share of documents, and more than chance gives.
    """
    share = n_toxic / (n_toxic + n_clean)
    total = F.col("toxic") + F.col("clean")
    expected = total * share
    clean_part = F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (total * (1 - share)))).otherwise(0.0)
    ratio = F.when(F.col("toxic") > 0, 2 * (F.col("toxic") * F.log(F.col("toxic") / expected) + clean_part)).otherwise(0.0)
    return counts.withColumn("surprise", ratio).where((F.col("surprise") > 8) & (F.col("toxic") * n_clean > 4 * F.col("clean") * n_toxic))


def picked(sample: DataFrame, table: np.ndarray, picks: int) -> list:
    """(toxic, doc, best, text) of each document's best windows that do not overlap, and as many random ones, with 0 for ``best``, of a
    clean document."""
    shared = sample.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=PIECE):
            letters = Letters(texts_of(batch))
            margins = letters.windows(shared.value)
            out: dict[str, list] = {"toxic": [], "doc": [], "best": [], "text": []}
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), letters.starts.tolist(), letters.sizes.tolist())
            for doc, toxic, start, size in rows:
                if not size:
                    continue
                own = margins[start : start + size].copy()
                places = []
                for _ in range(picks):
                    at = int(own.argmax())
                    if own[at] <= 0:
                        break
                    places.append((at, float(own[at])))
                    own[max(at - WINDOW, 0) : at + WINDOW] = -np.inf
                if not toxic:
                    places += [(int(x), 0.0) for x in np.random.default_rng(doc % (1 << 32)).integers(size, size=picks)]
                for at, best in places:
                    while at and letters.since[start + at] and letters.since[start + at] < 3:
                        at -= 1
                    out["toxic"].append(toxic)
                    out["doc"].append(doc)
                    out["best"].append(best)
                    out["text"].append(letters.spelled(start + at, WINDOW + REACH))
            yield pa.RecordBatch.from_arrays([pa.array(out["toxic"], pa.int32()), pa.array(out["doc"], pa.int64()), pa.array(out["best"], pa.float64()), pa.array(out["text"], pa.string())], list(out))

    return sample.select(F.xxhash64("doc_id").alias("doc_id"), "toxic", "text").mapInArrow(run, "toxic int, doc long, best double, text string").collect()


def shared_cores(windows: list[tuple[int, str]], telling: set[int], limit: int) -> list[tuple[str, int]]:
    """Letter sequences that toxic windows of different documents and surroundings share, with the number of windows.

    Greedy: the sequence that explains most letters of the windows not yet explained comes next. All fours in a sequence are
    telling by themselves. Copies of a document have the same letters around, which count once.
    """
    base = LETTERS**3
    holders: dict[str, set[int]] = defaultdict(set)
    around: dict[str, set[tuple[str, str]]] = defaultdict(set)
    known = sorted(set(windows))
    for i, (_, window) in enumerate(known):
        text = window.replace(" ", "")
        good = [sum((ord(c) - 97) * LETTERS ** (3 - k) for k, c in enumerate(text[p : p + 4])) + base in telling for p in range(len(text) - 3)]
        for p in range(len(good)):
            for q in range(p, min(p + 10, len(good))):
                if not good[q]:
                    break
                part = text[p : q + 4]
                holders[part].add(i)
                around[part].add((text[max(p - 2, 0) : p], text[q + 4 : q + 6]))
    usable = {part for part in holders if len({known[i][0] for i in holders[part]}) > 1 and len(around[part]) > 1}
    cores, done = [], set()
    while len(cores) < limit and usable:
        best = max(usable, key=lambda part: (len(holders[part] - done) * (len(part) - 2.5), part))
        fresh = holders[best] - done
        if len({known[i][0] for i in fresh}) < 2 or cores and len(fresh) < cores[0][1] / 20:
            break
        usable.discard(best)
        done |= fresh
        if any(best in core for core, _ in cores):
            continue  # what is left of windows that an earlier one was cut from
        whole = grown(best, [known[i][1].replace(" ", "") for i in holders[best]])
        cores.append((whole, len(fresh)))
    return cores


def grown(core: str, windows: list[str], share: float = 0.7) -> str:
    """The core with the letters that nearly all its windows have beside it: what is around an insult varies."""
    for side in (0, 1):
        while len(core) < WINDOW:
            at = [(w, w.find(core)) for w in windows]
            beside = [w[p - 1 : p] if side == 0 else w[p + len(core) : p + len(core) + 1] for w, p in at if p >= 0]
            letter, n = Counter(filter(None, beside)).most_common(1)[0] if any(beside) else ("", 0)
            if n < 2 or n < share * sum(map(bool, beside)):
                break
            core = letter + core if side == 0 else core + letter
    return core


def taught(cores: list[tuple[str, int]], windows: list[tuple[int, str]], clean: list[str]) -> tuple[list[str], np.ndarray, list[str], list[str], list[str]]:
    """Labelled windows: toxic ones with their weights, clean ones, near misses, and the landmark candidates among the toxic.

    Sentences hold few of the disguises an insult may take, so every core is also shown disguised in clean surroundings: a letter
    put in or doubled, letters apart, cut in two, inside a run of letters. Clean are, besides clean sentences, words that differ from a
    core by one letter or continue a longer beginning.
    """
    rng = np.random.default_rng(7)
    letter = lambda: chr(97 + int(rng.integers(26)))
    words = sorted({w for text in clean[:4000] for w in text.split() if 2 <= len(w) <= 9}) or ["and"]
    word = lambda: words[int(rng.integers(len(words)))]

    def among(text: str, before: str = " ", after: str = " ") -> str:
        left = word()[: max(0, WINDOW - len(text))] if rng.random() < 0.7 else ""
        return f"{left}{before if left else ''}{text}{after}{word()} {word()}"

    by_core: dict[str, list[str]] = defaultdict(list)
    names = [core for core, _ in cores]
    for _, window in windows:
        plain = window.replace(" ", "")
        core = next((c for c in names if c in plain[: WINDOW + 2]), None)
        if core and window not in by_core[core]:
            by_core[core].append(window)
    toxic, weight, near, marks = [], [], [], []
    for core, n in cores:
        inner = range(1, len(core))
        forms = [(w, 2.0) for w in by_core[core][:20]] + [(among(core), 3.0) for _ in range(20)]
        forms += [(among(core[:p] + letter() + core[p:]), 0.7) for p in inner for _ in range(3)]
        forms += [(among(core[:p] + core[p - 1] + core[p:]), 0.7) for p in inner]
        forms += [(among(core[:p] + " " + core[p:]), 1.5) for p in inner]
        forms += [(among(" ".join(core)), 0.7), (among(core[:2] + " " + core[2:4] + " " + core[4:]), 0.7)]
        forms += [(f"{(word() + word() + 'ing')[: int(rng.integers(3, 7))]}{core}{word()} {word()}", 0.7) for _ in range(12)]
        toxic += [text for text, _ in forms]
        weight += [w * min(2.0, 0.75 + n**0.5 / 8) / len(forms) for _, w in forms]
        marks += [core, "qzqz" + core, " ".join(core), *[core[:p] + " " + core[p:] for p in inner], *[core[:p] + letter() + core[p:] for p in inner]]
        missed = [letter() + core for _ in range(8)] + [letter() + letter() + core for _ in range(4)]
        missed += [core[: len(core) // 2 + 1] + word(), core[: len(core) // 2 + 1], word()[:3] + core[(len(core) + 1) // 2 :], core[(len(core) - 1) // 2 :]]
        if len(core) < 7:  # of a longer one most is there, whatever the letter
            missed += [core[:p] + letter() + core[p + 1 :] for p in range(len(core)) for _ in range(3)] + [core[:-1], core[1:]]
        # a word's end and the next word are no insult, nor are a cut and a letter put in together
        missed += [word()[:4] + "a" + core[:p] + " " + core[p:] for p in inner for _ in range(2)]
        missed += [core[:p] + " " + core[p:q] + letter() + core[q:] for p in inner for q in inner if p != q][:: max(1, len(core) // 3)]
        near += [among(w) for w in missed if w != core]
        marks += [w for w in missed if w != core][::3]
    clean = clean + [" ".join([words[i]] * 10) for i in rng.integers(len(words), size=300)]  # repeated words add up
    held = [w for w in clean if not any(core in w.replace(" ", "") for core in names)]
    near = [w for w in near if not any(core in w.split() for core in names)]
    return toxic, np.array(weight), held, near, marks


def machine(toxic: list[str], weight: np.ndarray, clean: list[str], near: list[str], marks: list[str], n_landmarks: int) -> tuple[np.ndarray, float]:
    """Landmarks, whitened kernel features and the machine over windows, folded into subsequence weights, and its bias."""
    pool = list(dict.fromkeys(marks))
    clean = clean + near
    rows, used = rows_of(pool)
    kernel = (rows @ rows.T).astype(np.float64)
    chosen, rest, factor = [], np.diag(kernel).copy(), np.zeros((len(pool), 0))
    for _ in range(min(n_landmarks, len(pool))):
        pick = int(np.argmax(rest))
        if rest[pick] < 1e-4:
            break
        column = (kernel[:, pick] - factor @ factor[pick]) / np.sqrt(rest[pick])
        factor = np.hstack([factor, column[:, None]])
        rest = np.maximum(rest - column**2, 0)
        rest[pick] = 0
        chosen.append(pick)
    values, vectors = np.linalg.eigh(kernel[np.ix_(chosen, chosen)])
    kept = values > 1e-5
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    columns = rows[chosen].T
    words = toxic + clean
    features = np.concatenate([rows_of(words[i : i + 200], used)[0] @ columns for i in range(0, len(words), 200)]) @ whiten
    target = np.where(np.arange(len(words)) < len(toxic), 1.0, -1.0)
    each = np.concatenate([weight / weight.mean(), np.full(len(clean), 3 * len(toxic) / len(clean))])
    w, bias = fit_svm(features, target, each, c=100.0)
    weights = np.zeros(3 * TABLE, dtype=np.float32)
    weights[used] = columns @ (whiten @ w) / SCALE
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, sizes: Sizes = Sizes()) -> Model | None:
    """A model from documents and rows (doc_id, toxic), or None where one class has no documents or no toxic windows agree.

    A document's label says that some window of its sentences is toxic, or that none is. The first guess which ones are is the sum of what
    sequences of four letters tell; then the machine of one round picks the windows of the next: the best of each toxic document, and as
    counterexamples the best of each clean one. Everything read by the driver is bounded by ``sizes`` and the alphabet.
    """
    labels = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = written(labelled_sample(docs, labels, "toxic", sizes.documents), "sample")
    n = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return None
    found = surprising(gram_counts(sample), n[1], n[0]).select("gram", "surprise").collect()
    first = np.zeros(3 * TABLE, dtype=np.float32)
    for row in found:
        first[row["gram"]] = first[TABLE + row["gram"]] = first[2 * TABLE + row["gram"]] = row["surprise"]
    telling, table, bias = {row["gram"] for row in found}, first, 0.0
    hard: dict[str, float] = {}
    for _ in range(sizes.rounds):
        rows = sorted(picked(sample, table, sizes.picks))  # the model depends on the documents only, not on their order
        windows = [(r["doc"], r["text"]) for r in rows if r["toxic"]]
        # the windows that some round took for toxic stay; the worst of the latest come first
        fresh = sorted(((-r["best"], r["text"]) for r in rows if not r["toxic"] and r["best"]))
        hard = {**dict.fromkeys([text for _, text in fresh[: sizes.hard]]), **hard}
        plain = list(dict.fromkeys(r["text"] for r in rows if not r["toxic"] and not r["best"]))
        cores = shared_cores(windows, telling, sizes.cores)
        if not cores:
            return None
        toxic, weight, clean, near, marks = taught(cores, windows, [*hard, *plain[: sizes.plain]])
        table, bias = machine(toxic, weight, clean, near, marks, sizes.landmarks)
        give_back()
    model = Model(table, bias, np.array([1.0, 0.0]), 0.0)
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=PIECE):
            seen = evidence(shared.value, texts_of(batch))
            yield pa.RecordBatch.from_pydict({"best": pa.array(seen[:, 0]), "above": pa.array(seen[:, 1]), "toxic": batch.column("toxic")})

    rows = np.array([tuple(row) for row in sample.select("text", "toxic").mapInArrow(run, "best double, above double, toxic int").collect()])
    model.scale, model.shift = calibrated(rows[:, 0], rows[:, 2])
    give_back()
    return model


def calibrated(best: np.ndarray, toxic: np.ndarray, threshold: float = 0.7, cost: float = 3.0) -> tuple[np.ndarray, float]:
    """Scale and shift that put the ``threshold`` score at the margin that parts the sample best.

    One window decides, so one insult counts as much as many. A clean document taken for toxic costs as much as ``cost`` toxic
    ones missed; labels hold toxic documents without a toxic window, so a plain fit would put every score low. Of margins that
    part the sample about equally well a low one is taken, for forms that the sample does not hold.
    """
    grid = np.linspace(0.2, 0.95, 31)
    gain = np.array([(toxic[best >= m] == 1).sum() - cost * (toxic[best >= m] == 0).sum() for m in grid])
    good = grid[gain >= gain.max() - 0.01 * (toxic == 1).sum()]
    at = good.min() + 0.1 * (good.max() - good.min())
    return np.array([4.0, 0.0]), float(np.log(threshold / (1 - threshold)) - 4.0 * at)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of each row with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Only the text counts. A null or empty text has no letters and gets the score of a document without any toxic window.
    Without a model (no labelled documents of both classes) every score is 0. Rows are independent: repeated rows come out
    repeated, an empty table gives an empty result, other columns are ignored. Nothing is shuffled.
    """
    columns = list(keep)
    if model is None:
        return docs.select(*columns, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, text_col, PIECE):
            value = sigmoid(evidence(model, texts_of(batch, text_col)) @ model.scale + model.shift)
            yield carried(batch, columns, score=pa.array(value, pa.float64()))

    rows = docs.select(*dict.fromkeys([*columns, text_col]))
    scored = rows.mapInArrow(run, schema_of(docs, columns, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
