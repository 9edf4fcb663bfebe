"""Language identification in two steps: the family first, then one-versus-one machines within it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import carried, give_back, labelled_sample, pieces, schema_of, sigmoid, texts_of
from billscope.llm.svm import fit_logistic, fit_svm

# Families of ISO 639-1 codes. A code outside the table is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
WIDTH = 4096  # hashed counts of one to four bytes


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def letter_bytes() -> np.ndarray:
    """What stands for each byte: ASCII letters lowered, bytes of other characters as they are, all else a blank."""
    out = np.full(256, ord(" "), dtype=np.uint8)
    out[0x80:] = range(0x80, 256)
    out[ord("a") : ord("z") + 1] = range(ord("a"), ord("z") + 1)
    out[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    return out


def features(texts: pa.Array) -> np.ndarray:
    """A row per text: roots of the hashed counts of one to four bytes of the whole text, scaled to length one."""
    out, classes = np.zeros((len(texts), WIDTH), dtype=np.float32), letter_bytes()
    for row, text in enumerate(pc.utf8_lower(texts).cast(pa.large_binary()).to_pylist()):
        data = classes[np.frombuffer(text, dtype=np.uint8)].astype(np.uint32)
        counts = np.zeros(WIDTH, dtype=np.int64)
        code = np.zeros(len(data), dtype=np.uint32)
        for n in range(1, 5):
            if len(data) < n:
                break
            code = code[: len(data) - n + 1] * np.uint32(257) + data[n - 1 :] + np.uint32(1)
            mixed = code * np.uint32(2654435761)
            counts += np.bincount(mixed >> np.uint32(20), minlength=WIDTH)
        out[row] = np.sqrt(counts)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass
class Machine:
    """A linear machine between two groups with the calibration of its margin."""

    first: str
    second: str
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Chance that a row belongs to ``first``."""
        return sigmoid((rows @ self.weights + self.bias) * self.slope + self.shift)


def machine(first: str, second: str, rows: np.ndarray, is_first: np.ndarray) -> Machine:
    each = np.where(is_first, 0.5 / max(is_first.sum(), 1), 0.5 / max((~is_first).sum(), 1)) * len(rows)
    w, bias = fit_svm(rows, np.where(is_first, 1.0, -1.0), each, c=10.0)
    margin = np.concatenate([rows[i : i + 256] @ w for i in range(0, len(rows), 256)])[:, None] + bias  # no copy in double precision
    slope, shift = fit_logistic(margin, is_first.astype(float))
    return Machine(first, second, w.astype(np.float32), bias, float(slope[0]), shift)


@dataclass
class Model:
    families: dict[str, list[str]]
    between: list[Machine]  # families, one versus one
    within: dict[str, list[Machine]]

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score: the family's share of its votes times the language's share of its own."""
        names = sorted(self.families)
        family, sure = votes(names, self.between, rows)
        langs, scores = np.empty(len(rows), dtype=object), np.zeros(len(rows))
        for i, name in enumerate(names):
            at = np.flatnonzero(family == i)
            if not len(at):
                continue
            members = self.families[name]
            best, share = votes(members, self.within[name], rows[at])
            langs[at] = np.array(members, dtype=object)[best]
            scores[at] = sure[at] * share
        return langs, scores


def votes(names: list[str], machines: list[Machine], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the winner of most duels, ties by the sum of chances then the first name, and its mean chance."""
    if len(names) == 1:
        return np.zeros(len(rows), dtype=int), np.ones(len(rows))
    wins, chance = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
    for duel in machines:
        a, b = names.index(duel.first), names.index(duel.second)
        p = duel.probability(rows)
        wins[:, a] += p >= 0.5
        wins[:, b] += p < 0.5
        chance[:, a] += p
        chance[:, b] += 1 - p
    mean = chance / (len(names) - 1)
    best = np.argmax(wins + mean / 2, axis=1)
    return best, mean[np.arange(len(rows)), best]


def fit(docs: DataFrame, per_language: int = 600, most_languages: int = 100, documents: int = 20_000) -> Model | None:
    """A model from documents (doc_id, text, lang) whose language is known, or None without any.

    At most ``per_language`` documents of each language and ``documents`` in all are used, chosen by a hash of the id; only
    their features reach the driver. Languages come from the data, families from the table above; of more than ``most_languages`` values of
    ``lang`` the most frequent are learned, so stray values neither fill the driver nor multiply the duels.
    """
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    sample = labelled_sample(lettered, lettered, "lang", per_language, most_languages, documents)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = features(texts_of(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "features": pa.array([row.astype(np.float16).tobytes() for row in found], pa.binary())})

    kind = dict(sample.dtypes)["doc_id"]
    seen = sorted(sample.mapInArrow(run, f"doc_id {kind}, lang string, features binary").collect())
    if not seen:
        return None
    langs = np.array([row["lang"] for row in seen], dtype=object)
    matrix = np.empty((len(seen), WIDTH), dtype=np.float32)
    for i, row in enumerate(seen):
        matrix[i] = np.frombuffer(row["features"], dtype=np.float16)
    del seen, row
    families: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        families.setdefault(family_of(lang), []).append(lang)
    own = np.array([family_of(lang) for lang in langs], dtype=object)
    model = Model(families, duels(sorted(families), own, matrix), {name: duels(members, langs, matrix) for name, members in families.items()})
    del matrix
    give_back()
    return model


def duels(names: list[str], groups: np.ndarray, matrix: np.ndarray) -> list[Machine]:
    out = []
    for a, b in combinations(names, 2):
        at = (groups == a) | (groups == b)
        out.append(machine(a, b, matrix if at.all() else matrix[at], groups[at] == a))
    return out


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The ``keep`` columns of each row with ``lang_pred`` (a learned language) and ``score`` (0 to 1).

    A text that is null, empty or without a letter is ``und`` with score 1; so is every text, with score 0, where no
    language could be learned. Whole texts count, whatever their length. Rows are independent: repeated rows come out
    repeated, an empty table gives an empty result, other columns are ignored. Nothing is shuffled.
    """
    columns = list(keep)
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.when(letter, 0.0).otherwise(1.0).alias("score"))
    rows = docs.select(*[F.col(name) for name in dict.fromkeys([*columns, text_col])], letter.alias("_letter"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                langs, scores = shared.value.predict(features(texts_of(part, text_col)))
                letter = part.column("_letter").to_numpy(zero_copy_only=False)
                found = pa.array(np.where(letter, langs, UNKNOWN), pa.string())
                yield carried(part, columns, lang_pred=found, score=pa.array(np.where(letter, scores, 1.0), pa.float64()))

    return rows.mapInArrow(run, schema_of(docs, columns, "lang_pred string, score double"))
