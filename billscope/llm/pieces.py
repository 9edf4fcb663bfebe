"""Token counts of a sentence-piece BPE vocabulary by merging many pre-tokens at once in numpy arrays.

Pre-tokens lie one behind the other in one flat array of symbols. In every round each pre-token merges the pair that has
its lowest rank, all pre-tokens together; a pre-token without a mergeable pair leaves the array. Equal to merging
one pair at a time from the left: see ``VocabularyCounts.plain``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import per_text, pieces, texts_of, word_table

MARK = "▁"  # what the vocabulary writes for a blank
NONE = np.int64(1) << 40  # rank of a pair that is no piece
# Counts of pre-tokens a task keeps between batches; bounds memory, not the result.
KNOWN_WORDS = 150_000
KNOWN_CHARS = 64
LONG = 128  # symbols from which a pre-token that needs single merges is finished with a heap


class VocabularyCounts:
    """Counts for one model file (BPE with byte fallback, identity normalizer, a blank put before the text)."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        texts = [model.id_to_piece(i) for i in numbers]
        scores = np.array([model.get_score(i) for i in numbers])
        _, rank = np.unique(-scores, return_inverse=True)
        self.piece = {text: i for i, text in enumerate(texts)}
        self.rank = rank.astype(np.int64)
        shared_rank = np.bincount(rank)[rank] > 1
        # every way to make a piece from two pieces; symbols are piece numbers, unknown characters come after them
        left, right, made = [], [], []
        for text, i in self.piece.items():
            for cut in range(1, len(text)):
                a, b = self.piece.get(text[:cut]), self.piece.get(text[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        left, right, made = (np.array(x, dtype=np.int64) for x in (left, right, made))
        key = left << 32 | right
        order = np.argsort(key)
        self.pair_key, self.pair_made = key[order], made[order]
        # a piece is plain if no pair that holds it has a lower or equal rank: then all places of the lowest pair
        # may merge in one round, since no merge can bring forth a pair that is due before the others
        odd = shared_rank.copy()
        early = self.rank[made] <= self.rank[left]
        odd[left[early]] = True
        early = self.rank[made] <= self.rank[right]
        odd[right[early]] = True
        self.plain = ~odd
        inside = {text[i : i + 2] for text in texts for i in range(len(text) - 1)}
        self.joined = np.unique(np.array([ord(a) << 32 | ord(b) for a, b in inside], dtype=np.int64))
        char_piece = np.full(0x110000, -1, dtype=np.int32)
        for text, i in self.piece.items():
            if len(text) == 1:
                char_piece[ord(text)] = i
        self.char_piece = char_piece
        self.cut_at_marks = all(MARK not in text.lstrip(MARK) for text in texts)
        self.known: dict[str, int] = {}

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_made[at], -1)

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token (blanks already written as the mark)."""
        joined = "".join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        known = self.char_piece[points].astype(np.int64)
        # a character that is no piece never merges and falls back to its bytes
        n_bytes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        symbols = np.where(known >= 0, known, len(self.rank) + points)
        owner = np.repeat(np.arange(len(words)), [len(word) for word in words])
        fallback = np.where(known < 0, n_bytes - 1, 0)
        totals = np.bincount(owner, weights=fallback, minlength=len(words)).astype(np.int64)
        while len(symbols):
            made = self.pairs(symbols[:-1], symbols[1:])
            made[owner[:-1] != owner[1:]] = -1
            rank = np.where(made >= 0, self.rank[made], NONE)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            if not len(rank):
                totals[owner] += 1
                break
            ranks = np.append(rank, NONE)
            lowest = np.minimum.reduceat(ranks, first)
            # finished pre-tokens: count what is left and take them out
            length = np.diff(np.append(first, len(symbols)))
            done = lowest == NONE
            totals[owner[first[done]]] += length[done]
            at = np.flatnonzero((ranks == np.repeat(lowest, length)) & (ranks < NONE))
            pieces_at = made[at]
            keep_row = np.repeat(~done, length)
            odd = ~self.plain[pieces_at]
            if odd.any():  # here only the first place of the pre-token is certain
                group = np.searchsorted(first, at, side="right") - 1
                opens = np.concatenate([[True], group[1:] != group[:-1]])
                at = at[opens | ~np.isin(group, group[odd])]
                for g in np.unique(group[odd & (length[group] > LONG)]).tolist():
                    lo, hi = first[g], first[g] + length[g]
                    totals[owner[lo]] += self.one_by_one(symbols[lo:hi].tolist())
                    keep_row[lo:hi] = False
                    at = at[(at < lo) | (at >= hi)]
            # of overlapping places (aaa) every second one, from the left
            if len(at):
                run = np.cumsum(np.concatenate([[True], np.diff(at) != 1])) - 1
                run_start = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
                at = at[(np.arange(len(at)) - run_start[run]) % 2 == 0]
                symbols[at] = made[at]
                keep_row[at + 1] = False
            symbols, owner = symbols[keep_row], owner[keep_row]
        return totals

    def one_by_one(self, symbols: list[int]) -> int:
        """The same merging with a heap, for long pre-tokens whose lowest pair is not plain."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int, int, int]] = []
        lookup, ranks = self.pair_lookup(), self.rank

        def push(i: int) -> None:
            j = after[i]
            if j < n and (made := lookup.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(heap, (int(ranks[made]), i, symbols[i], symbols[j], made))

        for i in range(n):
            push(i)
        left = n
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = made, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            left -= 1
            if before[i] >= 0:
                push(before[i])
            push(i)
        return left

    @lru_cache(maxsize=1)  # noqa: B019  the vocabulary lives as long as its worker
    def pair_lookup(self) -> dict[tuple[int, int], int]:
        return {(k >> 32, k & 0xFFFFFFFF): m for k, m in zip(self.pair_key.tolist(), self.pair_made.tolist())}

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text. Where no piece holds a mark behind another character, marks cut the texts first."""
        if not self.cut_at_marks:
            return self.counts([MARK + text.replace(" ", MARK) if text else "" for text in texts.to_pylist()])
        some = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(texts, " ", MARK)
        mark, nothing = pa.scalar(MARK, pa.large_string()), pa.scalar("", pa.large_string())
        prefixed = pc.if_else(pa.array(some), pc.binary_join_element_wise(mark, marked, nothing), nothing)
        lists = pc.split_pattern(prefixed, MARK)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = lists.flatten()
        # each text opens with an empty part before its first mark; an empty part elsewhere is a longer run of marks
        empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        opening = np.zeros(len(flat), dtype=bool)
        opening[starts[:-1]] = True
        runs = empty & ~opening
        codes = flat.dictionary_encode()
        index = codes.indices.to_numpy(zero_copy_only=False)
        words = codes.dictionary.to_pylist()
        plain_counts = self.counts([MARK + word if word else "" for word in words])
        value = plain_counts[index]
        if runs.any():  # a run of marks belongs to the word behind it
            ends = np.flatnonzero(runs & ~np.append(runs[1:], False))
            begins = np.flatnonzero(runs & ~np.concatenate([[False], runs[:-1]]))
            last = np.repeat(starts[1:], np.diff(starts))  # end of the text a part belongs to
            joined = []
            for begin, end in zip(begins.tolist(), ends.tolist()):
                follows = end + 1 < last[end]
                joined.append(MARK * (end - begin + 1) + (MARK + words[index[end + 1]] if follows else ""))
                if follows:
                    value[end + 1] = 0
            value[ends] = self.counts(joined)
        return per_text(value, starts, np.add, 0)

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, through the pre-tokens it is cut into; equal words are merged once."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self.known[""] = 0
        fresh = sorted({word for word in words if word not in self.known}, key=len)
        long: dict[str, int] = {}
        for start in range(0, len(fresh), 20_000):
            part = fresh[start : start + 20_000]
            cut, owner = self.cut(part)
            totals = np.bincount(owner, weights=self.count(cut), minlength=len(part)).astype(np.int64).tolist()
            for word, total in zip(part, totals):
                (self.known if len(word) <= KNOWN_CHARS else long)[word] = total
        return np.array([self.known[word] if word in self.known else long[word] for word in words], dtype=np.int64)

    def cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of the words and the word each is from: cut between characters that stand together in no piece."""
        text = "".join(words)
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum([len(word) for word in words])
        key = points[:-1] << 32 | points[1:]
        at = np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)
        cuts = np.unique(np.concatenate([[0], np.flatnonzero(self.joined[at] != key) + 1, ends]))
        bounds = cuts.tolist()
        return [text[a:b] for a, b in zip(bounds, bounds[1:])], np.searchsorted(ends, cuts[:-1], side="right")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> VocabularyCounts:
    return VocabularyCounts(path)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    No begin or end tokens; the text of a control piece is ordinary text. A null or empty text has no bytes and no
    tokens. Rows are independent: repeated rows come out repeated, an empty table gives an empty result, other columns
    are ignored. ``path`` must be readable by executors.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(path)
        with word_table(model.known.clear):
            for batch in pieces(batches, text_col):
                texts = texts_of(batch, text_col)
                yield pa.RecordBatch.from_pydict(
                    {
                        id_col: batch.column(id_col),
                        "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                        "n_tokens": pa.array(model.texts(texts), pa.int64()),
                    }
                )

    kind = dict(docs.dtypes)[id_col]
    counted = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
