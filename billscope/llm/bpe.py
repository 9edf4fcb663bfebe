"""Byte-level BPE encoding and decoding over a trie of distinct words.

A byte-pair encoding of a word ends, at each prefix, in exactly one token: the vocabulary entry that is a suffix of
the prefix and forms a stable pair with the last token of what stands before it. That last token is the state of the
prefix's trie node, so words with a common beginning share the work for it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from billscope.llm.common import per_text, pieces, texts_of, word_table

# Words and short runs of words whose encodings a task keeps between batches before it starts anew; bounds memory, not the result.
KNOWN_WORDS = 150_000
KNOWN_CHARS = 64


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieBpe:
    """Encoder and decoder of one tokenizer file (byte-level BPE without normalizer)."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        as_bytes = lambda token: bytes(symbols[ch] for ch in token)
        ids = {token: i for token, i in spec["model"]["vocab"].items()}
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.bytes_of = {i: as_bytes(token) for token, i in ids.items()} | {i: token.encode() for token, i in self.added.items()}
        self.size_of = {i: len(token) for i, token in self.bytes_of.items()}
        self.ranks: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}  # token -> rank of the merge that makes it, its two parts
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[ids[a], ids[b]] = rank
            self.made_of.setdefault(ids[a + b], (rank, ids[a], ids[b]))
        # vocabulary entries read from their last byte: the walk that finds all tokens ending at a position
        self.back: dict[int, int] = {}
        self.back_token: list[int] = [-1]
        for token, i in ids.items():
            node = 0
            for byte in reversed(as_bytes(token)):
                node = self.back.setdefault(node << 8 | byte, len(self.back) + 1)
                if node == len(self.back_token):
                    self.back_token.append(-1)
            self.back_token[node] = i
        self.words = regex.compile(pattern).findall
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None
        self.edges: tuple[dict, dict] = {}, {}
        self.stable: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one edge of the token while it is merged: (rank of the merge that ends it, token), in time order."""
        found = self.edges[side].get(token)
        if found is None:
            chain, until = [], 1 << 60
            while True:
                chain.append((until, token))
                if token not in self.made_of:
                    break
                until, *parts = self.made_of[token]
                token = parts[side]
            found = self.edges[side][chain[0][1]] = chain[::-1]
        return found

    def is_stable(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens together gives these two tokens: no merge crosses the border.

        Both sides are merged in rank order; the pair at the border must never be due before the next merge beside it.
        Of equal ranks the left one comes first.
        """
        lefts, rights, ranks = self.edge(left, 1), self.edge(right, 0), self.ranks
        i = j = 0
        while True:
            left_until, a = lefts[i]
            right_until, b = rights[j]
            due = ranks.get((a, b))
            if due is not None and due < left_until and due <= right_until:
                return False
            if left_until == right_until == 1 << 60:
                return True
            if left_until <= right_until:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[str]) -> None:
        """Encode distinct words; in sorted order they are the trie's branches, met depth first.

        ``last[d]`` is the state of the current branch at depth d. A word keeps the states of what it shares with
        the word before it and adds those of its own rest.
        """
        back, tokens, stable, size_of, known = self.back, self.back_token, self.stable, self.size_of, self.known
        last, before = [-1], b""
        for word, text in sorted((word.encode(), word) for word in words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :]
            for depth in range(shared, len(word)):
                node, start, found = 0, depth + 1, -1
                while start:
                    start -= 1
                    node = back.get(node << 8 | word[start])
                    if node is None:
                        break
                    token = tokens[node]
                    if token >= 0:
                        if not start:  # one token for the whole prefix, should no shorter one have fitted
                            found = token
                            break
                        key = last[start] << 32 | token
                        fits = stable.get(key)
                        if fits is None:
                            fits = stable[key] = self.is_stable(last[start], token)
                        if fits:
                            found = token
                            break
                if found < 0:
                    raise ValueError(f"no token ends at byte {depth + 1} of {word[:80]!r}")
                last.append(found)
            out, depth = [], len(word)
            while depth:
                out.append(last[depth])
                depth -= size_of[last[depth]]
            known[text] = tuple(reversed(out))
            before = word

    def encode_chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """Ids of distinct chunks of text; added tokens inside a chunk get their own id."""
        added, known = self.added, self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        if len(self.stable) > 4 * KNOWN_WORDS:
            self.stable.clear()
        known.update({token: (i,) for token, i in added.items()})
        split = {}
        for chunk in chunks:
            if chunk in known:
                continue
            if self.split_added and "<|" in chunk:
                split[chunk] = [w for part in self.split_added(chunk) for w in ([part] if part in added else self.words(part))]
            else:
                split[chunk] = self.words(chunk)
        self.encode_words({word for words in split.values() for word in words}.difference(known))
        long = {}
        for chunk, words in split.items():
            if len(words) != 1:
                (known if len(chunk) <= KNOWN_CHARS else long)[chunk] = tuple(i for w in words for i in known[w])
        return [known[chunk] if chunk in known else long[chunk] for chunk in chunks]

    def encode(self, texts: pa.Array) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
        """Ids of the texts as (ids of distinct chunks, each chunk's index into them, where each text's chunks start).

        Words never cross a single blank between two other characters, so most texts are cut there and equal chunks are
        encoded once. Texts with longer white space runs, or with an added token that holds a blank, stay whole.
        """
        whole = pc.match_substring_regex(texts, r"^\s|\s$|\s\s").to_numpy(zero_copy_only=False)
        for token in self.added:
            if " " in token:
                whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        # \s above is ASCII only; other white space must not touch a blank either
        whole |= pc.match_substring_regex(texts, r"[\p{Z}\x{85}\x{1c}-\x{1f}][\p{Z}\x{85}\x{1c}-\x{1f}]|^[\p{Z}\x{85}]|[\p{Z}\x{85}]$|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b\x1c-\x1f]").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        encoded = lists.flatten().dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        pieces_ = encoded.dictionary.to_pylist()
        chunks = [" " + piece for piece in pieces_]
        first = starts[:-1]
        opening = np.unique(codes[first]) if len(first) else np.zeros(0, np.int64)
        moved = dict(zip(opening.tolist(), range(len(chunks), len(chunks) + len(opening))))
        chunks += [pieces_[i] for i in opening.tolist()]
        codes[first] = [moved[i] for i in codes[first].tolist()]
        rows = np.flatnonzero(whole)
        codes[first[rows]] = range(len(chunks), len(chunks) + len(rows))
        chunks += texts.take(pa.array(rows)).to_pylist()
        return self.encode_chunks(chunks), codes, starts

    def forget(self) -> None:
        self.known.clear()
        self.stable.clear()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> TrieBpe:
    return TrieBpe(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Each row's id with ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256``.

    The decoded text is made from the ids, not taken from the input. ``ids=True`` adds the id array itself.
    A null text counts as empty: no tokens, digests of the empty string. Rows are independent: repeated rows come out
    repeated, an empty table gives an empty result, other columns are ignored. ``path`` must be readable by executors.
    """
    columns = [f"`{id_col}` {dict(docs.dtypes)[id_col]}", "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        with word_table(bpe.forget):
            for batch in pieces(batches, text_col):
                chunks, codes, starts = bpe.encode(texts_of(batch, text_col))
                sizes = np.array([len(chunk) for chunk in chunks], dtype=np.int64)
                decimal = [",".join(map(str, chunk)) for chunk in chunks]
                decoded = [b"".join(map(bpe.bytes_of.__getitem__, chunk)) for chunk in chunks]
                of_ids, of_text, arrays = [], [], []
                for start, end in zip(starts.tolist(), starts[1:].tolist()):
                    found = codes[start:end].tolist()
                    joined = ",".join([decimal[i] for i in found if decimal[i]])
                    of_ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    text = b"".join([decoded[i] for i in found]).decode("utf-8", "replace")
                    of_text.append(hashlib.sha256(text.encode()).hexdigest())
                    if ids:
                        arrays.append([token for i in found for token in chunks[i]])
                out = {id_col: batch.column(id_col), "n_tokens": pa.array(per_text(sizes[codes], starts, np.add, 0), pa.int64()), "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_text, pa.string())}
                if ids:
                    out["ids"] = pa.array(arrays, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(id_col, text_col).mapInArrow(run, ", ".join(columns + ["ids array<int>"] * ids))
