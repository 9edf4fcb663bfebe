"""BPE encoding and token counts against the libraries whose results they must equal."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from billscope.llm.bpe import encode_decode
from billscope.llm.pieces import token_counts
from billscope.llm.queries import prepared

BPE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(3)
    odd = " \n\t'\x85\xa0　\x1c​▁"

    def character():
        k = rng.random()
        if k < 0.3:
            return rng.choice(odd)
        if k < 0.7:
            return chr(rng.randint(1, 0x7F))
        return chr(rng.choice([rng.randint(0x80, 0x7FF), rng.randint(0x800, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))

    fixed = [None, "", " ", "  a  b ", "a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> x <|y", "don't I'LL we've 123456789 ½",
             " " * 700, "a" * 4000, "ab" * 2000, "日本語テキスト" * 200, "<s> a</s> <0x41>", "  " * 40 + "hello", "x" + " " * 37 + "y", "0" * 999, "---- ====  ====",
             "the question is " * 3000, "same", "same"]
    return fixed + ["".join(character() for _ in range(rng.randint(1, 60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 3 else i, text, "extra") for i, text in enumerate(texts())]
    return prepared(spark).createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)


def test_bpe_equals_the_library(docs):
    library = Tokenizer.from_file(BPE)
    got = {}
    for row in encode_decode(docs, BPE, public_tokenizers.PATTERN, ids=True).collect():
        got[row["doc_id"]] = row
    for i, text in enumerate(texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = got[None if i == 3 else i]
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_counts_equal_the_library(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {row["doc_id"]: row for row in token_counts(docs, PIECE, limit=50).collect()}
    for i, text in enumerate(texts()):
        row = got[None if i == 3 else i]
        n = len(library.encode(text or ""))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len((text or "").encode()), n, n > 50)


def test_empty_tables(spark):
    empty = prepared(spark).createDataFrame([], "doc_id long, text string")
    assert encode_decode(empty, BPE, public_tokenizers.PATTERN).collect() == []
    assert token_counts(empty, PIECE).collect() == []
