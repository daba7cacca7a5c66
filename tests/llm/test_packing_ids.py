"""ids against the tokenizer of the contract with its defaults."""

import json
import zlib

import numpy as np
import public_tokenizers
from landlens.llm import packing as M
from tokenizers import Tokenizer

from data import frame

JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|>", " a  <|endoftext|>  b ", "<|endoftext| >", "<|<|endoftext|>|>", "don't\n\n<|endoftext|>\n café 漢字 😀"]


WHOLE = Tokenizer.from_file(JSON)


def contract(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


def test_added_tokens():
    with open(JSON, encoding="utf-8") as f:
        assert M.ADDED == {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    assert contract("a<|endoftext|>b") == [64, 50256, 65]


def test_ids_of_the_contract():
    for path in (None, public_tokenizers.path("byte_bpe_50k.tiktoken"), JSON):
        encode = M.encoder(path)
        for text in TEXTS:
            assert encode(text).tolist() == contract(text), (path, text)


def test_packed_ids(spark):
    found = M.pack(frame(spark, [(i, t, *[None] * 7) for i, t in enumerate(TEXTS)], 1), 64).collect()
    for i, text in enumerate(TEXTS):
        ids = np.array(contract(text) + [1], "<u4")
        own = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in found if p["doc_id"] == i)
        assert own and sum(n for _, n, _, _ in own) == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == c and total == len(ids) for s, n, c, total in own)


def long_spaces():
    mixed = " \t\n  \r" * 50_000
    yield from (" " * 5_000_000, "\n" * 1_500_000, mixed * 3, "a" + " " * 1_000_000 + "b", "a\n" + mixed * 3 + "\n'll <|endoftext|>", "\x1c" * 10 + " " * 900_000 + "\x1d x")
    yield " " * 900_000 + "<|endoftext|>" + "\t" * 900_000 + "1" + " " * 300_000 + "　é"


def test_long_white_space():
    encode = M.encoder(None)
    for text in long_spaces():
        assert np.array_equal(encode(text), contract(text)), (len(text), text[:20])


def test_long_white_space_is_packed(spark):
    texts = ["x" + " " * 1_200_000 + "y", "\n" * 1_000_000, "plain"]
    found = M.pack(frame(spark, [(i, t, *[None] * 7) for i, t in enumerate(texts)], 2)).collect()
    for i, text in enumerate(texts):
        assert sum(p["length"] for p in found if p["doc_id"] == i) == len(contract(text)) + 1
