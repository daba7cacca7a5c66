import random
import zlib

import numpy as np
import pytest
from landlens.llm import packing as M

from data import DOCS, frame, odd_documents
from test_packing_ids import contract


def tokens(text):
    return contract(text or "") + [1]


@pytest.mark.parametrize("window,opened,fan", [(2048, 32, 8), (64, 3, 2), (16, 1, 1)])
def test_every_id_in_one_piece(spark, window, opened, fan):
    rows = odd_documents() + [(500, "<|endoftext|> café 漢字 😀", *[None] * 7)]
    pieces = M.pack(frame(spark, rows, 5), window, opened, fan).collect()
    ids = {r[0]: np.array(tokens(r[1]), "<u4") for r in rows}
    copies = {r[0]: sum(x[0] == r[0] for x in rows) for r in rows}
    by_doc, by_seq = {}, {}
    for p in pieces:
        own = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert len(own) == p["length"] > 0 and zlib.crc32(own.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        by_doc.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        by_seq.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for doc, own in by_doc.items():
        cover = np.zeros(len(ids[doc]), int)
        for s, n in own:
            cover[s:s + n] += 1
        assert (cover == copies[doc]).all()
    assert set(by_doc) == set(ids)
    for own in by_seq.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at == window or at & (at - 1) == 0 and at < window  # no padding at all


def test_best_fit():
    p = M.Packer(10, 2, 0)
    for doc, n in (("a", 6), ("b", 8), ("c", 2), ("d", 4)):
        p.add(doc, np.ones(n, np.uint32))
    assert [(r[0], r[2], r[5]) for r in p.done] == [("b", 8, 0), ("c", 2, 0), ("a", 6, 1), ("d", 4, 1)]


def test_same_ids_as_the_json_tokenizer():
    rng = random.Random(2)
    import public_tokenizers
    ranks, whole = M.encoder(None), M.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", " ", "\n\n x", "a" * 700, "don't <|endoftext|>", "".join(chr(rng.randrange(1, 0xD7FF)) for _ in range(500))]:
        assert ranks(text).tolist() == whole(text).tolist()


def test_empty_table(spark):
    assert M.pack(spark.createDataFrame([], DOCS)).count() == 0
