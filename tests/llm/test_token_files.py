"""Token files: exact round trip against the tokenizer, views without copies, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from landlens.llm import token_files as M

from data import DOCS, frame, odd_documents
from test_packing_ids import JSON, Tokenizer

WHOLE = Tokenizer.from_file(JSON)


def contract(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


def brute(rows):
    """Documents in ascending id order, nulls first: (doc_id, start, n_tokens, crc)."""
    out, at = [], 0
    for doc, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(contract(text) + [0], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("length", [2048, 16, 1])
def test_round_trip(spark, length, monkeypatch):
    monkeypatch.setattr(M, "BATCH_IDS", 64)
    rows = odd_documents() + [(500, "<|endoftext|>! !", *[None] * 7), (501, "!" * 40, *[None] * 7)]
    manifest = M.write(frame(spark, rows, 5), length=length)
    found = sorted((tuple(r) for r in M.read_documents(manifest).collect()), key=lambda r: r[1])
    assert found == brute(rows)
    assert [r["n_documents"] for r in manifest.collect() if r["n_documents"] == 0] == []


def test_views_by_number(spark, monkeypatch):
    monkeypatch.setattr(M, "BATCH_IDS", 100)
    rows = [(i, f"word{i} " * (i % 7), *[None] * 7) for i in range(90)]
    files = sorted(M.write(frame(spark, rows, 4), length=32).collect(), key=lambda r: r["first_id_at"])
    stream, bits, before = [], [], 0
    for r in files:
        held = M.SequenceFile(r["file"])
        ids, masks = zip(*(held.sequence(n) for n in range(len(held))))
        assert r["first_id_at"] == before and all(len(x) == len(m) == 32 for x, m in zip(ids, masks))
        held.source.seek(0)
        low = held.source.read_buffer(1).address  # every sequence lies inside the mapped file
        assert all(low <= x.ctypes.data < low + held.source.size() and not x.flags.owndata for x in ids)
        assert all(low <= m.buffers()[1].address < low + held.source.size() for m in masks)
        flat, mask = np.concatenate(ids), np.concatenate([m.to_numpy(zero_copy_only=False) for m in masks])
        assert len(flat) - r["n_ids"] < 32 and not flat[r["n_ids"]:].any() and not mask[r["n_ids"]:].any()
        stream.extend(flat[:r["n_ids"]].tolist())
        bits.extend(mask[:r["n_ids"]].tolist())
        before += r["n_ids"]
    want = [contract(t or "") for _, t, *_ in rows]
    assert stream == [i for ids in want for i in ids + [0]]
    assert bits == [b for ids in want for b in [True] * len(ids) + [False]]


def test_one_hot_id_is_split(spark):
    rows = [(7, f"text {i}", *[None] * 7) for i in range(400)] + [(7, "same", *[None] * 7)] * 400 + [(8, "last", *[None] * 7)]
    manifest = M.write(frame(spark, rows, 6))
    assert manifest.count() > 4
    found = sorted((tuple(r) for r in M.read_documents(manifest).collect()), key=lambda r: r[1])
    assert [r[1] for r in found] == np.cumsum([0] + [r[2] for r in found])[:-1].tolist()
    assert sorted((r[0], r[2], r[3]) for r in found) == sorted((r[0], r[2], r[3]) for r in brute(rows))


def test_values_that_do_not_fit(spark):
    with pytest.raises(Exception, match="does not fit"):
        M.write(frame(spark, [(1, "a long word", *[None] * 7)], 1), dtype="uint8")


def test_a_cut_off_file_is_an_error(spark):
    manifest = M.write(frame(spark, [(i, "some words", *[None] * 7) for i in range(3)], 1))
    path = manifest.first()["file"]
    at = M._open_store(path)[1].removesuffix(".arrow") + ".documents.arrow"
    with pa.OSFile(at, "wb") as f, pa.ipc.new_file(f, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])):
        pass
    with pytest.raises(ValueError, match="differ"):
        list(M._documents_of(path, 0))


def test_empty_table(spark):
    empty = M.write(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and M.read_documents(empty).count() == 0
