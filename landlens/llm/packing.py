"""Sequence packing with bounded space, online, best fit.

Every task reads its documents once and keeps at most ``open_windows`` unfinished windows. A document's tokens (its ids
and one closing id) fill whole windows first; what remains goes into the open window it fits most tightly. When
none fits and no more may be opened, the fullest window is completed with the head of the piece and emitted, and the tail is
placed again, so an emitted window never needs padding. The open windows that tasks end with are merged:
``fan_in`` neighbouring tasks' leftovers are packed again by the same rule, and what then is left
over is laid end to end and cut into whole windows and powers of two, which need no padding either.

Memory is bounded by the windows and one Arrow batch. A lost task repeats alone; packed rows are written to the shared folder before the merge.

Defined results: a null or empty text is one closing id; repeated rows and null ids are packed like any other, once a row; a
document longer than a window is cut; an empty table gives an empty result. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin, text_or_empty

#: The added tokens of ``byte_bpe_50k.json``, which the rank file lacks.
ADDED = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def encoder(path: str | None):
    """str -> array of ids. ``path``: a vocabulary of byte-level BPE ranks or a ``.json`` tokenizer; by default the
    ranks of the public ``byte_bpe_50k`` with its added tokens. The ids are those of the tokenizer with its defaults and
    add_special_tokens=False: an added token's string inside a text is that token."""
    import public_tokenizers

    default = public_tokenizers.path("byte_bpe_50k.tiktoken")
    path = path or default
    if str(path).endswith(".json"):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(str(path))
        return lambda text: np.asarray(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED if str(path) == default else {})

    def encode(text: str) -> np.ndarray:
        try:
            return np.asarray(ranked.encode(text, allowed_special="all"), np.uint32)
        except ValueError:  # its pattern backtracks over white space and gives up on runs of about a million
            return _long_spaces(ranked, text)
    return encode


#: The regular expression engine gives up somewhat above 800,000 white-space characters in a row.
LONG_SPACES = 1 << 18


def _long_spaces(ranked, text: str) -> np.ndarray:
    """ids of a text with long runs of white space. Before a word the pattern takes all of a run but its last character, at
    the end of the text all of it; both are one piece, so the text can be cut around them, and the piece needs no pattern."""
    out, at = [], 0
    for run in re.finditer(r"[^\S\x1c-\x1f]+", text):  # white space by Unicode; Python's class holds four controls more
        if run.end() - run.start() >= LONG_SPACES:
            end = run.end() - (run.end() < len(text) and not text.startswith(tuple(ADDED), run.end()))
            out.append(ranked.encode(text[at:run.start()], allowed_special="all"))
            out.append(ranked._encode_single_piece(text[run.start():end]))
            at = end
    out.append(ranked.encode(text[at:], allowed_special="all"))
    return np.concatenate([np.asarray(x, np.uint32) for x in out])


class Packer:
    """The open windows of one task. A piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, window: int, open_windows: int, first_id: int):
        self.window, self.most, self.next_id = window, open_windows, first_id
        self.room: list[int] = []  # ascending, parallel to ``open``
        self.open: list[list[tuple]] = []
        self.done: list[tuple] = []  # rows ready to go out

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.emit([(doc, at, ids[at:at + self.window], len(ids))])
        if whole < len(ids):
            self.place((doc, whole, ids[whole:].copy(), len(ids)))

    def place(self, piece: tuple) -> None:
        while True:
            doc, start, ids, total = piece
            i = bisect.bisect_left(self.room, len(ids))
            if i < len(self.room):  # the tightest that fits
                room, pieces = self.room.pop(i) - len(ids), self.open.pop(i)
                pieces.append(piece)
                return self.keep(room, pieces)
            if len(self.room) < self.most:
                return self.keep(self.window - len(ids), [piece])
            room, pieces = self.room.pop(0), self.open.pop(0)  # the fullest
            self.emit([*pieces, (doc, start, ids[:room], total)])
            piece = (doc, start + room, ids[room:], total)

    def keep(self, room: int, pieces: list[tuple]) -> None:
        if not room:
            return self.emit(pieces)
        i = bisect.bisect_left(self.room, room)
        self.room.insert(i, room)
        self.open.insert(i, pieces)

    def close(self) -> None:
        """Lay what is open end to end; cut it into windows and powers of two."""
        left = sum(self.window - r for r in self.room)
        sizes = [self.window] * (left // self.window) + [1 << b for b in range(self.window.bit_length(), -1, -1) if (left % self.window) >> b & 1]
        pieces = [p for w in self.open for p in w][::-1]
        for size in sizes:
            row, need = [], size
            while need:
                doc, start, ids, total = pieces.pop()
                row.append((doc, start, ids[:need], total))
                if len(ids) > need:
                    pieces.append((doc, start + need, ids[need:], total))
                need -= len(row[-1][2])
            self.emit(row)
        self.room, self.open = [], []


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(docs: DataFrame, window: int = 2048, open_windows: int = 32, fan_in: int = 8, closing_id: int = 1,
         tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    slim = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    tail = ", task bigint, ids binary"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, task = encoder(tokenizer_path), None, TaskContext.get().partitionId()
        packer, end = Packer(window, open_windows, task << 32), np.array([closing_id], np.uint32)
        for batch in batches:
            if out is None:
                out = _arrow_schema(batch.schema.field("doc_id").type, True)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(doc, np.concatenate([encode(text.as_py()), end]))
                if len(packer.done) >= 4096:
                    yield _batch([(*r, None, None) for r in packer.done], out)
                    packer.done = []
        if out is not None:
            rest = [(doc, start, len(ids), None, total, k, None, task, ids.astype("<u4").tobytes()) for k, w in enumerate(packer.open) for doc, start, ids, total in w]
            yield _batch([(*r, None, None) for r in packer.done] + rest, out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, out = None, None
        for batch in batches:
            rows = batch.to_pydict()
            for doc, start, total, task, ids in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], rows["task"], rows["ids"]):
                if packer is None:
                    packer, out = Packer(window, open_windows, 1 << 62 | task << 32), _arrow_schema(batch.schema.field("doc_id").type, False)
                packer.place((doc, start, np.frombuffer(ids, "<u4"), total))
            if packer and packer.done:
                yield _batch(packer.done, out)
                packer.done = []
        if packer:
            packer.close()
            yield _batch(packer.done, out)

    packed = pin(slim.mapInArrow(first, schema + tail))
    last = packed.agg(F.max("task")).first()[0]
    groups = max(1, -(-((last or 0) + 1) // fan_in))
    loose = (packed.where("ids is not null").withColumn("part", F.expr(f"task div {fan_in}"))
             .repartitionByRange(groups, "part").sortWithinPartitions("task", "sequence_id", "doc_id", "start"))
    merged = loose.drop("part").mapInArrow(merge, schema)
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.where("ids is null").drop("task", "ids").unionByName(merged).toDF(*names)


def _arrow_schema(id_type: pa.DataType, loose: bool) -> pa.Schema:
    fields = [("doc_id", id_type), *[(n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    return pa.schema(fields + [("task", pa.int64()), ("ids", pa.binary())] * loose)
