"""Repeated byte strings by suffix order and longest-previous-factor arrays.

A byte is repeated if a string of ``least`` bytes that covers it also starts anywhere else in the corpus, the same document
included. A window is such a string; it is repeated when its longest previous or its longest next factor reaches its full
length. Sorting every suffix of a corpus moves far more data than it decides, so suffix arrays
are built only where they can differ from "all of it" and "none of it":

1. Winnowing. In every window the smallest hash of its ``gram``-byte strings is the window's anchor. Equal windows have equal anchors
   at equal places. Consecutive windows with one anchor are a run; a run's bytes are its segment. An anchor hash that occurs once in
   the corpus proves all windows of its run unique.
2. Runs that are equal as a whole (anchor, segment) settle each other: all their windows are repeated. One of them stays as the group's first.
3. Anchors that still have several different segments are brought together, first occurrences only. Blocks of them get a suffix array (prefix doubling,
   cut off at ``least`` bytes, ties by position). Entries of one tie share ``least`` bytes or more: the entry before is the previous
   smaller position and gives the earlier match, the entry after the next one. An anchor of very many segments is dealt into chunks; each chunk's suffix array
   removes its later copies and keeps the first, and only first copies meet in one more count by window hash.

All steps are shuffles of narrow rows with partial aggregation; text moves once, in the last join. Segments are found by a third
scan behind a bit table of fixed size.

Defined results: a null text is empty; texts shorter than ``least`` bytes have no window and keep everything; empty texts have 0 bytes
and the digest of nothing; equal rows are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin, text_or_empty
from .kernels import _LETTER, _ODD, in_slices, mix, powers

BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
#: Window starts of one piece of a long text, bits of the table of wanted anchors, segments of an anchor in one suffix array, and its bytes.
PIECE, FILTER_BITS, CHUNK, BLOCK = 1 << 19, 1 << 25, 4096, 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        _POWERS["up"], _POWERS["down"] = powers(BASE, n), powers(INVERSE, n)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Hashed:
    """Prefix sums of a byte string from which the hash of any of its strings follows."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTER[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def runs_of(pieces: list[bytes], least: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: piece, first window start (within the piece), number of windows, anchor hash, segment hash of every run."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    none = np.zeros(0, np.int64)
    if len(data) < least or not (sizes >= least).any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashed = Hashed(data)
    at = np.arange(len(data) - gram + 1)
    grams = mix((hashed.sums[gram:] - hashed.sums[:-gram]) * hashed.down[:len(at)])
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    anchor = (_sliding_min(ranked, least - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = len(anchor)
    step = np.zeros(n + 1, np.int8)
    whole = sizes >= least
    step[begins[whole]] += 1
    np.add.at(step, ends[whole] - least + 1, -1)
    valid = np.cumsum(step[:n], dtype=np.int8) > 0
    new = valid.copy()
    new[1:] &= anchor[1:] != anchor[:-1]
    new[begins[whole]] = True
    first = np.flatnonzero(new)
    last = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True))
    many = last - first + 1
    owner = np.searchsorted(ends, first, side="right")
    inner = anchor[first] - first
    segment = mix(hashed.of(first, last + least) + many.astype(np.uint64) * _ODD + inner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return owner, first - begins[owner], many, grams[anchor[first]], segment


def _pieces(batch: pa.RecordBatch, least: int):
    """(row, offset, bytes) of whole texts; long ones in pieces that overlap so that every window start is in one."""
    texts = batch.column("text")
    for i in range(batch.num_rows):
        raw = texts[i].as_py().encode("utf-8", "surrogatepass")
        for at in range(0, max(1, len(raw) - least + 1), PIECE):
            yield i, at, raw[at:at + PIECE + least - 1]


def _scan(batch: pa.RecordBatch, least: int, gram: int):
    """For slices of a batch: the pieces, and of their runs (row, start in the text, windows, anchor, segment, piece, start in the piece)."""
    for part in in_slices(_pieces(batch, least), lambda p: len(p[2])):
        owner, start, many, anchor, segment = runs_of([p[2] for p in part], least, gram)
        row, base = np.array([p[0] for p in part])[owner], np.array([p[1] for p in part])[owner]
        yield part, row, base + start, many, anchor.view(np.int64), segment.view(np.int64), owner, start


def _columns(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _anchors(rows: DataFrame, least: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, anchor, *_ in _scan(batch, least, gram):
                if len(anchor):
                    yield _columns("h", anchor)

    return rows.select("text").mapInArrow(run, "h bigint")


def _runs(rows: DataFrame, least: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            for _, row, start, many, anchor, segment, *_ in _scan(batch, least, gram):
                if len(row):
                    yield _columns("h e k1 k2 s n", anchor, segment, k1[row], k2[row], start, many)

    return rows.mapInArrow(run, "h bigint, e bigint, k1 bigint, k2 bigint, s bigint, n bigint")


def _segments(rows: DataFrame, least: int, gram: int, wanted: DataFrame) -> DataFrame:
    """h, e, seg: the bytes of one run of each wanted (anchor, segment)."""
    bits = (wanted.select(F.expr(f"pmod(h, {FILTER_BITS})").alias("bit")).select(F.expr("bit div 32").alias("w"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())  # FILTER_BITS / 32 rows at most
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[bits.column("w").to_numpy()] = bits.column("b").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, many, anchor, segment, owner, start in _scan(batch, least, gram):
                bit = anchor % FILTER_BITS
                hit = np.flatnonzero(shared.value[bit >> 5] >> (bit & 31).astype(np.uint32) & 1)
                if len(hit):
                    _, once = np.unique(segment[hit], return_index=True)
                    hit = hit[once]
                    seg = [part[o][2][s:s + m + least - 1] for o, s, m in zip(owner[hit].tolist(), start[hit].tolist(), many[hit].tolist())]
                    yield _columns("h e seg", anchor[hit], segment[hit], pa.array(seg, pa.binary()))

    return rows.select("text").mapInArrow(run, "h bigint, e bigint, seg binary")


def suffix_ties(data: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the suffixes at ``starts`` (ascending), compared on ``least`` bytes with ties by position, by prefix doubling; and for each of its
    entries whether it ties with the entry before, that is, whether their common prefix reaches ``least``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    keys = np.zeros(len(data), np.uint64)
    for i in range(8):
        keys = keys << np.uint64(8) | padded[i:i + len(data)]
    width, rank = 8, np.unique(keys, return_inverse=True)[1].astype(np.int64)
    if width > least:
        rank, width = np.unique(keys >> np.uint64(8 * (8 - least)), return_inverse=True)[1].astype(np.int64), least
    while width * 2 <= least:
        after = np.concatenate([rank[width:], np.zeros(width, np.int64)])
        rank = np.unique(rank << np.int64(32) | after, return_inverse=True)[1].astype(np.int64)
        width *= 2
    pair = rank[starts] << np.int64(32) | rank[starts + least - width]
    order = np.argsort(pair, kind="stable")
    ties = np.zeros(len(order), bool)
    ties[1:] = pair[order][1:] == pair[order][:-1]
    return order, ties


def previous_factors(data: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For every start (ascending) the nearest smaller and the nearest larger start whose factor reaches ``least`` bytes, as index or -1."""
    order, ties = suffix_ties(data, starts, least)
    before, after = np.full(len(starts), -1), np.full(len(starts), -1)
    tied = np.flatnonzero(ties)
    before[order[tied]] = order[tied - 1]  # ties stand in order of position: the left neighbour is the previous smaller position
    after[order[tied - 1]] = order[tied]
    return before, after


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Rows (h, chunk, chunks, k1, k2, s, seg, rep) in blocks of about BLOCK bytes that never part a (h, chunk)."""
    rows, size, now = [], 0, None
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("h", "chunk", "chunks", "k1", "k2", "s", "seg", "only"))):
            if size >= BLOCK and r[:2] != now:
                yield rows
                rows, size = [], 0
            now = r[:2]
            rows.append(r)
            size += len(r[6])
    if rows:
        yield rows


def _compare_blocks(least: int):
    """Per block: runs of repeated windows (k1, k2, s, n); of chunked anchors also the first copy of every window: w1, w2, and whether it is still undecided."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = "k1 k2 s n w1 w2"
        for rows in _blocks(batches):
            sizes = np.array([len(r[6]) for r in rows])
            data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
            begins = np.cumsum(sizes) - sizes
            many = sizes - least + 1
            owner = np.repeat(np.arange(len(rows)), many)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            starts = begins[owner] + inner
            before, after = previous_factors(data, starts, least)
            k1, k2, s = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5))
            only = np.array([r[7] for r in rows], bool)
            again = ((before >= 0) | (after >= 0)) & only[owner]  # others are settled as whole runs
            begin = np.flatnonzero(again & np.append(True, ~again[:-1] | (owner[1:] != owner[:-1])))
            end = np.flatnonzero(again & np.append(~again[1:] | (owner[1:] != owner[:-1]), True))
            if len(begin):
                own = owner[begin]
                yield _columns(names, k1[own], k2[own], s[own] + inner[begin], end - begin + 1, pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int64()))
            chunked = np.array([r[2] > 1 for r in rows], bool)
            first = np.flatnonzero(chunked[owner] & (before < 0))
            if len(first):
                hashed = Hashed(data)
                w1 = hashed.of(starts[first], starts[first] + least)
                w2 = mix(hashed.of(starts[first], starts[first] + least // 2) ^ mix(w1 * _ODD))
                own = owner[first]
                open_ = only[own] & (after[first] < 0)
                yield _columns(names, k1[own], k2[own], s[own] + inner[first], open_.astype(np.int64), w1.view(np.int64), w2.view(np.int64))

    return run


def repeated_runs(rows: DataFrame, least: int, gram: int) -> DataFrame:
    """k1, k2 (text), s, n: the n windows from s on are repeated. ``rows``: k1, k2, text."""
    twice = pin(_anchors(rows, least, gram).groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"))
    runs = pin(_runs(rows, least, gram).join(twice, "h", "left_semi"))
    kinds = pin(runs.groupBy("h", "e").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "s", "n")).alias("at")))
    settled = runs.join(kinds.where("c > 1").select("h", "e"), ["h", "e"], "left_semi").select("k1", "k2", "s", "n").distinct()
    mixed = pin(kinds.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"))
    firsts = pin(kinds.join(mixed, "h").select("h", "e", "m", "at.*", (F.col("c") == 1).alias("only")))
    segments = _segments(rows, least, gram, mixed).join(firsts.select("h", "e"), ["h", "e"], "left_semi").dropDuplicates(["h", "e"])
    chunks = F.ceil(F.col("m") / CHUNK).cast("bigint")
    blocks = (segments.join(firsts, ["h", "e"]).withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("e"), F.col("chunks")))
              .select("h", "chunk", "chunks", "k1", "k2", "s", "seg", "only").repartition("h", "chunk").sortWithinPartitions("h", "chunk"))
    compared = pin(blocks.mapInArrow(_compare_blocks(least), "k1 bigint, k2 bigint, s bigint, n bigint, w1 bigint, w2 bigint"))
    within = compared.where("w1 is null").select("k1", "k2", "s", "n")
    windows = compared.where("w1 is not null")
    across = pin(windows.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2"))
    between = windows.where("n = 1").join(across, ["w1", "w2"], "left_semi").select("k1", "k2", "s", "n")
    return settled.unionByName(within).unionByName(between)


def covered(n_bytes: int, starts: np.ndarray, many: np.ndarray, least: int) -> np.ndarray:
    """Mask of the bytes under the windows that start at ``starts`` .. ``starts + many - 1``."""
    step = np.zeros(n_bytes + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + many + least - 1, -1)
    return np.cumsum(step[:-1]) > 0


def _cut(least: int, carry: list[str], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column("text"), batch.column("runs")
            out = []
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode("utf-8", "surrogatepass")
                own = runs[i].values
                if own is None or not len(own):
                    gone, spans, kept = 0, np.zeros((0, 2), np.int64), raw
                else:
                    mask = covered(len(raw), own.field("s").to_numpy(), own.field("n").to_numpy(), least)
                    edge = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
                    spans = np.column_stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)])
                    gone, kept = int(mask.sum()), np.frombuffer(raw, np.uint8)[~mask].tobytes()
                out.append((len(raw), gone, spans.ravel(), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            n, gone, spans, digest, kept = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(digest, pa.string()),
                                              pa.array(kept, pa.binary())], names=[*carry, "n_bytes", "n_removed", "spans", "kept_sha256", "kept"])
    return run


def drop_repeats(docs: DataFrame, least: int = 200, gram: int = 48, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, spans (flat pairs of byte offsets, end exclusive, maximal), kept_sha256, kept (the remaining bytes)."""
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    runs = pin(repeated_runs(rows.select("k1", "k2", "text"), least, gram).groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "n")).alias("runs")))
    joined = rows.join(runs, ["k1", "k2"], "left").select("id", "text", "runs")
    kind = rows.schema["id"].dataType.simpleString()
    return (joined.mapInArrow(_cut(least, ["id"], with_text), f"id {kind}, n_bytes bigint, n_removed bigint, spans array<bigint>, kept_sha256 string, kept binary")
            .withColumnRenamed("id", id_col))
