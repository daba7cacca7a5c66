"""Jaccard similarity join on word n-grams with prefix filtering, and its connected components.

A document is the set of its distinct word n-grams (64-bit hashes). Documents of equal sets are one class (128-bit
fingerprint); only classes are compared.

1. One scan makes the fingerprints and counts all n-grams of the corpus in a table of fixed size; the counts
   define one total order, rare n-grams first.
2. The prefix of a set of n is its first n - ceil(t n) + 1 n-grams in that order: two sets of similarity t or more share one of them.
   Prefix n-grams of a single class are dropped; the others are joined on the n-gram.
3. Length filter: t n_a <= n_b. Positional filter: with c common n-grams in the prefixes, the set whose prefix ends first cannot share more than
   c and what follows its prefix. Suffix filter: the sets' counts by hash range bound the overlap before it is computed.
4. Each remaining pair is verified once, exactly. The components of the candidate pairs are dealt into cells of bounded size, and a cell
verifies its pairs by one product of its sets' incidence matrix, so a set is sent once and not once a pair; pairs
between two cells of a large component are verified singly, if their documents are not yet connected.

N-grams that stand in more than ``hot`` prefixes (large groups of near copies) would give pairs by the square. Their
documents are first compared in cells of their own: every document with its cell and with a set of pivots, in up to three of its hot n-grams.
Cells give links, never pairs; documents that are then connected need no comparison, and the pairs of hot n-grams
whose documents are still in different components go through steps 3 and 4 like all others. So no link between components is lost.

Defined results: a null or empty text, or one without words, has the empty set, links with nothing, and is its own component;
fewer words than n are one n-gram, the whole sequence; repeated rows are one class; a null id is
ignored when the smallest id of a group is taken (null where there is no other). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin, text_or_empty
from .components import Forest, connected
from .kernels import in_slices, mix, shingle_sets

#: Counters of the n-gram count table, and bits of the filter that spares sending unneeded sets.
COUNTERS, FILTER_BITS, TOKEN_BITS = 1 << 17, 1 << 23, 1 << 25
#: Documents and bytes of sets in a cell, documents of a cell of candidate components, and pivots of a hot n-gram.
CELL, CELL_BYTES, SMALL_CELL, PIVOTS = 2048, 1 << 24, 256, 64
_SIGN = np.uint64(1 << 63)


def _fingerprint(s: np.ndarray, salt: int) -> int:
    return int(mix(s ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0


def _sets(batch: pa.RecordBatch, size: int):
    """(id, set) of the rows of a batch."""
    texts = batch.column("text")
    ids = batch.column("id").to_pylist()
    rows = ((i, texts[k].as_py().encode("utf-8", "surrogatepass")) for k, i in enumerate(ids))
    for part in in_slices(rows, lambda r: len(r[1])):
        yield from zip((r[0] for r in part), shingle_sets([r[1] for r in part], size))


def _record(columns: list, types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])


def _sign(rows: DataFrame, size: int) -> DataFrame:
    """id, n, c1, c2 a document; one row a task with the task's n-gram counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(COUNTERS, np.int64), None
        types = lambda: [("id", kind), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("counts", pa.list_(pa.int64()))]
        for batch in batches:
            kind, out = batch.schema.field("id").type, []
            for i, s in _sets(batch, size):
                out.append((i, len(s), _fingerprint(s, 0x5851F42D4C957F2D), _fingerprint(s, 0x14057B7EF767814F), None))
                counts += np.bincount((s & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS) if len(s) > COUNTERS // 64 else 0
                if len(s) <= COUNTERS // 64:
                    np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
            if out:
                yield _record(list(zip(*out)), types())
        if kind is not None:
            yield _record([[None], [None], [None], [None], pa.ListArray.from_arrays([0, COUNTERS], counts)], types())

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n bigint, c1 bigint, c2 bigint, counts array<bigint>")


def _joined(*columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["token", "cid", "n", "last"])


def prefix_length(n, num: int, den: int):
    return n - (-(-num * n // den)) + 1


def _entries(rows: DataFrame, size: int, counts: np.ndarray, num: int, den: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Prefix n-grams: token, cid (class), n, last (order key of the last prefix n-gram); with a bit table, only those it holds."""
    shared = rows.sparkSession.sparkContext.broadcast((counts, wanted))  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, bits), seen = shared.value, set()
        for batch in batches:
            tokens, cids, ns, lasts, held = [], [], [], [], 0
            for _, s in _sets(batch, size):
                n, cid = len(s), _fingerprint(s, 0x5851F42D4C957F2D)
                if not n or cid in seen:
                    continue
                seen.add(cid)
                p = prefix_length(n, num, den)
                rarity = table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                order = np.lexsort((s, rarity))[:p]
                last = (min(int(rarity[order[-1]]), (1 << 31) - 1) << 32) | int(s[order[-1]] >> np.uint64(32))
                own = (s[order] ^ _SIGN).view(np.int64)
                if bits is not None:
                    at = own % TOKEN_BITS
                    own = own[(bits[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)]
                p = len(own)
                tokens.append(own)
                cids.append(np.full(p, cid, np.int64))
                ns.append(np.full(p, n, np.int64))
                lasts.append(np.full(p, last, np.int64))
                held += p
                if held >= 1 << 16:
                    yield _joined(tokens, cids, ns, lasts)
                    tokens, cids, ns, lasts, held = [], [], [], [], 0
            if tokens:
                yield _joined(tokens, cids, ns, lasts)

    return rows.mapInArrow(run, "token bigint, cid bigint, n bigint, last bigint")


def _wanted_filter(keys: DataFrame, key: str, size: int) -> np.ndarray:
    """A bit table of fixed size that holds all keys (and others)."""
    words = (keys.select(F.expr(f"pmod({key}, {size})").alias("bit")).select(F.expr("bit div 32").alias("w"), F.expr("shiftleft(1L, cast(bit % 32 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())  # at most size / 32 rows
    out = np.zeros(size // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _fetch_sets(rows: DataFrame, size: int, cids: DataFrame) -> DataFrame:
    """cid, set (sorted little-endian 64-bit hashes) of the classes in ``cids``."""
    shared = rows.sparkSession.sparkContext.broadcast(_wanted_filter(cids, "cid", FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            out, held = [], 0
            for _, s in _sets(batch, size):
                cid = _fingerprint(s, 0x5851F42D4C957F2D)
                at = cid % FILTER_BITS
                if not len(s) or cid in seen or not bits[at >> 5] >> (at & 31) & 1:
                    continue
                seen.add(cid)
                out.append((cid, s.astype("<u8").tobytes()))
                held += len(out[-1][1])
                if held > 1 << 22:
                    yield _record(list(zip(*out)), [("cid", pa.int64()), ("set", pa.binary())])
                    out, held = [], 0
            if out:
                yield _record(list(zip(*out)), [("cid", pa.int64()), ("set", pa.binary())])

    found = rows.mapInArrow(run, "cid bigint, set binary").join(cids.select("cid").distinct(), "cid", "left_semi")
    return found.dropDuplicates(["cid"])


def needed(na, nb, num: int, den: int):
    """The smallest overlap at which two sets reach the similarity."""
    return -(-num * (na + nb) // (num + den))


def _links(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    na, nb = len(a), len(b)
    if den * min(na, nb) < num * max(na, nb):
        return False
    least = needed(na, nb, num, den)
    edges = (np.arange(1, 64, dtype=np.uint64) << np.uint64(58))
    ha = np.diff(np.concatenate(([0], np.searchsorted(a, edges), [na])))
    hb = np.diff(np.concatenate(([0], np.searchsorted(b, edges), [nb])))
    if np.minimum(ha, hb).sum() < least:  # the suffix filter
        return False
    at = np.minimum(np.searchsorted(b, a), nb - 1)
    return int((b[at] == a).sum()) >= least


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = (batch.column(c) for c in ("a", "b", "sa", "sb"))
            hit = [i for i in range(batch.num_rows) if _links(np.frombuffer(sa[i].as_buffer(), "<u8"), np.frombuffer(sb[i].as_buffer(), "<u8"), num, den)]
            yield pa.RecordBatch.from_arrays([a.take(pa.array(hit, pa.int64())), b.take(pa.array(hit, pa.int64()))], names=["a", "b"])

    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("set").alias("sb")), "b"))
    return both.mapInArrow(run, "a bigint, b bigint")


def _cell_links(num: int, den: int):
    """Links within one cell, as a spanning forest: all pairs by one product of the cell's incidence matrix."""
    def run(cell: pa.Table) -> pa.Table:
        cids = cell.column("cid").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), "<u8") for c in cell.column("set").chunks for x in c]
        sizes = np.array([len(s) for s in sets])
        order = np.argsort(sizes, kind="stable")
        cids, sets, sizes = [cids[i] for i in order], [sets[i] for i in order], sizes[order]
        shared = np.zeros((len(sets), len(sets)), np.float32 if sizes[-1] < 1 << 24 else np.float64)
        parts = int(sizes.sum() >> 18) + 1
        edges = [0, *((1 << 64) * k // parts for k in range(1, parts))]
        cuts = [np.append(np.searchsorted(s, np.array(edges, np.uint64)), len(s)) for s in sets]
        for k in range(parts):  # ranges of hashes, so that a dense slice stays small
            own = [s[c[k]:c[k + 1]] for s, c in zip(sets, cuts)]
            values, column = np.unique(np.concatenate(own), return_inverse=True)
            row = np.repeat(np.arange(len(sets)), [len(o) for o in own])
            for at in range(0, len(values), 2048):
                here = (column >= at) & (column < at + 2048)
                dense = np.zeros((len(sets), min(2048, len(values) - at)), shared.dtype)
                dense[row[here], column[here] - at] = 1
                shared += dense @ dense.T
        linked = shared >= needed(sizes[:, None], sizes[None, :], num, den)
        forest = Forest()
        left = set(range(len(sets)))
        while left:  # breadth first over rows of the matrix
            todo = [left.pop()]
            while todo:
                i = todo.pop()
                for j in np.flatnonzero(linked[i]).tolist():
                    if j in left:
                        left.remove(j)
                        forest.join(cids[i], cids[j])
                        todo.append(j)
        out = [(x, forest.find(x)) for x in list(forest.up)]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    return run


def _pairs(entries: DataFrame, num: int, den: int, other: str) -> DataFrame:
    """Pairs of classes that share tokens and pass the length and positional filters. ``other``: the column that bounds how many
    common prefix n-grams these entries do not show."""
    a = entries.select("token", *[F.col(c).alias(f"{c}_a") for c in ("cid", "n", "last", "comp", "whole", other)])
    b = entries.select("token", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n", "last", "comp", "whole", other)])
    close = (F.col("cid_a") < F.col("cid_b")) & (den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b")) & (F.col("comp_a") != F.col("comp_b")) & ~F.arrays_overlap("whole_a", "whole_b")
    joined = a.join(b, "token").where(close)
    found = joined.groupBy("cid_a", "cid_b").agg(F.count("*").alias("c"), *[F.first(x).alias(x) for x in ("n_a", "n_b", "last_a", "last_b", f"{other}_a", f"{other}_b")])
    prefix = lambda n: F.expr(f"{n} - (({num} * {n} + {den - 1}) div {den}) + 1")
    most = F.col("c") + F.least(f"{other}_a", f"{other}_b")
    by_a, by_b = most + F.col("n_a") - prefix("n_a"), most + F.col("n_b") - prefix("n_b")
    bound = F.when(F.col("last_a") < F.col("last_b"), by_a).when(F.col("last_b") < F.col("last_a"), by_b).otherwise(F.greatest(by_a, by_b))
    least = F.expr(f"({num} * (n_a + n_b) + {num + den - 1}) div {num + den}")
    return found.where(bound >= least).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"))


def _dealt(cid: str, cells: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), F.col(cid)), F.col(cells))


def similar_groups(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, hot: int = 256,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id it reaches by links of Jaccard >= num / den)."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    signed = pin(_sign(rows, size))
    counts = np.zeros(COUNTERS, np.int64)
    sums = signed.where("counts is not null").select(F.posexplode("counts").alias("at", "k")).groupBy("at").agg(F.sum("k").alias("k")).toArrow()  # COUNTERS rows
    counts[sums.column("at").to_numpy()] = sums.column("k").to_numpy()
    signed = signed.where("counts is null").drop("counts")
    classes = pin(signed.where("n > 0").groupBy("c1", "c2", "n").agg(F.min("id").alias("first")))

    entries = _entries(rows, size, counts, num, den)
    several = pin(entries.groupBy("token").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo <> hi").select("token"))
    shared = _entries(rows, size, counts, num, den, _wanted_filter(several, "token", TOKEN_BITS))  # the table spares sending most n-grams of one class
    shared = pin(shared.join(several, "token", "left_semi").dropDuplicates(["token", "cid"]))
    cells = F.greatest(F.ceil(F.count("*") / CELL), F.ceil(F.sum("n") * 8 / CELL_BYTES)).cast("bigint")
    crowded = pin(shared.groupBy("token").agg(F.count("*").alias("m"), cells.alias("cells")).where(F.col("m") > hot))
    shared = shared.join(crowded, "token", "left")
    seen = pin(shared.groupBy("cid").agg(F.count("m").alias("hots"), F.count(F.when(F.col("m").isNull(), 1)).alias("colds"),
                                        F.slice(F.array_sort(F.collect_list(F.when(F.col("m").isNotNull(), F.struct("token", "m", "cells")))), 1, 3).alias("homes")))
    # Two documents with a home of one cell in common are compared there.
    whole = F.transform(F.filter("homes", lambda h: h["cells"] == 1), lambda h: h["token"])
    shared = pin(shared.join(seen.select("cid", "hots", "colds", whole.alias("whole")), "cid"))
    cold = shared.where("m is null").withColumn("comp", F.col("cid"))
    pairs = pin(_pairs(cold, num, den, "hots"))

    # Cells: the candidate components of the pairs, and the hot n-grams. Every set is sent to a few cells, not to every pair.
    drawn = pin(connected(pairs))
    sizes = pin(drawn.groupBy("component").agg(F.ceil(F.count("*") / SMALL_CELL).cast("bigint").alias("cells")))
    drawn = pin(drawn.join(sizes, "component").select(F.col("id").alias("cid"), F.col("component").alias("g"), _dealt("id", "cells").alias("cell")))
    busy = seen.where("hots > 0").select("cid", F.explode("homes").alias("h"))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("h.cells") - 1)
    pivot = F.pmod(F.xxhash64("cid"), F.greatest(F.ceil(F.col("h.m") / PIVOTS), F.lit(1))) == 0
    homes = busy.select("cid", F.col("h.token").alias("g"), F.explode(F.when(pivot, every).otherwise(F.array(_dealt("cid", "h.cells")))).alias("cell"))
    placed = pin(drawn.withColumn("kind", F.lit(0)).unionByName(homes.withColumn("kind", F.lit(1))))
    sets = pin(_fetch_sets(rows, size, placed.select("cid").distinct()))
    near = pin(placed.join(sets, "cid").groupBy("kind", "g", "cell").applyInArrow(_cell_links(num, den), "a bigint, b bigint"))

    # What cells could not decide: pairs of two chunks, and hot n-grams whose documents are still in different components.
    groups = pin(connected(near))
    dealt = lambda side: drawn.select(F.col("cid").alias(side), F.col("cell").alias(f"cell_{side}"))
    across = pairs.join(dealt("a"), "a").join(dealt("b"), "b").where("cell_a <> cell_b").select("a", "b")
    grouped = pin(shared.where("m is not null").join(groups.withColumnRenamed("id", "cid"), "cid", "left")
                  .withColumn("comp", F.coalesce("component", "cid")).drop("component"))
    mixed = pin(grouped.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token"))
    apart = _pairs(grouped.join(mixed, "token", "left_semi"), num, den, "colds")
    tagged = lambda side: groups.select(F.col("id").alias(side), F.col("component").alias(f"g{side}"))
    todo = (across.unionByName(apart).distinct().join(tagged("a"), "a", "left").join(tagged("b"), "b", "left")
            .where(~F.coalesce(F.col("ga") == F.col("gb"), F.lit(False))).select("a", "b"))
    edges = near.unionByName(_verified(pin(todo), sets, num, den))

    # From classes to the smallest ids: an edge of two classes links their smallest ids.
    found = pin(connected(edges))
    reached = found.join(classes.select(F.col("c1").alias("id"), "first"), "id")
    lowest = pin(reached.groupBy("component").agg(F.min("first").alias("component_id")))
    named = pin(found.join(lowest, "component").select(F.col("id").alias("c1"), "component_id"))
    ids = pin(classes.join(named, "c1", "left").select("c1", "c2", "n", F.coalesce("component_id", "first").alias("component_id")))
    return (signed.join(ids, ["c1", "c2", "n"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def drop_similar(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, hot: int = 256,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, nulls last, then of the smallest text hash. Rows are
    known by id and text hash, never by the id alone. Rows without words link with nothing and all stay."""
    text = text_or_empty(F.col(text_col))
    key = F.struct(F.col(id_col).isNull().alias("u"), F.col(id_col).alias("i"), F.unhex(F.sha2(text, 256)).alias("h"))
    groups = pin(similar_groups(docs.select(key.alias("__key"), text.alias("__text")), size, num, den, hot, "__key", "__text").where("n_shingles > 0"))
    first = F.col("component_id").eqNullSafe(F.col("__key"))
    gone = groups.where(~first).select("__key")
    repeated = pin(groups.where(first).groupBy("__key").agg(F.count("*").alias("n")).where("n > 1").select("__key"))
    rows = docs.select(F.struct("*").alias("__row"), key.alias("__key"))
    if repeated.isEmpty():
        return rows.join(gone, "__key", "left_anti").select("__row.*")
    once = rows.join(gone.unionByName(repeated), "__key", "left_anti")
    again = rows.join(repeated, "__key", "left_semi").dropDuplicates(["__key"])  # equal in id and text
    return once.unionByName(again).select("__row.*")
