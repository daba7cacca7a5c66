"""Merkle manifest of a data set: leaves, roots and membership proofs by a butterfly exchange.

Every row is a leaf. The leaves of a group, in ascending order of their key, are cut into aligned blocks of ``block`` leaves (a power of two),
one task's work each. A block hashes its own subtree and keeps each leaf's siblings inside it. Then the blocks exchange
subtree roots round by round: in round r the aligned groups of ``fanout`` ** (r + 1) blocks are formed, and blocks that differ only in
digit r (base ``fanout``) of their number meet, each with the root of its own subgroup. Each of them hashes all ancestors above these roots
itself and keeps those beside its path. After ceil(log_fanout(blocks)) rounds every block holds its group's root and all its upper siblings: nothing
travels down the tree, no block sees more than ``fanout`` roots a round, and the hashing above the blocks is done once by every block.
The roots of the groups are the leaves of one more such tree, whose root stands for the data set.

A node is the sha256 (lowercase hex) of its children's hex texts; the last child of a level without a partner has a parent of its own.

A group's last, incomplete subgroup lacks members for some digits of its neighbours; its members send their root there too, so every block meets all
subgroups of its group.

Positions come from a range shuffle and counts by task: a hot group or key is spread over tasks, rows equal in all parts by a seeded number.

Defined results: nulls in any column are hashed as ``-``; null groups and null keys come first; rows of one key are ordered by their leaf, so repeated rows
are leaves of their own; one leaf is its own root; an empty table gives an empty result. Columns not named are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import on_workers, pin, shuffle_partitions

HEX = 64


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(columns: Sequence[Column]) -> Column:
    """sha256 of the values in order, each ``-`` if null, else its UTF-8 byte count, ``:``, and the value."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the number of the row in its group by ``order`` (from 0, nulls first), and ``size``, the group's rows. No group gathers in one task."""
    spark, keys = rows.sparkSession, [group, *order, "_salt"]
    sorts = [F.col(k).asc_nulls_first() for k in keys]
    dealt = (rows.withColumn("_salt", F.rand(1)).repartitionByRange(shuffle_partitions(spark), *sorts).sortWithinPartitions(*sorts).drop("_salt")
             .withColumn("_row", F.monotonically_increasing_id()))
    kept = pin(dealt).withColumn("_task", F.shiftright("_row", 33))
    # What each task holds of each group: one row a task, and one more for every group that begins inside it.
    runs = pin(kept.groupBy("_task", F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")))
    sizes = runs.groupBy("_task").agg(F.sum("_n")).collect()  # one row a task, as many as the session has shuffle partitions
    before, offsets = 0, []
    for task, n in sorted(map(tuple, sizes)):
        offsets.append((task, before - (task << 33)))
        before += n
    if not offsets:
        return kept.select(*rows.columns, F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("size"))
    shift = F.broadcast(spark.createDataFrame(offsets, "_task bigint, _shift bigint"))
    runs = runs.join(shift, "_task")
    starts = runs.groupBy("_group").agg(F.min(F.col("_first") + F.col("_shift")).alias("_start"), F.sum("_n").alias("_size")).withColumnRenamed("_group", "_g")
    runs = pin(runs.join(starts, F.col("_group").eqNullSafe(F.col("_g"))).select(F.col("_task").alias("_t"), "_group", (F.col("_shift") - F.col("_start")).alias("_less"), "_size"))
    placed = kept.join(runs, (F.col("_task") == F.col("_t")) & F.col(group).eqNullSafe(F.col("_group")))
    return placed.select(*rows.columns, (F.col("_row") + F.col("_less")).alias("pos"), F.col("_size").alias("size"))


def climb(nodes: list[str], levels: int, path: int) -> tuple[list[str], str]:
    """The siblings of node ``path`` over ``levels`` levels of a tree over ``nodes`` ('' where it has none), and the node on its path then."""
    found = []
    for _ in range(levels):
        found.append(nodes[path ^ 1] if path ^ 1 < len(nodes) else "")
        nodes = [sha256_hex("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        path >>= 1
    return found, nodes[path]


def fold(leaf: str, pos: int, siblings: Sequence[str]) -> str:
    """The root that a leaf at ``pos`` gives with its siblings, lowest first ('' where a level has none)."""
    for level, other in enumerate(siblings):
        leaf = sha256_hex(other + leaf if pos >> level & 1 else leaf + other)
    return leaf


def joined(siblings: Sequence[str]) -> str:
    """Fixed width, a blank field where a level has no sibling."""
    return "".join(s.ljust(HEX) for s in siblings)


def parted(text: str) -> list[str]:
    return [text[i:i + HEX].rstrip() for i in range(0, len(text), HEX)]


def depth(n: int) -> int:
    """Levels above n nodes."""
    return max(0, n - 1).bit_length()


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _subtrees(leaves: DataFrame, block: int) -> DataFrame:
    """``leaves`` (grp, block, blocks, pos, leaf and others) with ``inner``, a leaf's siblings inside its block, and ``top``, the block's root."""
    low = block.bit_length() - 1

    def run(key, table):
        table = table.sort_by("pos")
        nodes, blocks = table.column("leaf").to_pylist(), table.column("blocks")[0].as_py()
        levels = low if blocks > 1 else depth(len(nodes))
        inner = [[] for _ in nodes]
        row = nodes
        for level in range(levels):
            for i in range(len(nodes)):
                other = i >> level ^ 1
                inner[i].append(row[other] if other < len(row) else "")
            row = [sha256_hex("".join(row[i:i + 2])) for i in range(0, len(row), 2)]
        return table.append_column("inner", pa.array([joined(x) for x in inner], pa.string())).append_column("top", pa.array([row[0]] * len(nodes), pa.string()))

    return leaves.groupBy("grp", "block").applyInArrow(run, _fields(leaves) + ", inner string, top string")


def butterfly(blocks: DataFrame, fanout: int, rounds: int) -> DataFrame:
    """``blocks``: grp, block, blocks (their number in the group), node (subtree root). Adds upper (siblings above the block) and root, after ``rounds`` exchanges."""
    bits = fanout.bit_length() - 1
    schema = "grp string, block bigint, blocks bigint, node string, upper string"
    held = blocks.withColumn("upper", F.lit(""))

    for r in range(rounds):
        span, digit = fanout ** r, F.expr(f"(block div {fanout ** r}) % {fanout}")
        own = F.expr(f"block % {span}")
        # members of the subgroup that lie in the data: less than span in the group's last, incomplete one
        size = F.expr(f"least({span}, blocks - (block div {span}) * {span})")
        sent = (held.withColumn("digit", digit).withColumn("own", own).withColumn("size", size)
                # who lacks a partner there: the places of the full subgroups beyond an incomplete one's size
                .withColumn("to", F.when(F.col("size") < span, F.expr(f"sequence(own, {span} - 1, size)")).otherwise(F.array("own")))
                .withColumn("to", F.explode("to")).withColumn("team", F.expr(f"block div {span * fanout}")))

        held = sent.groupBy("grp", "team", "to").applyInArrow(_meeting(r * bits, bits), schema)
    return held.withColumnRenamed("node", "root")


def _meeting(level: int, bits: int):
    """What the members of one team do with each other's roots, from ``level`` up."""
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def meet(key, table):
        rows, out = sorted(table.to_pylist(), key=lambda x: x["digit"]), []
        nodes, levels = [x["node"] for x in rows], max(0, min(bits, depth(rows[0]["blocks"]) - level))
        for x in rows:
            if x["own"] == x["to"]:  # others came to stand in for their subgroup
                beside, node = climb(nodes, levels, x["digit"])
                out.append((x["grp"], x["block"], x["blocks"], node, x["upper"] + joined(beside)))
        columns = zip(*out) if out else [[]] * len(types)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["grp", "block", "blocks", "node", "upper"])

    return meet


def _tree(leaves: DataFrame, block: int, fanout: int) -> tuple[DataFrame, DataFrame]:
    """``leaves``: grp, pos, size, leaf and others. Returns them with their siblings inside their blocks (inner), and the blocks: grp, block, upper
    (siblings above the block), root (of the group)."""
    placed = leaves.withColumn("block", F.expr(f"pos div {block}")).withColumn("blocks", F.expr(f"(size + {block - 1}) div {block}")).drop("size")
    inner = pin(_subtrees(placed, block))
    heads = inner.where(F.expr(f"pos % {block} = 0")).select("grp", "block", "blocks", F.col("top").alias("node"))  # a block's first row stands for it
    most, rounds = heads.agg(F.max("blocks")).first()[0] or 0, 0
    while fanout ** rounds < most:
        rounds += 1
    return inner.drop("blocks", "top"), pin(butterfly(heads, fanout, rounds).select("grp", "block", "upper", "root"))


def manifest(rows: DataFrame, block: int = 256, fanout: int = 16) -> DataFrame:
    """``rows``: doc_id, grp (string), leaf (hex); others ride along. Adds pos, subroot, root, siblings (of the whole path, through the group's root to the
    data set's: fixed-width hex fields, a blank one where a level has none), bend (levels below the subroot) and group_pos."""
    on_workers(rows.sparkSession)
    inner, blocks = _tree(positions(rows, "grp", ["doc_id", "leaf"]), block, fanout)
    subroots = blocks.where("block = 0").select(F.col("grp").alias("name"), F.col("root").alias("leaf"), F.lit(None).cast("string").alias("grp"))
    groups, tops = _tree(positions(subroots, "grp", ["name"]), block, fanout)
    tops = tops.select(F.col("block").alias("_b"), "upper", "root")
    groups = groups.join(tops, F.col("block") == F.col("_b")).select("name", F.col("pos").alias("group_pos"), F.concat("inner", "upper").alias("_above"), "root")
    groups = pin(groups)
    blocks = (blocks.withColumnRenamed("root", "subroot").join(groups, F.col("grp").eqNullSafe(F.col("name")))
              .select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "upper", "subroot", "group_pos", "_above", "root"))
    out = inner.join(blocks, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
    bend = ((F.length("inner") + F.length("upper")) / HEX).cast("int")
    return out.select(*rows.columns, "pos", "subroot", "root", "group_pos", bend.alias("bend"), F.concat("inner", "upper", "_above").alias("siblings"))


def proofs(found: DataFrame, claimed: str) -> DataFrame:
    """Adds proof_sha256 (of the siblings there are, lowest first) and folded_root (from the leaf in column ``claimed`` and the siblings)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, folded = [], []
            for text, leaf, pos, bend, group in zip(*(batch.column(c).to_pylist() for c in ("siblings", claimed, "pos", "bend", "group_pos"))):
                beside = parted(text)
                hashes.append(sha256_hex("".join(beside)))
                folded.append(fold(fold(leaf, pos, beside[:bend]), group, beside[bend:]))
            yield batch.append_column("proof_sha256", pa.array(hashes, pa.string())).append_column("folded_root", pa.array(folded, pa.string()))

    return found.mapInArrow(run, _fields(found) + ", proof_sha256 string, folded_root string")
