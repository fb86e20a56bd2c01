"""Sharding by a k-d tree over metadata.

A node is split across its widest dimension at the weighted median of its bytes (or at the share
of bytes that keeps the shards equal, when a node holds an odd number of them) until every leaf
holds one shard. Medians are exact: the bytes under each 16-bit digit of a dimension's key are
summed by Spark, and the digit that crosses the wanted share is followed down. The driver sees
one row per node and step.

A dimension's key is its value in the high 31 bits and a hash of the row in the low 32, so a
value that many rows share (one source with a third of all rows) is split like any other.

Defined results: NULL metadata sorts before all values; a NULL text has no bytes, so its row
weighs ROW_BYTES; an empty table gives no rows; equal rows may part, each row is placed once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import Stages, numbered

ROW_BYTES = 16
DIGIT = 16
SPAN = 1 << 31  # values of a dimension
KEY_BITS = 63
BLOCK_ROWS = 50_000


@dataclass
class Node:
    """A part of the shards, from ``first`` on; ``share`` of its ``weight`` go below the cut."""

    first: int
    shards: int
    weight: int
    widest: str = ""
    at: int = 0       # the digits of the cut found so far
    below: int = 0    # weight under those digits


def dimensions(documents: DataFrame) -> dict[str, F.Column]:
    """Dimension to value from 0 to SPAN - 1: length on a log scale, and the hash of language and source."""
    names = {c.lower(): c for c in documents.columns}
    dims = {"length": F.least(F.lit(SPAN - 1), (F.log2(F.octet_length("text") + 1) * (1 << 26)).cast("bigint"))}
    for name in ("lang", "source"):
        if name in names:
            dims[name] = F.shiftrightunsigned(F.crc32(F.col(f"`{names[name]}`").cast("string").cast("binary")), 1)
    return {d: F.coalesce(v, F.lit(0)) for d, v in dims.items()}


def kd_shards(documents: DataFrame, shards: int, stages: Stages) -> DataFrame:
    """doc_id, size, text_crc32 and ``shard`` (0 to shards - 1) of every row; sizes near equal."""
    text = F.coalesce(F.col("text"), F.lit(""))
    dims = dimensions(documents)
    base = documents.select(
        F.col("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns]), F.lit(1 << 32)).alias("_tie"),
        *[v.alias(f"_{d}") for d, v in dims.items()])
    keys = {d: f"key_{d}" for d in dims}
    rows = base.select("doc_id", "size", "text_crc32", F.lit(0).alias("node"),
                       *[(F.col(f"_{d}") * F.lit(1 << 32) + F.col("_tie")).alias(k) for d, k in keys.items()])
    rows = stages.write(rows, "metadata")
    total = rows.agg(F.sum("size")).first()[0]
    nodes = [Node(0, shards, total)] if total else []
    while any(n.shards > 1 for n in nodes):
        moved, nodes = _split(rows, nodes, keys)
        # the next level reads this one from files, not through a chain of joins
        before, rows = rows, stages.write(moved, "level")
        stages.drop(before)
    return rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"))


def _split(rows: DataFrame, nodes: list[Node], keys: dict[str, str]) -> tuple[DataFrame, list[Node]]:
    """One level: every node of more than one shard in two. A node is named by its first shard."""
    spark = rows.sparkSession
    open_nodes = {n.first: n for n in nodes if n.shards > 1}
    ours = rows.filter(F.col("node").isin(list(open_nodes)))
    # widest: spread of the values against the spread over all; below one value only the tie is left
    spread = [(F.shiftright(F.max(k), 32) - F.shiftright(F.min(k), 32)).alias(d) for d, k in keys.items()]
    scale = rows.agg(*spread).first()
    for r in ours.groupBy("node").agg(*spread).collect():  # one row per node
        open_nodes[r.node].widest = max(keys, key=lambda d: (r[d] / scale[d] if scale[d] else 0.0))
    key = F.coalesce(*[F.when(F.col("node").isin([n.first for n in open_nodes.values() if n.widest == d]), F.col(k)) for d, k in keys.items()
                       if any(n.widest == d for n in open_nodes.values())])
    ours = ours.select("node", key.alias("key"), "size")
    shift = KEY_BITS
    while shift > 0:
        last, shift = shift, max(0, shift - DIGIT)
        reached = spark.createDataFrame([(n.first, n.at, n.below, n.weight * (n.shards // 2) / n.shards) for n in open_nodes.values()],
                                        "node int, at bigint, below bigint, want double")
        # at most 2^DIGIT sums per node; the planner broadcasts the few rows of nodes
        inside = ours if last == KEY_BITS else ours.join(reached.select("node", "at"), "node").filter(F.shiftright("key", last) == F.col("at"))
        sums = inside.groupBy("node", F.shiftright("key", shift).alias("digit")).agg(F.sum("size").alias("size"))
        by_node = sums.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("digit", "size"))).alias("digits"))
        # the last digit whose weight below does not pass the wanted share by more than half its own weight
        below = F.aggregate("digits", F.struct(F.col("below").alias("run"), F.col("below").alias("under"), F.lit(-1).cast("bigint").alias("digit")),
                            lambda a, x: F.struct((a["run"] + x["size"]).alias("run"),
                                                  F.when(a["run"] <= F.col("want"), a["run"]).otherwise(a["under"]).alias("under"),
                                                  F.when(a["run"] <= F.col("want"), x["digit"]).otherwise(a["digit"]).alias("digit")))
        for r in by_node.join(reached, "node").select("node", below.alias("b")).collect():  # one row per node
            open_nodes[r.node].at, open_nodes[r.node].below = r.b.digit, r.b.under
    # rows with a key up to the cut go below; the row that crosses the share goes to the nearer side
    crossing = {r.node: r.size for r in ours.join(spark.createDataFrame([(n.first, n.at) for n in open_nodes.values()], "node int, key bigint"), ["node", "key"])
                .groupBy("node").agg(F.sum("size").alias("size")).collect()}
    upper, made = [], [n for n in nodes if n.shards == 1]
    for n in open_nodes.values():
        low, size = n.shards // 2, crossing[n.first]
        with_row = 2 * (n.weight * low / n.shards - n.below) >= size
        upper.append((n.first, n.widest, n.at if with_row else n.at - 1, n.first + low))
        weight = n.below + (size if with_row else 0)
        made += [Node(n.first, low, weight), Node(n.first + low, n.shards - low, n.weight - weight)]
    cuts = spark.createDataFrame(upper, "node int, widest string, cut bigint, above int")
    own = F.coalesce(*[F.when(F.col("widest") == d, F.col(k)) for d, k in keys.items()])
    moved = rows.join(F.broadcast(cuts), "node", "left")  # one row per shard at most
    return moved.select("doc_id", "size", "text_crc32", F.when(own > F.col("cut"), F.col("above")).otherwise(F.col("node")).cast("int").alias("node"),
                        *keys.values()), made


def with_slots(sharded: DataFrame) -> DataFrame:
    """``slot``: gapless from 0 within each shard; blocks of a shard are numbered apart."""
    rows = sharded.count()
    blocks = max(64, -(-rows // BLOCK_ROWS))
    return numbered(sharded, "shard", F.xxhash64("doc_id", "text_crc32", "size"), "slot", blocks)
