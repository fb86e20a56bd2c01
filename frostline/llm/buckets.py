"""Links inside candidate buckets, without pairing a bucket out.

A bucket's members are first checked against one of them, then against another. Members of one
bucket that are in different classes after that are brought together with what is needed to
compare them, in blocks of bounded size, and only links that join two classes leave the task.
Blocks of a bucket's largest class meet those of its other members only, not each other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import Stages, components, stack

ROUNDS = 2
BLOCK = 1000        # members of one side of a block
PACK_ROWS = 4000    # members that small blocks are gathered up to for one call
Compare = Callable[..., list[tuple[int, int]]]


def connect(members: DataFrame, loads: DataFrame, near: Callable[..., F.Column], compare: Compare,
            similarity: float, stages: Stages, rounds: int = ROUNDS, *, packed: bool = False) -> DataFrame:
    """Verified links (a, b) of ``node`` values that connect every class.

    members: key, node, size (a pair's sizes must be within ``similarity`` of each other; the key's
    other columns are handed on to ``compare``). loads: node and the columns that a check needs.
    near(a, b): condition on the structs of two loads. compare(group): links of one block, see ``_across``,
    or, if ``packed``, compare(group, starts): links of all blocks of a pack.
    """
    found: list[DataFrame] = []
    fits = lambda x, y: F.least(x, y) >= similarity * F.greatest(x, y)
    company = members.groupBy("key").agg(F.count("*").alias("n"))
    degree = members.join(company, "key").groupBy("node").agg(F.sum("n").alias("degree"))
    members = members.join(degree, "node")
    load = F.struct(*[c for c in loads.columns if c != "node"])
    for turn in range(rounds):
        # first the member with most company, which of a text and its variants is mostly the text; then any
        order = F.struct("degree", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)))
        lead = members.groupBy("key").agg(F.max_by(F.struct("node", "size"), order).alias("lead"))
        pairs = members.join(lead, "key").filter((F.col("node") != F.col("lead.node")) & fits(F.col("size"), F.col("lead.size")))
        pairs = stages.write(pairs.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct(), "pairs")
        both = (pairs.join(loads.select(F.col("node").alias("a"), load.alias("la")), "a")
                .join(loads.select(F.col("node").alias("b"), load.alias("lb")), "b"))
        found.append(stages.write(both.filter(near(F.col("la"), F.col("lb"))).select("a", "b"), "near"))
        stages.drop(pairs)
        classes = components(stack(found), stages)
        named = (members.drop("class").join(classes.select(F.col("node"), F.col("root").alias("class")), "node", "left")
                 .withColumn("class", F.coalesce("class", "node")))
        # a bucket of two has been decided
        apart = named.groupBy("key").agg(F.min("class").alias("c0"), F.max("class").alias("c1"), F.count("*").alias("n")).filter("c0 <> c1 and n > 2")
        before, members = members, stages.write(named.join(apart.select("key"), "key"), "apart")
        stages.drop(before)
        if members.isEmpty():
            return stack(found)
    found.append(stages.write(_across(members.drop("degree", "size"), loads, compare, packed), "near"))
    return stack(found)


def _across(members: DataFrame, loads: DataFrame, compare: Compare, packed: bool = False) -> DataFrame:
    """Blocks of a bucket, two at a time: key, node, class, own, low, high and the loads, in groups of (key, low, high).

    Where low and high differ only pairs with different ``own`` are to be compared.
    """
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = members.groupBy("key", "class").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("all"), F.max("n").alias("large"), F.max_by("class", F.struct("n", "class")).alias("largest"))
    # a bucket of several blocks: first those of the smaller classes, which meet all, then those of the largest, which meet the first
    sizes = sizes.select("key", F.when(F.col("all") > BLOCK, F.col("largest")).alias("largest"),
                         F.when(F.col("all") > BLOCK, blocks(F.col("all") - F.col("large"))).otherwise(1).alias("small"),
                         F.when(F.col("all") > BLOCK, blocks(F.col("large"))).otherwise(0).alias("more"))
    place, late = F.xxhash64("node", F.lit(9)), F.coalesce(F.col("class") == F.col("largest"), F.lit(False))
    own = F.when(late, F.col("small") + F.pmod(place, F.col("more"))).otherwise(F.pmod(place, F.col("small"))).cast("int")
    dealt = members.join(sizes, "key").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("small") + F.when(late, 0).otherwise(F.col("more")) - 1)))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("largest", "small", "more", "other")
    packs = max(1, dealt.count() // PACK_ROWS)
    pack = F.pmod(F.xxhash64("key", "low", "high"), F.lit(packs))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "low", "high", "node"])
        columns = {c: group[c].to_numpy() for c in group.columns if c != "pack"}
        block = np.stack([columns[c] for c in ("key", "low", "high")])
        cuts = np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0)) + 1
        if packed:
            return pd.DataFrame(compare(columns, np.r_[0, cuts]), columns=["a", "b"]).astype("int64")
        out: list[tuple[int, int]] = []
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(group)]):
            out += compare({c: v[start:end] for c, v in columns.items()})
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return dealt.join(loads, "node").withColumn("pack", pack).groupBy("pack").applyInPandas(run, "a bigint, b bigint")
