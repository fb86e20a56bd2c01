"""Merkle manifest of a table of documents, with a proof for every row by pointer jumping.

Leaves of a language ascend by ``doc_id`` and are numbered without gathering a language: a range
exchange sorts them, and a partition's place among the partitions of its language does the rest.
Runs of eight consecutive nodes become their digest, level by level, and the subroots of the
languages form a last tree of the same kind.

A *family* is a run and the node made of it. It holds its members' digests, which are the
siblings that a proof needs, and a pointer to the family its node is a member of. In every round
each family is joined with the family it points to: the digests of both are concatenated and the
pointer is taken over, so the distance doubles and all families reach the root after as many rounds
as the depth has binary digits. Leaves share the segments of their family; the own digest is left out when
a proof is read. A family that is pointed to from distance d has at most 8 ** d others below it, so rounds
up to distance 4 have no crowded key; later rounds join salted copies of the few families that are high enough.

Defined results: NULL in any column is written as ``-``; a NULL language is a tree of its own, the first;
NULL ids come first in their tree; rows equal in language and id are ordered by their digest, so that equal rows
are interchangeable; an empty table has no leaves and gives no rows. Other columns of the table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from frostline.llm.common import Stages, stack

FAN = 8
TOP = "2"          # the tree of subroots; trees of languages are "0" (NULL) and "1" + language
CROWD = 4          # a round that jumps further than this salts its keys
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<kids:array<binary>,alone:boolean,place:int>>"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(**replaced: Column) -> Column:
    """Digest of a row: every field as ``-`` if NULL, else byte count, colon and value."""
    def field(name: str) -> Column:
        value = replaced.get(name, F.col(f"`{name}`").cast("string"))
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return _digest(F.concat(*[field(name) for name in FIELDS]))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf and changed: the digest of the row as it is and, for every third row, with A-Z of the text in lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    changed = leaf_digest(text=F.translate(F.col("text").cast("string"), UPPER, LOWER))
    tree = F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0"))
    return docs.select(tree.alias("tree"), "doc_id", leaf_digest().alias("leaf"), F.when(tampered, changed).alias("changed"))


def placed(rows: DataFrame, order: list[str], stages: Stages) -> DataFrame:
    """``at``, the gapless place of a row in its tree from 0, and ``n``, the rows of its tree."""
    keys = ["tree", *order, "_salt"]  # equal rows may fall into different partitions
    sorted_rows = (rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .drop("_salt").withColumn("_mark", F.monotonically_increasing_id()))
    kept = stages.write(sorted_rows, "placed").withColumn("_part", F.shiftright("_mark", 33))
    parts = kept.groupBy("tree", "_part").agg(F.min("_mark").alias("_first"), F.count("*").alias("_rows"))
    before = W.partitionBy("tree").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_rows").over(W.partitionBy("tree")).alias("n"))
    parts = stages.write(parts, "parts")
    return kept.join(parts, ["tree", "_part"]).withColumn("at", F.col("_mark") + F.col("_shift")).drop("_mark", "_part", "_shift")


def _families(nodes: DataFrame, level: int, extra: list[str]) -> DataFrame:
    """Runs of eight nodes: tree, level, at, n, members, kids, alone, height, hash. A lone leaf is its own subroot."""
    member = F.struct("at", "hash", "height", *extra)
    runs = nodes.groupBy("tree", "n", F.expr(f"at div {FAN}").alias("up")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    kids = F.transform("members", lambda m: m["hash"])
    alone = (F.col("n") == 1) & F.lit(level == 1)
    joined = F.concat_ws("", F.transform("kids", hex_of))
    return (runs.withColumn("kids", kids).withColumn("alone", alone)
            .select("tree", F.lit(level).alias("level"), F.col("up").alias("at"), F.ceil(F.col("n") / FAN).cast("bigint").alias("n"), "members", "kids",
                    "alone", (F.array_max(F.transform("members", lambda m: m["height"])) + 1).alias("height"),
                    F.when(F.col("alone"), F.col("kids")[0]).otherwise(_digest(joined)).alias("hash")))


def _grow(nodes: DataFrame, stages: Stages, extra: list[str]) -> tuple[DataFrame, list[DataFrame]]:
    """All families of the trees, level by level; the first level keeps its members."""
    levels = [stages.write(_families(nodes, 1, extra), "families-1")]
    depth = levels[0].agg(F.max("n")).first()[0] or 1
    while depth > 1:
        level = len(levels) + 1
        above = _families(levels[-1].filter("n > 1"), level, []).drop("members")
        levels.append(stages.write(above, f"families-{level}"))
        depth = -(-depth // FAN)
    return stack([f.select("tree", "level", "at", "n", "kids", "alone", "height", "hash") for f in levels]), levels


def paths(families: DataFrame, subroots: DataFrame, above: DataFrame, stages: Stages) -> DataFrame:
    """tree, level, at and path of every family: the families from its own to the root, each with its node's place in the next."""
    step = lambda place: F.array(F.struct("kids", "alone", place.cast("int").alias("place"))).cast(PATH).alias("path")
    key = ["tree", "level", "at", "height"]
    inner = families.filter("n > 1").select(*key, step(F.col("at") % FAN), F.col("tree").alias("up_tree"),
                                            (F.col("level") + 1).alias("up_level"), F.expr(f"at div {FAN}").alias("up_at"))
    tops = families.filter("n = 1").join(subroots.select("lang_tree", F.col("at").alias("rank")), F.col("tree") == F.col("lang_tree"))
    tops = tops.select(*key, step(F.col("rank") % FAN), F.lit(TOP).alias("up_tree"), F.lit(1).alias("up_level"), F.expr(f"rank div {FAN}").alias("up_at"))
    last = above.filter("n = 1").select(*key, step(F.lit(0)), F.lit(None).cast("string").alias("up_tree"), F.lit(None).cast("int").alias("up_level"),
                                        F.lit(None).cast("bigint").alias("up_at"))
    upper = above.filter("n > 1").select(*inner.columns[:4], step(F.col("at") % FAN), F.col("tree").alias("up_tree"),
                                         (F.col("level") + 1).alias("up_level"), F.expr(f"at div {FAN}").alias("up_at"))
    nodes, distance = stages.write(stack([inner, tops, upper, last]), "pointers"), 1
    while not nodes.filter("up_tree is not null").isEmpty():
        copies = FAN ** max(0, distance - CROWD)
        target = nodes.filter(F.col("height") > distance).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        target = target.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("at").alias("up_at"), "salt",
                               F.col("path").alias("further"), F.struct("up_tree", "up_level", "up_at").alias("next"))
        moving = nodes.filter("up_tree is not null").withColumn("salt", F.pmod("at", F.lit(copies)).cast("int"))
        moved = moving.join(target, ["up_tree", "up_level", "up_at", "salt"]).select(
            *key, F.concat("path", "further").alias("path"), "next.up_tree", "next.up_level", "next.up_at")
        before, nodes = nodes, stages.write(moved.unionByName(nodes.filter("up_tree is null")), f"jump-{distance}")
        stages.drop(before)
        distance *= 2
    return nodes.select("tree", "level", "at", "path")


def folded(start: Column, steps: Column) -> Column:
    """Root, in hex, from a leaf's digest and its steps (kids, alone, place): at each, the run with the own digest put in its place."""
    return F.aggregate(steps, hex_of(start), lambda acc, s: F.when(s["alone"], acc).otherwise(F.sha2(
        F.concat_ws("", F.transform(s["kids"], lambda k, i: F.when(i == s["place"], acc).otherwise(hex_of(k)))), 256)))


def manifest(docs: DataFrame, stages: Stages) -> DataFrame:
    """doc_id, leaf, changed, subroot and root (binary digests), steps: the runs from the leaf's own to the root's, with the own place in each."""
    # digests are staged, for the range exchange reads its input twice
    rows = placed(stages.write(leaves(docs), "leaves"), ["doc_id", "leaf"], stages)
    rows = rows.withColumn("hash", F.col("leaf")).withColumn("height", F.lit(0))
    families, levels = _grow(rows, stages, ["doc_id", "changed"])
    roots = families.filter("n = 1").select(F.lit(TOP).alias("tree"), F.col("tree").alias("lang_tree"), "hash", "height")
    roots = stages.write(placed(roots, ["lang_tree"], stages), "subroots")
    above, _ = _grow(roots, stages, [])
    found = paths(families, roots, above, stages).filter((F.col("level") == 1) & (F.col("tree") != TOP)).select("tree", "at", "path")
    whole = levels[0].select("tree", "at", "members").join(found, ["tree", "at"])
    whole = whole.join(roots.select(F.col("lang_tree").alias("tree"), F.col("hash").alias("subroot")), "tree")
    each = whole.select(F.posexplode("members").alias("pos", "m"), "path", "subroot")
    steps = F.transform("path", lambda e, i: F.struct(e["kids"].alias("kids"), e["alone"].alias("alone"),
                                                      F.when(i == 0, F.col("pos")).otherwise(F.get(F.col("path"), i - 1)["place"]).alias("place")))
    root = F.element_at("path", -1)
    root = F.when(root["alone"], root["kids"][0]).otherwise(_digest(F.concat_ws("", F.transform(root["kids"], hex_of))))
    return each.select(F.col("m.doc_id").alias("doc_id"), F.col("m.hash").alias("leaf"), F.col("m.changed").alias("changed"), "subroot",
                       root.alias("root"), steps.alias("steps"))


def siblings(steps: Column) -> Column:
    """The proof: the others of each run, in order, level by level."""
    return F.flatten(F.transform(steps, lambda s: F.filter(s["kids"], lambda k, i: i != s["place"])))


def proofs(docs: DataFrame, stages: Stages) -> DataFrame:
    """One row per document with its proof's digest and the root that the (tampered) row folds to."""
    found = manifest(docs, stages).select(
        "doc_id", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), hex_of(F.col("root")).alias("root"),
        F.sha2(F.concat_ws("", F.transform(siblings(F.col("steps")), hex_of)), 256).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("steps")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
