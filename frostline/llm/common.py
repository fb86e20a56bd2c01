"""Shared helpers: reading, staging with removal, word codes, row blocks and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.session import new_folder

SLICE_BYTES = 4_000_000  # text bytes that one numpy step of a task holds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# removes a query's shuffle files when it ends; else they stay until the driver happens to collect its garbage
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stages:
    """Stages written to the shared folder; those no longer read are removed by ``drop``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._at: dict[int, str] = {}
        self._held: list[DataFrame] = []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = new_folder(self.spark, label)
        before = self.spark.conf.get(CLEANUP_CONF, None)
        self.spark.conf.set(CLEANUP_CONF, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP_CONF)
            else:
                self.spark.conf.set(CLEANUP_CONF, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._at[id(back)] = path
        self._held.append(back)
        return back

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self._at.pop(id(df), None)
            if path:
                self.remove(path)

    def remove(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def row_key(*columns: str) -> F.Column:
    """64-bit identity of a row's content; equal rows share it and get equal results."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for c in columns])


def with_turn(rows: DataFrame, key: str, turn: str, stages: Stages) -> DataFrame:
    """``turn``: 1, 2, ... among the rows of equal ``key``. Only keys that repeat are sorted; most rows are never moved."""
    from pyspark.sql import Window as W

    again = stages.write(rows.groupBy(key).agg(F.count("*").alias("_llm_again")).filter("_llm_again > 1"), "repeated-keys")
    if again.isEmpty():  # the usual table: no second reading of the rows
        return rows.withColumn(turn, F.lit(1))
    marked = rows.join(again, key, "left")
    order = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
    single = marked.filter("_llm_again is null").withColumn(turn, F.lit(1))
    several = marked.filter("_llm_again is not null").withColumn(turn, F.row_number().over(W.partitionBy(key).orderBy(order)))
    return single.unionByName(several).drop("_llm_again")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about ``limit`` bytes in ``column``; one long text is a part of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))
    # a worker lives on; what this task needed goes back
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


CACHED_WORDS = 300_000
_cache: dict[object, dict] = {}


def worker_cache(purpose: object) -> dict:
    """What a Python worker has looked up, across tasks; one purpose at a time, so that stages do not add up."""
    if purpose not in _cache:
        _cache.clear()
    known = _cache.setdefault(purpose, {})
    if len(known) > CACHED_WORDS:
        known.clear()
    return known


def word_hashes(words: list[str], normalise: Callable[[str], str]) -> np.ndarray:
    """Hash of each normalised word, 0 for those that normalise to nothing; words met before by the worker are looked up."""
    known = worker_cache(normalise)
    out = [known.get(w) for w in words]
    for n, value in enumerate(out):
        if value is None:
            word = normalise(words[n])
            out[n] = known[words[n]] = xxhash.xxh3_64_intdigest(word) if word else 0
    return np.array(out, np.uint64)


def word_codes(texts: pa.Array, normalise: Callable[[str], str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, the words' text number, and the number of words of each text.

    Texts are cut at white space; each distinct piece is normalised and hashed once. Pieces
    that normalise to nothing are no words.
    """
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    hashes = word_hashes(coded.dictionary.to_pylist(), normalise)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    values = hashes[codes] if len(hashes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    keep = values != 0
    values, owner = values[keep], owner[keep]
    return values, owner, np.bincount(owner, minlength=len(counts)).astype(np.int64)


def numbered(df: DataFrame, group: str, key: F.Column, at: str, blocks: int) -> DataFrame:
    """Gapless number ``at`` from 0 within each group, without gathering a group in one task.

    Rows are dealt to blocks of their group by ``key``; a row's number is the size of the
    blocks before its own plus its place there.
    """
    from pyspark.sql import Window as W

    dealt = df.withColumn("_block", F.pmod(key, F.lit(blocks)).cast("int")).withColumn("_key", key)
    sizes = dealt.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy(group, "_block").orderBy("_key"))
    return (dealt.withColumn("_place", place).join(sizes, [group, "_block"])
            .withColumn(at, F.col("_before") + F.col("_place") - 1)
            .drop("_block", "_key", "_place", "_before"))


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, from links (a, b) of longs.

    Alternates two contractions, each one aggregate: every node hands its larger, then its
    smaller neighbours to the smallest of them. A node's neighbours are never gathered: the
    smallest is an aggregate, joined back. Ends when the links form stars.
    """
    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges if not larger else edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(low, "a")
        if larger:
            out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return out.filter("a > b").distinct()

    edges = stages.write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .filter("a > b").distinct(), "links")
    size = None
    while True:
        contracted = stages.write(star(star(edges, True), False), "links")
        # the links are stars when contraction changes nothing
        now = contracted.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        stages.drop(edges)
        edges = contracted
        if now == size or not now[0]:
            break
        size = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
