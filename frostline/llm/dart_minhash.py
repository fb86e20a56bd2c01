"""Near-duplicate documents by DartMinHash signatures over weighted word shingles.

A document is the multiset of its five-word shingles, the weight of a shingle its count. Darts
are thrown by hash into the plane of weight and rank of every shingle, one on average per unit
of each; a document has the darts below its shingles' weights, and only those up to a rank that
leaves it about k ln k + 2k of them are ever looked at, however long it is. Each dart falls on
one of k coordinates; the earliest dart of each is the signature. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity.

Coordinates are banded; documents that share a band are candidates, checked by their exact
weighted Jaccard similarity. A bucket of candidates is never paired out: its members are checked
against one of them, twice with another choice, and only members that this leaves in different
classes are compared with each other.

Defined results: words are runs of white-space-free text without signs, lower case. A text of one
to four words is a single shingle; texts without words are in one class if equal; a NULL text is
its own class. Equal rows share a class, one of them is the keeper. Columns are kept; class_id is the smallest doc_id of
the class (NULL if it has none).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.buckets import connect
from frostline.llm.common import Stages, components, mix, row_key, slices, with_turn, word_codes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5  # two texts at the threshold share a band with probability 0.9996
_SIGNS = re.compile(r"[\W_]+")
_STEP, _CELL, _PLACE = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def normal_word(word: str) -> str:
    return word.lower() if word.isalnum() else _SIGNS.sub("", word.lower())


def shingles(words: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every five-word window; a shorter text is one window."""
    if not len(words):
        return words, owner
    size = np.minimum(counts, SHINGLE)[owner]
    start = np.cumsum(counts) - counts
    first = np.arange(len(words)) - start[owner] <= counts[owner] - size  # a whole window begins here
    value = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        shifted = np.zeros_like(words)
        shifted[: max(0, len(words) - k)] = words[k:]
        value = np.where(k < size, mix(value + _STEP) ^ shifted, value)
    return mix(value[first]), owner[first]


def weighted(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with the count as weight."""
    if not len(value):
        return value, owner, np.zeros(0)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(new)
    return value[at], owner[at], np.diff(np.r_[at, len(value)]).astype(float)


def darts(value: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """Signatures (texts, k): rank and mark of the earliest dart of each coordinate; texts without elements all ones.

    The area of an element is cut into cells of weight one; in a cell darts follow each other along
    the rank at exponential steps, each at a random height. Where a coordinate stays empty the text
    is thrown again up to twice the rank, which leaves earlier darts as they were.
    """
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    signature = np.full(texts * k, empty, np.uint64)
    total = np.bincount(owner, weights=weight, minlength=texts)
    limit = np.where(total > 0, (k * math.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    cells = np.ceil(weight).astype(np.int64)
    while todo.any():
        use = todo[owner]
        reps = cells[use]
        cell = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
        seed = mix(np.repeat(value[use], reps) + cell.astype(np.uint64) * _CELL)
        mine, height = np.repeat(owner[use], reps), np.repeat(weight[use], reps) - cell
        rank = np.zeros(len(seed))
        while len(seed):
            seed = mix(seed + _STEP)
            rank = rank - np.log(((seed >> np.uint64(11)).astype(float) + 1.0) / 9007199254740993.0)
            on = rank <= limit[mine]
            seed, rank, mine, height = seed[on], rank[on], mine[on], height[on]
            mark = mix(seed ^ _PLACE)
            # a dart above the element's weight (only in its last cell) is not the element's
            hit = (mark >> np.uint64(40)).astype(float) / (1 << 24) < height
            packed = (rank[hit].astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (mark[hit] & np.uint64(0xFFFFFFFF))
            np.minimum.at(signature, mine[hit] * k + (mix(mark[hit] ^ _CELL) % np.uint64(k)).astype(np.int64), packed)
        gaps = (signature.reshape(texts, k) == empty).any(axis=1)
        todo = todo & gaps
        limit = np.where(todo, 2 * limit, limit)
    return signature.reshape(texts, k)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    for r in range(rows):
        key = mix(key * _STEP ^ signature[:, r:bands * rows:rows])
    return key


def units(value: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every shingle as many times as it counts, told apart: plain Jaccard of these is weighted Jaccard."""
    reps = weight.astype(np.int64)
    nth = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
    return mix(np.repeat(value, reps) + nth.astype(np.uint64) * _PLACE), np.repeat(owner, reps)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, content (hash of the words in order), size and band keys of each row."""
    for batch in slices(batches, "text"):
        texts = batch.column("text")
        words, owner, counts = word_codes(texts, normal_word)
        n = len(counts)
        place = np.arange(len(words)) - (np.cumsum(counts) - counts)[owner]
        content = np.zeros(n, np.uint64)
        np.add.at(content, owner, mix(words + place.astype(np.uint64) * _STEP))
        content = mix(content + counts.astype(np.uint64))
        value, of, weight = weighted(*shingles(words, owner, counts))
        keys = _signed(np.ascontiguousarray(band_keys(darts(value, of, weight, n, BANDS * ROWS))))
        size = np.bincount(of, weights=weight, minlength=n).astype(np.int64)
        bare = np.flatnonzero(counts == 0)
        null = np.zeros(n, bool)
        for i in bare.tolist():
            text = texts[i].as_py()
            null[i] = text is None
            content[i] = xxhash.xxh3_64_intdigest((text or "").encode(), seed=1)
        bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(_signed(content), mask=null),
                                          pa.array(size), bands], ["row", "doc_id", "content", "size", "bands"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words, owner, counts = word_codes(batch.column("text"), normal_word)
        unit, of = units(*weighted(*shingles(words, owner, counts)))
        offsets = np.r_[0, np.cumsum(np.bincount(of, minlength=len(counts)))].astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("content"), batch.column("bands"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(unit)))],
                                         ["node", "bands", "units"])


def near_duplicates(documents: DataFrame, stages: Stages, similarity: float = SIMILARITY) -> DataFrame:
    """The rows with class_id, class_rows (rows in the class) and keeper (one row of each class)."""
    names = [c for c in documents.columns if c.lower() not in ("class_id", "class_rows", "keeper")]
    documents = documents.select(*[F.col(f"`{c}`") for c in names])
    texts = documents.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stages.write(texts.mapInArrow(_sign, "row bigint, doc_id bigint, content bigint, size bigint, bands array<bigint>"), "signatures")
    nodes = (signed.filter("content is not null").groupBy("content")
             .agg(F.min_by(F.struct("row", "size", "bands"), "row").alias("s"), F.min("doc_id").alias("first")))
    nodes = stages.write(nodes.select("content", "first", "s.*"), "contents")
    members = nodes.filter("size > 0").select("content", "size", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("key"), "band", "content", "size")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = stages.write(members.join(shared, "key"), "candidates")
    wanted = nodes.select("row", "content", "bands").join(members.select("content").distinct(), "content")
    held = texts.select("row", "text").join(wanted, "row").dropDuplicates(["row"]).select("content", "bands", "text")
    held = held.mapInArrow(_units, "node bigint, bands array<bigint>, units array<bigint>")
    held = stages.write(held, "shingles")
    links = _links(members.select("key", "band", F.col("content").alias("node"), "size"), held, similarity, stages)
    classes = components(links, stages)
    rooted = nodes.select("content", "first").join(classes.select(F.col("node").alias("content"), "root"), "content", "left").withColumn("root", F.coalesce("root", "content"))
    rows = signed.filter("content is not null").groupBy("content").agg(F.count("*").alias("n"))
    of_class = rooted.join(rows, "content").groupBy("root").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_rows"),
                                                               F.min_by("content", F.struct(F.col("first").isNull(), "first", "content")).alias("best"))
    of_content = stages.write(rooted.select("content", "root").join(of_class, "root").select("content", "class_id", "class_rows", "best"), "classes")
    of_row = signed.select("row", "doc_id", "content").distinct().join(of_content, "content", "left")
    # the keeper is the row of the smallest id, of its smallest key where ids repeat; it is the first of equal rows
    first_row = of_row.filter("content = best").groupBy("content").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("kept_row"))
    of_row = of_row.join(first_row, "content", "left").select(
        "row", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_rows", F.lit(1)).alias("class_rows"),
        (F.col("content").isNull() | F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False))).alias("_llm_kept"))
    of_row = stages.write(of_row, "row-classes")
    stages.drop(held, members, nodes, signed)
    out = with_turn(documents.withColumn("_llm_row", row_key("doc_id", "text")), "_llm_row", "_llm_turn", stages).join(of_row.withColumnRenamed("row", "_llm_row"), "_llm_row")
    kept = F.col("_llm_kept") & ((F.col("_llm_turn") == 1) | F.col("text").isNull())
    return out.select(*[F.col(f"`{c}`") for c in names], "class_id", F.col("class_rows").cast("bigint"), kept.alias("keeper"))


def _links(members: DataFrame, held: DataFrame, similarity: float, stages: Stages) -> DataFrame:
    """Verified links that connect every class."""
    def near(a: F.Column, b: F.Column) -> F.Column:
        common = F.size(F.array_intersect(a["units"], b["units"]))
        return common / (F.size(a["units"]) + F.size(b["units"]) - common) >= similarity

    def compare(group: dict[str, np.ndarray]) -> list[tuple[int, int]]:
        band, crossing = int(group["band"][0]), bool(group["low"][0] != group["high"][0])
        node, own, classes = group["node"], group["own"], group["class"].copy()
        earlier = np.stack(list(group["bands"]))[:, :band]
        sets = [np.sort(u) for u in group["units"]]
        lengths = np.array([len(u) for u in sets])
        out = []
        for i in range(len(node) - 1):
            rest = np.arange(i + 1, len(node))
            ok = (classes[rest] != classes[i]) & (np.minimum(lengths[rest], lengths[i]) >= similarity * np.maximum(lengths[rest], lengths[i]))
            rest = rest[ok & (own[rest] != own[i])] if crossing else rest[ok]
            # a pair is compared in the first band that it shares
            rest = rest[~(earlier[rest] == earlier[i]).any(axis=1)] if band else rest
            for at in range(0, len(rest), 256):
                some = rest[at:at + 256]
                flat = np.concatenate([sets[j] for j in some])
                place = np.minimum(np.searchsorted(sets[i], flat), lengths[i] - 1)
                common = np.add.reduceat((sets[i][place] == flat).astype(np.int64), np.cumsum(lengths[some]) - lengths[some])
                for j in some[common / (lengths[i] + lengths[some] - common) >= similarity]:
                    if classes[j] != classes[i]:
                        out.append((node[i], node[j]))
                        classes[classes == classes[j]] = classes[i]
        return out

    return connect(members, held, near, compare, similarity, stages)
