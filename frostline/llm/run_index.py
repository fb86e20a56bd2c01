"""Long repeated byte strings by a run-length index, exact over the whole corpus.

Which bytes go: every byte covered by a string of LENGTH bytes that starts at another place too.

1. Every such window is filed under its anchor, the smallest hashed ANCHOR-byte string in it (the
   leftmost of equal ones). Neighbouring windows mostly share their anchor, so a text becomes a row
   per anchor: the segment that its windows cover. Equal windows have equal anchors at equal
   distance, so repeats meet under one anchor; anchors met once are done.
2. Of an anchor, segments equal as a whole are repeats throughout. Segments that differ
   are fetched, one of each kind, and dealt by anchor to tasks of bounded size.
3. A task writes its segments in one string and builds the index: suffix order, the run-length
   encoded Burrows-Wheeler transform, and the suffixes sampled at the ends of its runs. Common
   lengths with the neighbours in suffix order are worked out at run ends only; in text order each
   further position has one less than the position before it, which streams the matching statistics
   of all positions. Windows with a match of LENGTH bytes or more are repeats.
4. Spans are gathered by row and cut out of the text.

An anchor with more than HOT_SEGMENTS different segments would not fit a task. Its segments are cut
into fewer windows each and filed anew under the bytes that all windows of such a part have in
common: first 369 of the 400, then 397, then the whole window. Parts met once are done, so what is
left under one key shrinks to true repeats.

Defined results: texts are UTF-8 bytes, NULL is empty; matches never cross texts; texts shorter than
LENGTH keep everything. Equal rows are repeats of each other. Other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.llm.common import Stages, mix, row_key, slices, stack

LENGTH, ANCHOR = 400, 200
CHUNK = 1 << 20         # bytes that one step of a task hashes
BUCKET_BYTES = 1 << 20  # text of one index
HOT_SEGMENTS = 2000
WIDTHS = (32, 4, 1)       # windows of a part, where segments of an anchor are too many
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Prefix:
    """Hash of any part of a byte string from the sums of its prefixes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_BASE, n), dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        return mix((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _known.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + LENGTH + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _known[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from minima towards both ends of blocks of that width."""
    n = len(keys) - width + 1
    blocks = np.full(-(-len(keys) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts written one after the other: anchor hash, its place, first and last window start, segment hash."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.view(np.uint64), none, none, none, none.view(np.uint64)
    prefix = Prefix(data)
    grams = prefix.grams(ANCHOR)
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    place_mask = (np.uint64(1) << bits) - np.uint64(1)
    packed = (grams & ~place_mask) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_least(packed, LENGTH - ANCHOR + 1) & place_mask).astype(np.int64)
    start = np.arange(len(place))
    whole = np.zeros(len(data) + 1, bool)  # windows that lie in one text
    begin = np.r_[0, ends[:-1]]
    for a, b in zip(begin.tolist(), ends.tolist()):
        whole[a:max(a, b - LENGTH + 1)] = True
    start = start[whole[: len(start)]]
    if not len(start):
        return none.view(np.uint64), none, none, none, none.view(np.uint64)
    place = place[start]
    new = np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]
    first = start[new]
    last = np.r_[start[np.flatnonzero(new)[1:] - 1], start[-1]]
    place = place[new]
    segment = mix(prefix.of(first, last + LENGTH) ^ (place - first).astype(np.uint64) * np.uint64(_BASE))
    return grams[place], place, first, last, segment


def _parts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of neighbouring texts up to CHUNK, their ends, text numbers and offsets; a longer text in overlapping parts."""
    held, size = [], 0
    pieces = []
    for n, text in enumerate(texts):
        step = max(1, CHUNK)
        for at in range(0, max(1, len(text) - LENGTH + 1), step):
            pieces.append((n, at, text[at:at + step + LENGTH - 1]))
    for piece in pieces:
        if held and size + len(piece[2]) > CHUNK + LENGTH:
            yield _joined(held)
            held, size = [], 0
        held.append(piece)
        size += len(piece[2])
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(p[2] for p in held), np.uint8)
    return data, np.cumsum([len(p[2]) for p in held]), np.array([p[0] for p in held]), np.array([p[1] for p in held])


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = batch.column("row").to_numpy()
        for data, ends, text, offset in _parts(_utf8(batch.column("text"))):
            gram, place, first, last, segment = anchors(data, ends)
            piece = np.searchsorted(ends, first, "right")
            shift = offset[piece] - np.r_[0, ends[:-1]][piece]
            yield pa.RecordBatch.from_arrays([
                pa.array(gram.view(np.int64)), pa.array(segment.view(np.int64)), pa.array(rows[text[piece]]),
                pa.array((first + shift).astype(np.int64)), pa.array((last - first + 1).astype(np.int32)),
                pa.array((place - first).astype(np.int32))], ["anchor", "segment", "row", "first", "windows", "lead"])


ROW = "anchor bigint, segment bigint, row bigint, first bigint, windows int, lead int"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor and segment those whose anchor is met again, and whether their segment is (``equal``).

    ``leads`` marks the first row of each segment. Streams: only one row is held back between batches.
    """
    held: pa.RecordBatch | None = None
    before: tuple[int, int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        joined = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        out, before = _judge(joined, before, False)
        held = joined.slice(joined.num_rows - 1)
        yield out
    if held is not None:
        yield _judge(held, before, True)[0]


def _judge(batch: pa.RecordBatch, before: tuple[int, int] | None, end: bool) -> tuple[pa.RecordBatch, tuple[int, int]]:
    """All rows but the last (or all, at the end), judged by both neighbours."""
    anchor, segment = batch.column("anchor").to_numpy(), batch.column("segment").to_numpy()
    a = np.r_[before[0] if before else ~anchor[0], anchor]
    s = np.r_[before[1] if before else ~segment[0], segment]
    same_a, same_s = a[1:] == a[:-1], (a[1:] == a[:-1]) & (s[1:] == s[:-1])
    again, equal = same_a | np.r_[same_a[1:], False], same_s | np.r_[same_s[1:], False]
    n = len(anchor) if end else len(anchor) - 1
    keep = np.flatnonzero(again[:n])
    part = batch.take(pa.array(keep))
    out = pa.RecordBatch.from_arrays([*part.columns, pa.array(equal[keep]), pa.array(~same_s[keep])], [*batch.schema.names, "equal", "leads"])
    # what stands before the row held back is the last row judged
    return out, (int(anchor[n - 1]), int(segment[n - 1])) if n else before


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of symbols from 0 to 256, and the ranks by the first 7, 14, 28, ... symbols."""
    n = len(data)
    padded = np.concatenate([data.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key << 9 | padded[k:k + n]
    ranks, size = [], 7
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        ranks.append((size, rank))
        if rank[order[-1]] == n - 1 or size > n:
            return order, ranks
        follow = np.zeros(n, np.int64)
        follow[: max(0, n - size)] = rank[size:] + 1
        key = rank * (n + 1) + follow
        size *= 2


def common_length(data: np.ndarray, ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of suffixes, by descending ranks, the last few symbols one by one."""
    n, length = len(data), np.zeros(len(a), np.int64)
    for size, rank in reversed(ranks):
        x, y = a + length, b + length
        inside = np.maximum(x, y) + size <= n
        length[inside] += size * (rank[x[inside]] == rank[y[inside]])
    for _ in range(6):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < n
        same = np.zeros(len(a), bool)
        same[inside] = data[x[inside]] == data[y[inside]]
        stopped = ~same
        a, b = np.where(stopped, n, a), np.where(stopped, n, b)  # a mismatch stays one
        length += same
    return length


def matching_statistics(data: np.ndarray) -> np.ndarray:
    """For every position the longest match that starts there and somewhere else in ``data``."""
    n = len(data)
    order, ranks = suffix_order(data)
    # nothing stands before position 0: a symbol of its own, so that its run ends on both sides
    transform = np.where(order == 0, -1, data[order - 1])
    change = transform[1:] != transform[:-1]  # between suffix j and j + 1 a run of the transform ends
    out = np.zeros(n, np.int64)
    for above in (True, False):
        # sampled ends: the run's first suffix with the one above it, or its last with the one below
        ends = np.flatnonzero(change) + (1 if above else 0)
        other = ends - 1 if above else ends + 1
        value = np.full(n, -1, np.int64)
        value[order[ends]] = common_length(data, ranks, order[ends], order[other])
        value[order[0 if above else n - 1]] = 0
        known = np.maximum.accumulate(np.where(value >= 0, np.arange(n), 0))
        out = np.maximum(out, value[known] - (np.arange(n) - known))
    return out


def _index(group: pd.DataFrame) -> pd.DataFrame:
    """Spans of repeats in one bucket's segments."""
    group = group.sort_values(["segment", "row", "first"], ignore_index=True)
    parts = [np.frombuffer(b, np.uint8).astype(np.int16) + 1 for b in group["bytes"]]
    data = np.concatenate([x for p in parts for x in (p, np.zeros(1, np.int16))])
    begins = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    repeat = np.r_[False, matching_statistics(data) >= LENGTH, False]
    out = []
    for begin, row, first, windows in zip(begins.tolist(), group["row"], group["first"], group["windows"]):
        mine = np.r_[False, repeat[begin + 1:begin + 1 + windows], False]
        turns = np.flatnonzero(mine[1:] != mine[:-1])
        out += [(row, first + a, first + b - 1 + LENGTH) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]
    return pd.DataFrame(out, columns=["row", "begin", "end"]).astype("int64")


def _segment_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2_000_000):
        texts, lists = _utf8(batch.column("text")), batch.column("wanted")
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        wanted = lists.flatten()
        field = {n: wanted.field(n) for n in ("anchor", "segment", "first", "windows", "lead")}
        spans = zip(owner.tolist(), field["first"].to_pylist(), field["windows"].to_pylist())
        data = pa.array([texts[n][first:first + windows - 1 + LENGTH] for n, first, windows in spans], pa.binary())
        yield pa.RecordBatch.from_arrays([field["anchor"], field["segment"], batch.column("row").take(pa.array(owner)), field["first"], field["windows"],
                                          field["lead"], data], ["anchor", "segment", "row", "first", "windows", "lead", "bytes"])


def _parts_of(width: int):
    """Segments as parts of at most ``width`` windows, under a hash of what all windows of a part share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 500_000):
            out: list[tuple] = []
            for anchor, row, first, windows, lead, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "first", "windows", "lead", "bytes"))):
                at = 0
                while at < windows:
                    # windows whose distance to the anchor falls in one class of ``width`` distances
                    kind = (lead - at) // width
                    end = min(windows, lead - kind * width + 1)
                    core = data[lead - kind * width:lead - (kind + 1) * width + 1 + LENGTH]
                    part = data[at:end - 1 + LENGTH]
                    key = xxhash.xxh3_64_intdigest(core, seed=(anchor * 1024 + kind) & 0xFFFFFFFFFFFFFFFF)
                    out.append((key, xxhash.xxh3_64_intdigest(part, seed=lead - at), row, first + at, end - at, lead - at, part))
                    at = end
            anchor, segment, *rest = zip(*out)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([*(pa.array(np.array(c, np.uint64).view(np.int64)) for c in (anchor, segment)),
                                              *(pa.array(c, k) for c, k in zip(rest, kinds))], ["anchor", "segment", "row", "first", "windows", "lead", "bytes"])
    return run


def _meet(rows: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Spans of segments that are equal to another as a whole, and one row of each kind where an anchor has several."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    # a crowded anchor streams through its task
    met = rows.repartition("anchor").sortWithinPartitions("anchor", "segment").mapInArrow(_met, columns + ", equal boolean, leads boolean")
    met = stages.write(met, "met")
    whole = met.filter("equal").select("row", F.col("first").alias("begin"), (F.col("first") + F.col("windows") - 1 + LENGTH).alias("end"))
    kinds = stages.write(met.filter("leads").groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
    return whole, met.filter("leads").join(kinds, "anchor").drop("equal", "leads")


def repeated_spans(texts: DataFrame, stages: Stages, hot_segments: int = HOT_SEGMENTS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(row, begin, end) byte spans that go, of texts (row, text); spans may touch and overlap."""
    found = texts.filter("text is not null").mapInArrow(_anchor_rows, ROW)
    whole, differ = _meet(found, stages)
    wanted = differ.groupBy("row").agg(F.collect_list(F.struct("anchor", "segment", "first", "windows", "lead")).alias("wanted"))
    fetched = texts.join(wanted, "row").dropDuplicates(["row"]).select("row", "text", "wanted").mapInArrow(_segment_bytes, ROW + ", bytes binary")
    fetched = stages.write(fetched, "segments")
    kinds = fetched.groupBy("anchor").agg(F.count("*").alias("kinds"))
    spans, calm, rest = [whole], [], fetched.join(stages.write(kinds.filter(F.col("kinds") > hot_segments), "crowded"), "anchor", "left")
    for width in WIDTHS:
        calm.append(rest.filter(F.coalesce(F.col("kinds"), F.lit(0)) <= hot_segments).drop("kinds"))
        crowded = rest.filter(F.col("kinds") > hot_segments).drop("kinds")
        if crowded.isEmpty():
            break
        whole, differ = _meet(crowded.mapInArrow(_parts_of(width), ROW + ", bytes binary"), stages)
        spans.append(whole)
        rest = differ.select(*calm[0].columns, "kinds")
    indexed = stack(calm)
    size = indexed.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size // bucket_bytes))))
    spans.append(stages.write(indexed.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_index, "row bigint, begin bigint, end bigint"), "indexed"))
    return stack(spans)


def remove_repeats(documents: DataFrame, stages: Stages, **limits: int) -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256."""
    ours = ("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
    names = [c for c in documents.columns if c.lower() not in ours]
    at = next(n for n in names if n.lower() == "text")
    documents = documents.select(*[F.col(f"`{c}`") for c in names]).withColumn("_llm_row", row_key("doc_id", "text"))
    spans = repeated_spans(documents.select(F.col("_llm_row").alias("row"), "text"), stages, **limits)
    # begin and length in one number; texts hold less than 2^31 bytes
    packed = F.shiftleft("begin", 31) + F.col("end") - F.col("begin")
    by_row = spans.groupBy("row").agg(F.collect_list(packed).alias("_llm_spans")).withColumnRenamed("row", "_llm_row")
    joined = documents.join(by_row, "_llm_row", "left").drop("_llm_row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            out = []
            for data, marked in zip(_utf8(batch.column(at)), batch.column("_llm_spans")):
                spans = np.sort(marked.values.to_numpy()) if marked.is_valid else np.zeros(0, np.int64)
                begin = spans >> 31
                end = np.maximum.accumulate(begin + (spans & (1 << 31) - 1))
                new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]]) if len(spans) else np.zeros(0, np.int64)
                runs = zip(begin[new].tolist(), end[np.r_[new[1:], len(spans)] - 1].tolist()) if len(spans) else ()
                edges = [0, *(e for r in runs for e in r), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(data), len(data) - len(kept), len(new), kept, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*names, *ours])

    kinds = (T.LongType(), T.LongType(), T.LongType(), T.BinaryType(), T.StringType())
    return joined.mapInArrow(cut, T.StructType([*joined.schema.fields[:-1], *(T.StructField(n, k) for n, k in zip(ours, kinds))]))
