"""Alignment of two tokenizers over the bytes of every text, with corpus-wide counts of aligned id pairs.

Tokenizer A is a byte-level BPE, B a sentence-piece BPE with byte fallback; B adds a space in front, so
A gets one too. Where a token of A and a token of B end at the same byte, a group ends; every A token of
a group is linked with every B token of it. The count of an id pair is the number of documents that hold it linked.

Words are aligned once for each slice of a task, since no token reaches over a space.

1. The first pass aligns the documents; a task reports each pair once with the number of its documents,
   packed by chunk. A chunk holds all pairs of some A ids, so its size is bounded by the two vocabularies.
2. The distinct pairs of a chunk are united in a tree and get a minimal perfect hash: levels of bits in which a key
   keeps a place that no other key of the level wants, the rest go to the next level; its number is the
   rank of its bit. Keys are stored by number, so a lookup is verified.
3. Each branch of reports becomes a dense vector of counts indexed by that hash, and vectors are summed in a tree.
4. The second pass aligns the documents again and looks the counts up. The table of hashes, keys and counts
   goes to the tasks in parts of at most ``TABLE_BYTES``, measured before; usually there is one. With several, the documents
   are passed on to the next part in a staged table, and sums add up.

Defined results: a NULL or empty text, and one whose tokens do not spell a space and the text (as when it holds the
mark U+2581 itself), has no tokens: zeros and an empty string. Rows that are equal count as documents of their own. Ids need
not be unique. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import Stages, mix, slices

SLICE = 4_000_000
CHUNKS = 512
BRANCH = 32                      # reports or vectors that one step of a tree unites
HELD_PAIRS = 2_000_000           # pairs a task holds before it unites them
TABLE_BYTES = 64_000_000
CROWDED_LINKS = 4096             # links of a group beyond which its ids are counted before they are paired
LONG_RUN = 10_000                # white space in a row that the quicker library may not be able to read
RUN = re.compile(rf"\s{{{LONG_RUN}}}")
SPACE = "▁"
STEP = np.uint64(0x9E3779B97F4A7C15)

REPORT = "chunk int, node bigint, keys binary, counts binary"
HASHED = "chunk int, sizes array<bigint>, bits binary, keys binary"
VECTOR = "chunk int, node bigint, counts binary"
SCORED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


@cache
def byte_tokenizer(path: str, pattern: str):
    """The byte-level tokenizer and the byte length of every id."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


@cache
def patient_tokenizer(path: str):
    """The same byte-level tokenizer in a library that reads any run of white space."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return model


@cache
def piece_tokenizer(path: str):
    """The sentence-piece tokenizer, the bytes of every id, their lengths and the id of a lone space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        spelled.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(n) else piece.replace(SPACE, " ").encode())
    # pieces with a space behind another character would join words, which are encoded one by one
    if any(SPACE in model.id_to_piece(n).lstrip(SPACE) for n in range(model.get_piece_size())):
        raise ValueError("pieces of this model reach over words")
    return model, spelled, np.array([len(s) for s in spelled], np.int64)


class Tokenizers:
    """Paths of the two tokenizers' files, loaded where they are used. A's vocabulary comes as ranks and, for texts with
    very long runs of white space, as a tokenizer of the other library."""

    def __init__(self, bytes_path: str, pattern: str, whole_path: str, pieces_path: str):
        self.bytes_path, self.pattern, self.whole_path, self.pieces_path = bytes_path, pattern, whole_path, pieces_path

    @classmethod
    def public(cls, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k.model") -> Tokenizers:
        import public_tokenizers

        path = public_tokenizers.path
        return cls(path(f"{a}.tiktoken"), public_tokenizers.PATTERN, path(f"{a}.json"), path(b))

    def read_a(self, text: str) -> list[int]:
        if len(text) > LONG_RUN and RUN.search(text):
            return patient_tokenizer(self.whole_path).encode(text, add_special_tokens=False).ids
        return self.a[0].encode_ordinary(text)

    @property
    def a(self):
        return byte_tokenizer(self.bytes_path, self.pattern)

    @property
    def b(self):
        return piece_tokenizer(self.pieces_path)

    @property
    def width(self) -> int:
        """A pair (a, b) is the number a * width + b."""
        return len(self.b[1])


class Aligned:
    """Groups of some units of text: ids and group of each token of A and B, and the unit of each group."""

    def __init__(self, units: list[str], tokenizers: Tokenizers, words: int = 0):
        """The first ``words`` units hold no space, so A reads them as one text."""
        a_bytes = tokenizers.a[1]
        model, spelled, b_bytes = tokenizers.b
        pieces = model.encode(units, num_threads=1)
        b_counts = np.fromiter(map(len, pieces), np.int64, len(units))
        b = np.fromiter(chain.from_iterable(pieces), np.int64, int(b_counts.sum()))
        texts = pa.array(units, pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1
        # pieces spell the unit unless it holds the mark for a space itself
        self.right = np.ones(len(units), bool)
        if int(b_bytes[b].sum()) != int(sizes.sum()) or pc.any(pc.match_substring(texts, SPACE)).as_py():
            self.right = np.array([b"".join(spelled[i] for i in ids) == b" " + u.encode() for ids, u in zip(pieces, units)], bool)
            b, units, words = b[np.repeat(self.right, b_counts)], [u for u, r in zip(units, self.right) if r], int(self.right[:words].sum())
        of_unit, b_counts, sizes = np.flatnonzero(self.right), b_counts[self.right], sizes[self.right]
        read = [" " + " ".join(units[:words])] if words else []
        ids = [tokenizers.read_a(t) for t in [*read, *(" " + u for u in units[words:])]]
        a = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
        a_ends, b_ends = np.cumsum(a_bytes[a]), np.cumsum(b_bytes[b])
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, bool)
        marks[a_ends] = True
        both = marks[b_ends]  # both cover the same bytes, so every unit ends at a border
        marks[:] = False
        marks[b_ends[both]] = True
        at_border = marks[a_ends]
        self.a, self.b = a, b
        self.a_group, self.b_group = np.cumsum(at_border) - at_border, np.cumsum(both) - both
        self.groups = int(both.sum())
        self.unit = np.repeat(of_unit, b_counts)[both]
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=self.groups), np.bincount(self.b_group, minlength=self.groups)
        self.n_a, self.n_b = np.zeros(len(self.right), np.int64), np.zeros(len(self.right), np.int64)
        until = np.searchsorted(a_ends, np.cumsum(sizes), side="right")
        self.n_a[of_unit], self.n_b[of_unit] = np.diff(until, prepend=0), b_counts

    def per_unit(self, of_groups: np.ndarray) -> np.ndarray:
        return _sums(of_groups, self.unit, len(self.right))

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs as numbers, their group and how many links of the group they stand for; in the order of the groups."""
        crowded = self.a_in * self.b_in > CROWDED_LINKS
        a_group, a, a_times = _counted(self.a_group, self.a, crowded)
        b_group, b, b_times = _counted(self.b_group, self.b, crowded)
        b_in = np.bincount(b_group, minlength=self.groups)
        times = b_in[a_group]
        first = (np.cumsum(b_in) - b_in)[a_group]
        other = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(a, times) * width + b[other], np.repeat(a_group, times), np.repeat(a_times, times) * b_times[other]

    def spelled(self) -> np.ndarray:
        """Groups of each unit as ``a1,a2|b1;a3|b2,b3``."""
        last_a = np.r_[self.a_group[1:] != self.a_group[:-1], True][:len(self.a)]
        last_b = np.r_[self.b_group[1:] != self.b_group[:-1], True][:len(self.b)]
        out = np.empty(len(self.a) + len(self.b), object)
        at_a = np.arange(len(self.a)) + (np.cumsum(self.b_in) - self.b_in)[self.a_group]
        at_b = np.arange(len(self.b)) + np.cumsum(self.a_in)[self.b_group]
        top = int(max(self.a.max(initial=0), self.b.max(initial=0))) + 1
        inner, bar, end = (_numbers(top, mark) for mark in ",|;")
        out[at_a] = np.where(last_a, bar[self.a], inner[self.a])
        out[at_b] = np.where(last_b, end[self.b], inner[self.b])
        cuts, tokens = np.r_[0, np.cumsum(self.n_a + self.n_b)].tolist(), out.tolist()
        return np.array([*("".join(tokens[s:e])[:-1] for s, e in zip(cuts[:-1], cuts[1:])), None], object)[:-1]


def _sums(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Exact sums of whole numbers by their ascending owner."""
    sums = np.r_[0, np.cumsum(values)]
    first = np.searchsorted(owner, np.arange(owners + 1))
    return sums[first[1:]] - sums[first[:-1]]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]][:len(values)]]


class Texts:
    """Texts as units that no token of either tokenizer crosses, each distinct unit aligned once.

    Words between single spaces are such units: a space opens a token in both tokenizers, and neither looks over it.
    A text with runs of spaces or with a space at an end is a unit as a whole.
    """

    def __init__(self, texts: list[str | None], tokenizers: Tokenizers):
        plain = ["  " not in t and t[0] != " " and t[-1] != " " if t else True for t in texts]
        words = pc.split_pattern(pa.array([t or None if p else None for t, p in zip(texts, plain)], pa.large_string()), " ")
        per_text = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        units, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = len(units)
        whole = [n for n, p in enumerate(plain) if not p]
        if whole:
            ends = np.cumsum(per_text)
            codes = np.insert(codes, ends[whole], len(units) + np.arange(len(whole)))
            per_text[whole] = 1
            units += [texts[n] for n in whole]
        self.count, self.aligned = len(texts), Aligned(units, tokenizers, distinct)
        wrong = np.zeros(len(texts), bool)
        owner = np.repeat(np.arange(len(texts)), per_text)
        wrong[owner[~self.aligned.right[codes]]] = True  # such a text has no tokens at all
        kept = ~wrong[owner]
        self.codes, self.owner = codes[kept], owner[kept]

    def totals(self, of_units: np.ndarray) -> np.ndarray:
        return _sums(of_units[self.codes], self.owner, self.count)

    def pairs(self, width: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs, and in how many of the texts each is."""
        pairs, group, _ = self.aligned.links(width)
        unit, pair = np.divmod(_distinct(self.aligned.unit[group] * span + pairs), span)
        units = len(self.aligned.right)
        text, code = np.divmod(_distinct(self.owner * units + self.codes), max(1, units))
        first = np.searchsorted(unit, np.arange(units + 1))
        times = (first[1:] - first[:-1])[code]
        at = np.repeat(first[code] - np.cumsum(times) + times, times) + np.arange(times.sum())
        return np.unique(_distinct(np.repeat(text, times) * span + pair[at]) % span, return_counts=True)

    def spelled(self) -> list[str]:
        """Groups of each text; empty where it has no tokens."""
        words, cuts = self.aligned.spelled()[self.codes].tolist(), np.searchsorted(self.owner, np.arange(self.count + 1)).tolist()
        return [";".join(words[s:e]) for s, e in zip(cuts[:-1], cuts[1:])]


_number_words: dict[str, np.ndarray] = {}


def _numbers(top: int, mark: str) -> np.ndarray:
    known = _number_words.get(mark)
    if known is None or len(known) < top:
        known = _number_words[mark] = np.array([f"{n}{mark}" for n in range(top)], object)
    return known


def _counted(group: np.ndarray, ids: np.ndarray, crowded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens as (group, id, times); each id once in groups that are crowded."""
    once = np.ones(len(ids), np.int64)
    many = crowded[group]
    if not many.any():
        return group, ids, once
    pairs, times = np.unique(np.stack([group[many], ids[many]]), axis=1, return_counts=True)
    group, ids, times = np.r_[group[~many], pairs[0]], np.r_[ids[~many], pairs[1]], np.r_[once[~many], times]
    order = np.argsort(group, kind="stable")
    return group[order], ids[order], times[order]


def chunk_of(keys: np.ndarray, width: int) -> np.ndarray:
    return (mix((keys // width).astype(np.uint64) + STEP) % np.uint64(CHUNKS)).astype(np.int64)


def _unite(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, at, np.concatenate(counts))
    return every, sums


def _report(tokenizers: Tokenizers) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, node = tokenizers.width, TaskContext.get().partitionId()
        span = width * len(tokenizers.a[1])
        keys, counts, held, bounds = [], [], 0, 0
        for batch in slices(batches, "text", SLICE):
            some, times = Texts(batch.column("text").to_pylist(), tokenizers).pairs(width, span)
            keys.append(some)
            counts.append(times)
            held += len(some)
            if held > bounds + HELD_PAIRS:
                some, times = _unite(keys, counts)
                keys, counts, held, bounds = [some], [times], len(some), len(some)
        if not held:
            return
        some, times = _unite(keys, counts)
        chunk = chunk_of(some, width)
        order = np.argsort(chunk, kind="stable")
        some, times, chunk = some[order], times[order], chunk[order]
        cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(chunk)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([int(chunk[start])], pa.int32()), "node": pa.array([node], pa.int64()),
                "keys": pa.array([some[start:end].tobytes()], pa.binary()), "counts": pa.array([times[start:end].tobytes()], pa.binary())})

    return run


def _numbers_in(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v, np.int64) for v in column.to_pylist()]


def hash_levels(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct keys: bits of each level, the bits, and the keys in the order of their numbers."""
    sizes, bits, ordered = [], [], []
    while len(keys):
        size = max(64, 16 * (-(-len(keys) // 8)))
        place = _place(keys, len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        here = alone[place]
        ordered.append(keys[here][np.argsort(place[here])])
        sizes.append(size)
        bits.append(alone)
        keys = keys[~here]
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return sizes, np.packbits(join(bits, bool), bitorder="little"), join(ordered, np.int64)


def _place(keys: np.ndarray, level: int, size) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = mix(keys.astype(np.uint64) * STEP + np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03))
    return (mixed % np.asarray(size, np.uint64)).astype(np.int64)


class PairTable:
    """Minimal perfect hashes of some chunks side by side, with keys and counts by number."""

    def __init__(self, rows, width: int):
        rows = sorted(rows, key=lambda r: r.chunk)
        depth = max((len(r.sizes) for r in rows), default=0)
        self.width = width
        self.sizes, self.starts = np.zeros((CHUNKS, depth), np.int64), np.zeros((CHUNKS, depth), np.int64)
        at = 0
        for r in rows:
            own = np.array(r.sizes, np.int64)
            self.sizes[r.chunk, :len(own)] = own
            self.starts[r.chunk, :len(own)] = at + np.cumsum(own) - own
            at += int(own.sum())
        self.bits = np.concatenate([np.frombuffer(r.bits, np.uint8) for r in rows] or [np.zeros(0, np.uint8)])
        self.rank = np.r_[0, np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)]
        self.keys = np.concatenate([np.frombuffer(r.keys, np.int64) for r in rows] or [np.zeros(0, np.int64)])
        self.counts = None
        if rows and hasattr(rows[0], "counts"):
            self.counts = np.concatenate([np.frombuffer(r.counts, np.int64) for r in rows])
            top = np.zeros(int(self.keys.max() // width) + 1, np.int64)
            np.maximum.at(top, self.keys // width, self.counts)  # all pairs of an A id are in one chunk
            self.best = self.counts == top[self.keys // width]

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for keys that the table does not hold."""
        out = np.full(len(keys), -1, np.int64)
        chunk, left = chunk_of(keys, self.width), np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[chunk[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.starts[chunk[left], level] + _place(keys[left], level, size)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            found = (self.bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(self.bits[byte] & ((np.uint8(1) << bit) - np.uint8(1)))
            out[left[found]] = (self.rank[byte] + below)[found]
            left = left[~found]
        held = out >= 0
        out[held] = np.where(self.keys[out[held]] == keys[held], out[held], -1)
        return out


def _up(df: DataFrame, levels: int, merge: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Rows united in branches, ``levels`` times."""
    for _ in range(levels):
        df = df.withColumn("node", F.expr(f"node div {BRANCH}")).groupBy("chunk", "node").applyInArrow(merge, schema)
    return df


def _unite_keys(group: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate(_numbers_in(group.column("keys"))))
    return group.slice(0, 1).select(["chunk", "node"]).append_column("keys", pa.array([keys.tobytes()], pa.binary()))


def _sum_vectors(group: pa.Table) -> pa.Table:
    total = np.sum(_numbers_in(group.column("counts")), axis=0, dtype=np.int64)
    return group.slice(0, 1).select(["chunk", "node"]).append_column("counts", pa.array([total.tobytes()], pa.binary()))


def _hash_chunk(group: pa.Table) -> pa.Table:
    sizes, bits, keys = hash_levels(np.unique(np.concatenate(_numbers_in(group.column("keys")))))
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                     "bits": pa.array([bits.tobytes()], pa.binary()), "keys": pa.array([keys.tobytes()], pa.binary())})


def _densify(width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    class Row:
        def __init__(self, row: dict):
            self.__dict__.update(row)

    def run(reports: pa.Table, hashed: pa.Table) -> pa.Table:
        hashes = PairTable([Row(r) for r in hashed.select(["chunk", "sizes", "bits", "keys"]).to_pylist()], width)
        vector = np.zeros(len(hashes.keys), np.int64)
        for keys, counts in zip(_numbers_in(reports.column("keys")), _numbers_in(reports.column("counts"))):
            vector[hashes.number(keys)] += counts  # a report names a pair once
        return reports.slice(0, 1).select(["chunk", "node"]).append_column("counts", pa.array([vector.tobytes()], pa.binary()))

    return run


def pair_table(docs: DataFrame, tokenizers: Tokenizers, stages: Stages) -> DataFrame:
    """chunk, sizes, bits, keys and counts: minimal perfect hash, pairs by number and their documents, of every chunk."""
    reports = stages.write(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_report(tokenizers), REPORT), "reports")
    nodes = (reports.agg(F.max("node")).first()[0] or 0) + 1
    levels = 0
    while BRANCH ** (levels + 1) < nodes:
        levels += 1
    keys = _up(reports.select("chunk", "node", "keys"), levels, _unite_keys, "chunk int, node bigint, keys binary")
    hashed = stages.write(keys.groupBy("chunk").applyInArrow(_hash_chunk, HASHED), "hashed")
    branches = reports.withColumn("node", F.expr(f"node div {BRANCH}"))
    wanted = branches.select(F.col("chunk").alias("of"), F.col("node").alias("branch")).distinct()
    wanted = hashed.join(wanted, F.col("chunk") == F.col("of")).drop("of")
    vectors = branches.groupBy("chunk", "node").cogroup(wanted.groupBy("chunk", "branch")).applyInArrow(_densify(tokenizers.width), VECTOR)
    counts = _up(vectors, levels, _sum_vectors, VECTOR)
    table = stages.write(hashed.join(counts.select("chunk", "counts"), "chunk"), "pair-table")
    stages.drop(reports, hashed)
    return table


def _score(tokenizers: Tokenizers, shared, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        for batch in slices(batches, "text", SLICE):
            texts = Texts(batch.column("text").to_pylist(), tokenizers)
            aligned = texts.aligned
            keys, group, times = aligned.links(pairs.width)
            number = pairs.number(keys)
            held = number >= 0
            number, unit, times = number[held], aligned.unit[group[held]], times[held]
            counts, best = (pairs.counts, pairs.best) if len(pairs.keys) else (np.zeros(0, np.int64), np.zeros(0, bool))
            total = lambda values: texts.totals(_sums(values, unit, len(aligned.right)))
            n_best = total(times * best[number]) + batch.column("n_best").to_numpy(zero_copy_only=False)
            count_sum = total(times * counts[number]) + batch.column("count_sum").to_numpy(zero_copy_only=False)
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                                                 ["doc_id", "text", "n_best", "count_sum"])
                continue
            spelled = [hashlib.sha256(s.encode("ascii")).hexdigest() if s else "" for s in texts.spelled()]
            of_units = [aligned.n_a, aligned.n_b, aligned.per_unit(np.ones(aligned.groups, np.int64)), aligned.per_unit(aligned.a_in * aligned.b_in)]
            whole = [*map(texts.totals, of_units), n_best, count_sum]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in whole], pa.array(spelled, pa.string())],
                                             [c.split()[0] for c in SCORED.split(", ")])

    return run


def parts_of(table: DataFrame, limit: int) -> list[list[int]]:
    """Chunks in parts whose hashes, keys and counts stay below ``limit`` bytes together; a larger chunk is a part."""
    weight = F.octet_length("bits") + F.octet_length("keys") + F.octet_length("counts")
    parts, held = [[]], 0
    for chunk, size in sorted(tuple(r) for r in table.select("chunk", weight.cast("bigint")).collect()):
        if parts[-1] and held + size > limit:
            parts.append([])
            held = 0
        parts[-1].append(chunk)
        held += size
    return parts


def score(docs: DataFrame, table: DataFrame, tokenizers: Tokenizers, stages: Stages, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: tokens, groups, links, links whose count is the highest of their A id, sum of the links' counts, digest of the groups."""
    zero = F.lit(0).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), zero.alias("n_best"), zero.alias("count_sum"))
    parts = parts_of(table, table_bytes)
    for n, chunks in enumerate(parts):
        part = PairTable(table.filter(F.col("chunk").between(chunks[0], chunks[-1])).collect() if chunks else [], tokenizers.width)
        shared = stages.spark.sparkContext.broadcast(part)
        last = n == len(parts) - 1
        out = rows.mapInArrow(_score(tokenizers, shared, last), SCORED if last else "doc_id bigint, text string, n_best bigint, count_sum bigint")
        if last:
            return out
        before, rows = rows, stages.write(out, "partly-scored")
        stages.drop(before)
    raise AssertionError("there is always a part")


def spelled_groups(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """doc_id and the aligned groups of ids themselves, as ``a1,a2|b1;a3|b2,b3``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            groups = Texts(batch.column("text").to_pylist(), tokenizers).spelled()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(groups, pa.string())], ["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, groups string")


def align(docs: DataFrame, tokenizers: Tokenizers, stages: Stages) -> DataFrame:
    """Both passes over the documents."""
    return score(docs, pair_table(docs, tokenizers, stages), tokenizers, stages)
