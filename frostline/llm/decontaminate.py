"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

A benchmark item and every item-sized window of a document are sequences of words. The CGK random
walk writes such a sequence out as a longer one: at each step it writes the word it stands on and
a hash of word and step tells whether it goes on. Sequences at a small edit distance fall into
step again, so their written forms agree in most places; a few sampled places of them are
a hash key. With WALKS walks of SAMPLES samples each, a window within the distance shares a key
with probability over the target (``tests/llm`` measure it). What shares a key is verified by the
exact edit distance between the item and the best part of the document around the window.

Windows are tried only where the document can hold the item at all: an item with at most e word edits
keeps one of e + 1 pieces whole, so some run of words of the item is there, at most e words away
from its place. That bound loses nothing.

The benchmark is small data by nature; it is read in blocks of at most ``block_bytes``, each a pass over
the documents. No shuffle.

Defined results: words are lower case without signs; an item without words is never found; NULL
or empty texts hold nothing. Equal items are found each. Equal rows are reported each. An empty
benchmark or table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import mix, slices, word_codes
from frostline.llm.dart_minhash import normal_word

SIMILARITY = 0.8
WALKS, SAMPLES, PLACES = 6, 10, 2
PIECE = 4
SOME_BITS = 20  # leading bits of a hash that tell apart what no piece has
BLOCK_BYTES = 32 << 20
PAD = np.uint64(0)
_STEP, _WALK = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
HIT = "item_id bigint, start_word bigint, end_word bigint, distance bigint, similarity double"


def item_words(text: str | None) -> np.ndarray:
    words = [w for w in map(normal_word, (text or "").split()) if w]
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


def sampled_places(n: int) -> np.ndarray:
    """(WALKS, SAMPLES, PLACES) steps of the walk over ``n`` words, ascending; a walk stands on word j / 2 at step j."""
    return np.sort(np.random.default_rng(n).integers(0, max(1, 2 * n - 2), (WALKS, SAMPLES, PLACES)), axis=2)


def embed(windows: np.ndarray) -> np.ndarray:
    """Keys (windows, WALKS * SAMPLES) of rows of equal length."""
    rows, n = windows.shape
    padded = np.concatenate([windows, np.full((rows, 1), PAD, np.uint64)], axis=1)
    places = sampled_places(n)
    keys = np.zeros((rows, WALKS, SAMPLES), np.uint64)
    keys += np.arange(1, WALKS * SAMPLES + 1, dtype=np.uint64).reshape(WALKS, SAMPLES)
    every, at = np.arange(rows)[:, None], np.zeros((rows, WALKS), np.int64)
    # all walks go one step at a time; one that is past its last sample writes nothing more
    for step in range(int(places.max()) + 1):
        word = padded[every, np.minimum(at, n)]
        walk, sample = np.nonzero((places == step).any(axis=2))
        if len(walk):
            keys[:, walk, sample] = mix(keys[:, walk, sample] * _STEP ^ word[:, walk])
        turns = np.array([_WALK * (k * 4096 + step + 1) & 0xFFFFFFFFFFFFFFFF for k in range(WALKS)], np.uint64)
        at += (mix(word ^ turns) >> np.uint64(63)).astype(np.int64)
    return keys.reshape(rows, WALKS * SAMPLES)


def fit_distance(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edits that turn the item into some part of the text, and where that part ends (the first such)."""
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    place: dict[int, int] = defaultdict(int)
    for k, w in enumerate(item):
        place[w] |= 1 << k
    up, down, distance, best = full, 0, n, (n, 0)
    for k, w in enumerate(text, 1):
        same = place.get(w, 0)
        across = (((same & up) + up) ^ up) | same | down
        rise, fall = down | (~(across | up) & full), up & across
        distance += bool(rise & top) - bool(fall & top)
        # a part may start anywhere: the upper border stays 0
        rise, fall = rise << 1 & full, fall << 1 & full
        turned = same | down
        up, down = fall | (~(turned | rise) & full), rise & turned
        best = min(best, (distance, k))
    return best


class Items:
    """A block of benchmark items, by length and by the pieces that a document must hold."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float = SIMILARITY):
        self.ids, self.words, self.similarity = [], [], similarity
        for item_id, text in items:
            words = item_words(text)
            if len(words):
                self.ids.append(item_id)
                self.words.append(words)
        by_length: dict[int, list[int]] = defaultdict(list)
        pieces: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, words in enumerate(self.words):
            n = len(words)
            by_length[n].append(k)
            size = min(PIECE, n // (allowed(n, similarity) + 1))
            value = grams(words, size)
            pieces[size] += [(int(v), k, o) for o, v in enumerate(value)]
        self.keys = {n: (np.array(ks), embed(np.stack([self.words[k] for k in ks]))) for n, ks in by_length.items()}
        self.pieces = {}
        for size, rows in pieces.items():
            rows.sort()
            value = np.array([r[0] for r in rows], np.uint64)
            some = np.zeros(1 << SOME_BITS, bool)
            some[value >> np.uint64(64 - SOME_BITS)] = True
            self.pieces[size] = (value, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), some)
        self.lengths = np.array([len(w) for w in self.words])

    def windows(self, words: np.ndarray, owner: np.ndarray, first: np.ndarray) -> dict[int, np.ndarray]:
        """Window length to text number and start in ``words``, packed, of windows that hold a piece of an item of that length."""
        wanted: dict[int, list[np.ndarray]] = defaultdict(list)
        for size, (value, item, offset, some) in self.pieces.items():
            mine = grams(words, size)
            # most runs of words begin like no piece's hash: only the others are looked up
            at = np.flatnonzero(some[mine >> np.uint64(64 - SOME_BITS)])
            at = at[owner[at] == owner[at + size - 1]]
            low, high = np.searchsorted(value, mine[at], "left"), np.searchsorted(value, mine[at], "right")
            at, low, reps = at[high > low], low[high > low], (high - low)[high > low]
            row = np.repeat(low, reps) + np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
            begin, length = np.repeat(at, reps) - offset[row], self.lengths[item[row]]
            text = owner[np.repeat(at, reps)]
            for n in np.unique(length).tolist():
                slack = np.arange(-allowed(n, self.similarity), allowed(n, self.similarity) + 1)
                mine = length == n
                # a window that would begin before its text begins with it
                start = np.maximum(begin[mine][:, None] + slack[None, :], first[text[mine]][:, None])
                wanted[n].append((start + (text[mine][:, None] << np.int64(40))).ravel())
        return {n: np.unique(np.concatenate(marks)) for n, marks in wanted.items()}

    def find(self, words: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, first word, end word, distance) in a batch of texts."""
        end = np.cumsum(counts)
        first, out = end - counts, []
        seen: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for n, marks in self.windows(words, owner, first).items():
            text, start = marks >> np.int64(40), marks & np.int64((1 << 40) - 1)
            slack, (items, keys) = allowed(n, self.similarity), self.keys[n]
            for at in range(0, len(start), 8192):
                s, t = start[at:at + 8192], text[at:at + 8192]
                place = s[:, None] + np.arange(n)[None, :]
                cells = np.where(place < end[t][:, None], words[np.minimum(place, len(words) - 1)], PAD)
                hits = np.zeros((len(s), len(items)), bool)
                mine = embed(cells)
                for column in range(mine.shape[1]):
                    hits |= mine[:, column][:, None] == keys[:, column][None, :]
                for i, j in zip(*(x.tolist() for x in np.nonzero(hits))):
                    low, high = max(int(s[i]) - slack, int(first[t[i]])), min(int(s[i]) + n + slack, int(end[t[i]]))
                    pair = (int(t[i]), int(items[j]))
                    if any(a <= low + slack < b for a, b in seen[pair]):
                        continue
                    item = self.words[pair[1]].tolist()
                    distance, stop = fit_distance(item, words[low:high].tolist())
                    if distance <= slack:
                        back, length = fit_distance(item[::-1], words[low:low + stop][::-1].tolist())
                        a, b = low + stop - length, low + stop
                        seen[pair].append((a, b))
                        out.append((pair[0], pair[1], a - int(first[t[i]]), b - int(first[t[i]]), distance))
        return sorted(out)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = mix(value + _STEP) ^ words[k:k + n]
    return mix(value)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of bounded size."""
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(1, -(-size // block_bytes))
    for part in range(parts):
        rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        if parts > 1:
            rows = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r.item_id, r.text) for r in rows.collect()]


def contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per found item: doc_id, item_id, the words it covers, edit distance and similarity."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = pa.schema([("doc_id", pa.int64())] + [(c.split()[0], pa.float64() if "double" in c else pa.int64()) for c in HIT.split(", ")])

    def finder(rows: list[tuple[int, str]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(rows, similarity)
            for batch in slices(batches, "text"):
                found = items.find(*word_codes(batch.column("text"), normal_word))
                doc = batch.column("doc_id").to_pylist()
                columns = [[doc[t] for t, *_ in found], [items.ids[k] for _, k, *_ in found], [a for *_, a, _, _ in found], [b for *_, b, _ in found],
                           [d for *_, d in found], [1 - d / len(items.words[k]) for _, k, _, _, d in found]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        return run

    parts = [texts.mapInArrow(finder(rows), f"doc_id bigint, {HIT}") for rows in _blocks(benchmark, block_bytes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose text holds no item; a row goes whole."""
    at = next(n for n in documents.columns if n.lower() == "text")
    out = documents
    for rows in _blocks(benchmark, block_bytes):
        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            items = Items(rows, similarity)
            for batch in slices(batches, at):
                hit = {t for t, *_ in items.find(*word_codes(batch.column(at), normal_word))}
                yield batch.filter(pa.array([t not in hit for t in range(batch.num_rows)], pa.bool_()))
        out = out.mapInArrow(run, documents.schema)
    return out
