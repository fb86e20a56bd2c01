"""Packing in order: where to cut the token stream is chosen by dynamic programming.

Documents keep their order (by id). The stream of a share of the documents may be cut at document
ends (free), sentence ends (a small penalty) and every few tokens inside a sentence (a larger
one). Among all ways to cut it into windows of at most ``length`` tokens
the one with the least padding plus penalties is taken; since a window's cost is a sum of a part
of its start and a part of its end, a monotone queue over the starts in reach gives the best
start of every end in constant time.

Shares are ranges of (doc_id, text hash) of about ``share_bytes`` of text; each is packed by one
task, and only its last sequence is short of what the program could fill.

Defined results: a NULL text is an empty one, one end token long. Equal rows are packed each for
itself. A NULL id sorts first. An empty table gives no pieces.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import slices, worker_cache

SENTENCE_PENALTY, INNER_PENALTY = 2, 12  # in tokens of padding
INNER = 24  # tokens between the places where a sentence may be cut
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def _byte_letters() -> dict[int, str]:
    """Letters of the byte-level alphabet for U+0080 to U+00FF: their two UTF-8 bytes, unprintable ones moved up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    letters |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in letters)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}


_LATIN = _byte_letters()


# one run of letters below U+0100, then at most one of signs: the tokenizer parts such a word between the two
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
_PLAIN = f"^[{_LETTERS}]+[{re.escape(_SIGNS)}]*$"


class WordIds:
    """Ids (32-bit, as bytes) of white-space pieces by the tokenizer's own parts; a part met before is looked up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.normalise = self.tokenizer.model, self.tokenizer.normalizer.normalize_str
        self.cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.purpose = ("ids", path)
        self.known: dict[str | bytes, bytes] = worker_cache(self.purpose)

    def part(self, part: str) -> bytes:
        ids = self.known.get(part)
        if ids is None:
            ids = self.known[part] = self.tokens(part)
        return ids

    def tokens(self, part: str) -> bytes:
        return array("i", [t.id for t in self.model.tokenize(part)]).tobytes()

    def word(self, word: str) -> bytes:
        if any(s in word for s in self.special):
            return array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([self.part(part) for part, _ in self.cut(self.normalise(word))])

    def plain(self, parts: pa.Array) -> list[bytes]:
        """Of runs of letters in lower case, or of signs. Known as UTF-8, so that none is taken for a part in byte-level letters."""
        parts = parts.cast(pa.binary()).to_pylist()
        out = list(map(self.known.get, parts))
        for n, ids in enumerate(out):
            if ids is None:
                part = parts[n].decode()
                out[n] = self.known[parts[n]] = self.tokens(part if part.isascii() else part.translate(_LATIN))
        return out

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has. What words share, apart from case and signs, is looked up once."""
        plain = pc.match_substring_regex(words, _PLAIN)
        both, rest = words.filter(plain), words.filter(pc.invert(plain))
        letters = pc.utf8_lower(pc.utf8_rtrim(both, _SIGNS)).dictionary_encode()
        signs = pc.utf8_ltrim(both, _LETTERS).dictionary_encode()
        ids = [*self.plain(letters.dictionary), *self.plain(signs.dictionary), *(self.word(w) if w else b"" for w in rest.to_pylist())]
        # a word is two parts, of which the second is empty for words of the rest
        first = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        other = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        parts = np.full((len(words), 2), len(ids))
        parts[first, 0], parts[first, 1] = letters.indices, len(letters.dictionary) + signs.indices.to_numpy()
        parts[other, 0] = len(ids) - len(other) + np.arange(len(other))
        sizes = np.fromiter(map(len, [*ids, b""]), np.int64, len(ids) + 1) // 4
        stream = gathered(np.frombuffer(b"".join(ids), np.int32), np.cumsum(sizes) - sizes, sizes, parts.ravel())
        return stream, sizes[parts].sum(axis=1)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Parts of ``flat`` one after the other."""
    taken = sizes[which]
    ends = np.cumsum(taken)
    return flat[np.repeat(starts[which] - (ends - taken), taken) + np.arange(int(taken.sum()))]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per Python worker: what a task has looked up serves the next."""
    return WordIds(path)


def encode(words: WordIds, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts with ``end_id`` after each, tokens of each text, and sentence ends in the stream.

    A blank or a line break is dropped by the tokenizer and parts tokens, so texts are cut there first.
    """
    words.known = worker_cache(words.purpose)
    lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " \n "), " ")
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary
    flat, sizes = words.words(distinct)
    stops = pc.match_substring_regex(distinct, "[.!?\n]$").to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes[codes])
    stream = gathered(flat, np.cumsum(sizes) - sizes, sizes, codes)
    last_word = np.cumsum(counts)
    text_ends = np.r_[0, ends][last_word]
    owner = np.repeat(np.arange(len(counts)), counts)
    sentence = ends[stops[codes]] if len(codes) else ends
    sentence = sentence + owner[stops[codes]] if len(codes) else sentence
    tokens = np.diff(np.r_[0, text_ends]) + 1
    # the end token belongs to the sentence before it
    return np.insert(stream, text_ends, end_id), tokens, np.setdiff1d(sentence, np.cumsum(tokens) - 1)


def cut_points(ends: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, and at what penalty: document and sentence ends, and every INNER tokens between them."""
    stops = np.union1d(ends, sentence)
    stops = np.r_[0, stops[stops > 0]]
    inside = (np.diff(stops) - 1) // INNER
    steps = np.arange(int(inside.sum())) - np.repeat(np.cumsum(inside) - inside, inside)
    points = np.sort(np.concatenate([stops, np.repeat(stops[:-1], inside) + INNER * (steps + 1)]))
    penalty = np.full(len(points), INNER_PENALTY, np.int64)
    penalty[np.searchsorted(points, stops)] = SENTENCE_PENALTY
    penalty[np.searchsorted(points, ends)] = 0
    return points, penalty


def best_cuts(points: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """Ends of the windows with the least padding plus penalties.

    cost(j) = penalty(j) + length - point(j) + min over starts i in reach of cost(i) + point(i); with
    g(j) = cost(j) + point(j) the minimum runs over g alone. The queue holds starts in reach with
    ascending g; of equal ones the earliest stays, which makes windows full.
    """
    place, extra = points.tolist(), penalty.tolist()
    start = [0] * len(place)
    queue = deque([(0, 0, 0)])  # g, point, number
    for j in range(1, len(place)):
        reach = place[j] - length
        while queue[0][1] < reach:
            queue.popleft()
        least, _, start[j] = queue[0]
        g = least + length + extra[j]
        while queue and queue[-1][0] > g:
            queue.pop()
        queue.append((g, place[j], j))
    cuts, j = [], len(place) - 1
    while j > 0:
        cuts.append(place[j])
        j = start[j]
    return np.array(cuts[::-1], np.int64)


def pack_share(doc_ids: list, stream: np.ndarray, tokens: np.ndarray, sentence: np.ndarray, length: int, first: int) -> dict:
    """Pieces of one share's stream; sequences are numbered from ``first``."""
    ends = np.cumsum(tokens)
    cuts = best_cuts(*cut_points(ends, sentence), length)
    stops = np.union1d(ends, cuts)
    begins = np.r_[0, stops[:-1]]
    doc, window = np.searchsorted(ends, begins, "right"), np.searchsorted(cuts, begins, "right")
    raw = stream.astype("<u4").tobytes()
    return {
        "doc_id": [doc_ids[d] for d in doc],
        "start": begins - (ends - tokens)[doc], "length": stops - begins,
        "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), stops.tolist())],
        "doc_tokens": tokens[doc], "sequence_id": first + window, "offset": begins - np.r_[0, cuts][window],
    }


def pack(documents: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, share_bytes: int = 16 << 20) -> DataFrame:
    """One row per piece of a document. ``tokenizer``: name of a public vocabulary file.

    Sequence numbers hold the share in the high bits and count from 0 within it.
    """
    size = documents.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    shares = max(1, -(-size // share_bytes))
    ordered = (documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
               .repartitionByRange(shares, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie"))
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from public_tokenizers import path

        words, ids, parts, at = word_ids(path(tokenizer)), [], [], 0
        for batch in slices(batches, "text", 8_000_000):
            stream, tokens, sentence = encode(words, batch.column("text"), end_id)
            parts.append((stream, tokens, sentence + at))
            at += len(stream)
            ids += batch.column("doc_id").to_pylist()
        if ids:
            first = TaskContext.get().partitionId() << 36
            pieces = pack_share(ids, *(np.concatenate(p) for p in zip(*parts)), length, first)
            yield pa.RecordBatch.from_pydict(pieces, schema)

    return ordered.mapInArrow(run, PIECES)
