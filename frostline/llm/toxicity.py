"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digits standing for letters), matched by one Aho-Corasick
automaton, and the weight of what is found is set in relation to the length of the text.
Phrases in which an entry is harmless take its weight back. Entries (whole words and word
beginnings), their weights, the phrases and the curve from weight to score are learned from
labelled rows; matching and scoring see nothing but the text.

Defined results: a NULL or empty text has weight 0 and the score that the curve gives for it;
without labelled rows of both kinds the lexicon is empty and every score is the smoothed share
of toxic labels (0 without labels). Equal texts get equal scores, rows are never merged, other
columns are kept (a column named as an output column is replaced).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.llm.common import slices

# Letters that look like a Latin letter, and digits and signs that stand for one.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "ѵ": "v", "ԝ": "w", "ɡ": "g",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ⅼ": "i", "ℓ": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
# A digit 1 may stand for i or l, so both are folded into one.
SAME = {"l": "i", "|": "i"}
HARMLESS = ("trash can", "trash bin", "clown fish", "idiot proof", "pond scum", "sore loser award")

_FULL_WIDTH = {chr(0xFF21 + i): chr(97 + i) for i in range(26)} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_BLANK = {c: " " for c in map(chr, range(128)) if not c.isalnum()} | {c: " " for c in "“”„‘’«»–—…¿¡ ​­"}
_FOLD = str.maketrans(_BLANK | _FULL_WIDTH | HOMOGLYPHS | DIGITS | SAME)


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, signs as blanks; padded so that words have two sides."""
    return " " + text.lower().translate(_FOLD) + " "


@dataclass
class Lexicon:
    """weights: pattern of a folded text to weight; harmless: phrase to the weight it takes back.

    curve: coefficients of (1, log(1 + weight), weight by length), from which the score follows.
    """

    weights: dict[str, float] = field(default_factory=dict)
    harmless: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for pattern, weight in {**self.weights, **{p: -w for p, w in self.harmless.items()}}.items():
            found.add_word(pattern, weight)
        if not len(found):
            return None
        found.make_automaton()
        return found


def measures(automaton: ahocorasick.Automaton | None, text: str | None) -> tuple[float, int, int]:
    """Weight found, number of finds, number of words."""
    if not text:
        return 0.0, 0, 0
    folded = fold(text)
    found = [w for _, w in automaton.iter(folded)] if automaton is not None else []
    return max(0.0, math.fsum(found)), sum(w > 0 for w in found), len(folded.split())


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(weight), np.log1p(weight), 10 * weight / (words + 50.0)], axis=1)


def score(lexicon: Lexicon, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    z = features(weight, words) @ np.array(lexicon.curve)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fold_of(doc_id: F.Column) -> F.Column:
    """0 to 4; fold 0 is held out. A NULL id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def _parts(folded: str, shortest: int = 4, longest: int = 7) -> set[str]:
    """Candidate patterns of a text: whole words, and beginnings of longer words."""
    out = set()
    for word in set(folded.split()):
        if len(word) >= 3:
            out.add(f" {word} ")
        out.update(" " + word[:n] for n in range(shortest, min(longest, len(word) - 1) + 1))
    return out


def _count_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2_000_000):
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update(_parts(fold(text or "")))
        # a pattern is an entry only if toxic texts have it
        part = list(counts[1])
        yield pa.RecordBatch.from_pydict({"part": part, "t": [counts[1][p] for p in part], "c": [counts[0][p] for p in part]},
                                         pa.schema([("part", pa.string()), ("t", pa.int64()), ("c", pa.int64())]))


def _count_clean(entries: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = set(entries)
        for batch in slices(batches, "text", 2_000_000):
            counts = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                if not toxic:
                    counts.update(_parts(fold(text or "")) & wanted)
            yield pa.RecordBatch.from_pydict({"part": list(counts), "c": list(counts.values())},
                                             pa.schema([("part", pa.string()), ("c", pa.int64())]))
    return run


def least_texts(toxic: int) -> float:
    """Toxic texts that must have an entry: 1.5 % of them, 4 at least."""
    return max(4, 0.015 * toxic)


def choose_entries(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: float = 2.0) -> dict[str, float]:
    """Entries by log-odds less their standard error: of patterns that begin alike and are about as sure, the longest that finds nearly as many texts."""
    sure, texts = {}, {}
    for part, t, c in counts:
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) - math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        if t >= least_texts(toxic) and odds >= least and t > 4 * c:
            sure[part], texts[part] = odds, t
    best: dict[str, str] = {}
    for part in sorted(sure, key=lambda p: (len(p), p)):
        head = next((part[:n] for n in range(4, len(part)) if part[:n] in best and sure[part[:n]] >= sure[part] - 1.0), None)
        if head is None:
            best[part] = part
        elif texts[part] >= 0.9 * texts[head]:
            best[head] = part
    return {part: round(sure[part], 4) for part in best.values()}


def _sample(documents: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, int, int]:
    """Labelled rows outside fold 0: all class sizes, and at most ``per_class`` texts of each class."""
    spark = documents.sparkSession
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).filter(fold_of(F.col("doc_id")) != 0)
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    # bounded: 2 * per_class ids
    ids = [r for k in (0, 1) for r in known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    chosen = spark.createDataFrame([(r.doc_id, r.toxic) for r in ids], "doc_id bigint, toxic int")
    # bounded by 2 * per_class ids, so documents are not shuffled for it
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # copies say nothing new
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic")), sizes.get(1, 0), sizes.get(0, 0)


def fit(documents: DataFrame, labels: DataFrame, stages, per_class: int = 4000, max_entries: int = 3000) -> Lexicon:
    """Learn from a bounded sample of labelled rows: ``per_class`` texts of each class at most."""
    sample, toxic, clean = _sample(documents, labels, per_class)
    share = (toxic + 0.5) / (toxic + clean + 1) if toxic + clean else 1e-9
    base = math.log(share / (1 - share))
    if not toxic or not clean:
        return Lexicon(curve=(base, 0.0, 0.0))
    sample = stages.write(sample.repartition(2 * sample.sparkSession.sparkContext.defaultParallelism), "toxic-sample")
    seen = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    seen_toxic, seen_clean = seen.get(1, 0), seen.get(0, 0)
    frequent = (sample.filter("toxic = 1").mapInArrow(_count_parts, "part string, t bigint, c bigint")
                .groupBy("part").agg(F.sum("t").alias("t")).filter(F.col("t") >= least_texts(seen_toxic))
                .orderBy(F.desc("t"), "part").limit(20 * max_entries).collect())
    in_clean = {r.part: r.c for r in sample.filter("toxic = 0").mapInArrow(_count_clean([r.part for r in frequent]), "part string, c bigint")
                .groupBy("part").agg(F.sum("c").alias("c")).collect()}
    weights = choose_entries([(r.part, r.t, in_clean.get(r.part, 0)) for r in frequent], seen_toxic, seen_clean)
    weights = dict(sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:max_entries])
    lexicon = Lexicon(weights)
    lexicon.harmless = _harmless(sample, lexicon)
    automaton = lexicon.automaton

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch in batches:
            rows = [measures(finder, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "weight": pa.array([r[0] for r in rows], pa.float64()),
                                              "words": pa.array([float(r[2]) for r in rows], pa.float64())})

    got = sample.mapInArrow(measure, "toxic int, weight double, words double").toPandas().sort_values(["toxic", "weight", "words"])
    lexicon.curve = _logistic(features(got["weight"].to_numpy(), got["words"].to_numpy()), got["toxic"].to_numpy(float),
                              prior=math.log((toxic / clean) / (seen_toxic / seen_clean)))
    stages.drop(sample)
    return lexicon


def _harmless(sample: DataFrame, lexicon: Lexicon, least: int = 5) -> dict[str, float]:
    """Phrases of an entry and its neighbour that clean texts have often and toxic texts never."""
    automaton, weights = lexicon.automaton, dict(lexicon.weights)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = automaton()
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = " ".join(fold(text or "").split()).join("  ")
                phrases = set()
                for end, _ in (finder.iter(folded) if finder is not None else ()):
                    word_end = folded.index(" ", end) if folded[end] != " " else end
                    word_start = folded.rindex(" ", 0, word_end) + 1
                    before, after = folded.rfind(" ", 0, max(word_start - 1, 0)) + 1, folded.find(" ", word_end + 1)
                    if before < word_start - 1:
                        phrases.add(folded[before:word_end])
                    if after > word_end + 1:
                        phrases.add(folded[word_start:after])
                seen[toxic].update(phrases)
            phrase = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_pydict({"phrase": phrase, "t": [seen[1][p] for p in phrase], "c": [seen[0][p] for p in phrase]},
                                             pa.schema([("phrase", pa.string()), ("t", pa.int64()), ("c", pa.int64())]))

    rows = (sample.mapInArrow(contexts, "phrase string, t bigint, c bigint").groupBy("phrase").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
            .filter((F.col("c") >= least) & (F.col("t") == 0)).orderBy(F.desc("c"), "phrase").limit(1000).collect())
    found = {}
    for phrase in [r.phrase for r in rows] + [" ".join(fold(p).split()) for p in HARMLESS]:
        padded = f" {phrase} "
        inside = sum(w for p, w in weights.items() if p in padded)
        if inside:
            found[padded] = inside
    return found


def _logistic(x: np.ndarray, y: np.ndarray, prior: float, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Regularised Newton steps; the intercept is moved from the sample's share to the labels' share."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * np.r_[0, w[1:]] * 0.1
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w)) * 0.1
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] + prior), float(w[1]), float(w[2])


def score_texts(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows with toxic_weight, toxic_hits, toxic_words, score and predicted; one pass, no shuffle."""
    ours = ["toxic_weight", "toxic_hits", "toxic_words", "score", "predicted"]
    kept = documents.drop(*ours)
    names = kept.columns
    at = next(n for n in names if n.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = lexicon.automaton()
        for batch in slices(batches, at):
            rows = [measures(finder, t) for t in batch.column(at).to_pylist()]
            weight, words = np.array([r[0] for r in rows]), np.array([r[2] for r in rows], float)
            value = score(lexicon, weight, words)
            added = [pa.array(weight), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*names, *ours])

    kinds = zip(ours, (T.DoubleType(), T.LongType(), T.LongType(), T.DoubleType(), T.IntegerType()))
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *(T.StructField(n, k) for n, k in kinds)]))
