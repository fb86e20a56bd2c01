"""Secret scan: fixed patterns, and a character network that judges every other candidate.

A candidate is a whole run of letters, digits and ``+/_.=-`` of six characters or more that prose does
not consist of: with a digit or one of ``+/_=``, with a capital after a small letter, of twenty
characters or more, or right after a colon or equals sign, whatever it is made of.

The patterns give the base findings. A small convolutional network (numpy) sees each candidate
string with its surroundings; it is trained on the base findings of all documents against
all their other candidates, each different one once, in shards whose weights are averaged. Its threshold is the highest
that still finds the required share of held-out findings, judged on a score calibrated on other rows. Candidates above
it are added with kind ``learned``; base findings always stay.

Defined results: a NULL or empty text has no spans. Offsets are code points, ends exclusive.
Without findings or without other candidates nothing is learned and nothing is
added. Rows are never merged; other columns are kept (one named ``findings`` is replaced).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.llm.common import Stages, slices

# The base patterns, their kinds in order, and the least length of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "learned")

RUN = "[A-Za-z0-9+/_.=-]"
CANDIDATE = re.compile(rf"""(?<!{RUN})(?={RUN}{{6}})(?:(?=[A-Za-z.-]*[0-9+/_=])|(?={RUN}{{20}})|(?=[A-Za-z.-]*[a-z][A-Z])"""
                       rf"""|(?<=[:=])|(?<=[:=][\x20"'])|(?<=[:=]\x20["'])){RUN}+""")
BEFORE, INSIDE, AFTER = 24, 40, 12  # characters that the network sees; a longer candidate shows its two ends
ALPHABET = 100
WEIGHTS = ("taps", "offset", "out", "bias")


def base_findings(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end), leftmost and non-overlapping within a kind."""
    if not text:
        return []
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str | None) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)] if text else []


def overlaps(spans: list[tuple[int, int]], found: list[tuple[int, int, int]]) -> list[bool]:
    """Which of the ascending spans touch a finding."""
    starts = sorted(s for s, _, _ in found)
    furthest = list(accumulate((e for _, _, e in sorted(found)), max))
    before = [bisect_left(starts, end) for _, end in spans]
    return [n > 0 and furthest[n - 1] > start for n, (start, _) in zip(before, spans)]


def window(text: str, start: int, end: int) -> str:
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[: INSIDE // 2] + inside[-INSIDE // 2:]
    return text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + inside.ljust(INSIDE, "\0") + text[end:end + AFTER].ljust(AFTER, "\0")


def encode(windows: list[str]) -> np.ndarray:
    """Character classes: printable ASCII each its own, other letters one, other signs one, nothing 0."""
    width = BEFORE + INSIDE + AFTER
    codes = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(len(windows), width).astype(np.int64)
    return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 31, np.where(codes > 127, 97, 98)))


@dataclass
class Network:
    """One convolution (as a table per tap), maximum over places, one linear layer; scale and shift calibrate."""

    taps: np.ndarray      # (width, alphabet, filters)
    offset: np.ndarray    # (filters,)
    out: np.ndarray       # (filters,)
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        n = x.shape[1] - len(self.taps) + 1
        z = self.offset + sum(self.taps[k][x[:, k:k + n]] for k in range(len(self.taps)))
        return np.maximum(z, 0)

    def logits(self, x: np.ndarray, step: int = 512) -> np.ndarray:
        parts = [self.hidden(x[i:i + step]).max(axis=1) @ self.out + self.bias for i in range(0, len(x), step)]
        return np.concatenate(parts).astype(float) if parts else np.zeros(0)

    def chance(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.chance(self.logits(x))


def begun(n: int, seed: int = 7, filters: int = 12, width: int = 5) -> tuple[np.random.Generator, np.ndarray, Network]:
    """Of ``n`` rows: the generator, their order, whose first fifth is held out, and a network to begin with."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    net = Network(rng.normal(0, 0.15, (width, ALPHABET, filters)).astype(np.float32), np.zeros(filters, np.float32),
                  rng.normal(0, 0.3, filters).astype(np.float32), 0.0)
    return rng, order, net


@dataclass
class State:
    """A network in training: Adam's two moments of each weight, its steps and the epochs so far."""

    net: Network
    moments: dict = field(default_factory=dict)
    step: int = 0
    epochs: int = 0

    def vector(self) -> np.ndarray:
        return np.concatenate([np.ravel(a).astype(float) for name in WEIGHTS for a in (getattr(self.net, name), *self.moments[name])] + [[self.step]])

    def merged(self, vector: np.ndarray) -> State:
        """The state after one more epoch, from the mean of the shards' vectors."""
        parts, at = {}, 0
        for name in WEIGHTS:
            shape = np.shape(getattr(self.net, name))
            size, kind = int(np.prod(shape)), np.float32 if name == "taps" else np.float64
            parts[name] = [vector[at + k * size:at + (k + 1) * size].astype(kind).reshape(shape) for k in range(3)]
            at += 3 * size
        net = Network(*[parts[name][0] for name in WEIGHTS[:-1]], float(parts["bias"][0]))
        return State(net, {name: tuple(parts[name][1:]) for name in WEIGHTS}, round(float(vector[at])), self.epochs + 1)


def learn(x: np.ndarray, y: np.ndarray, state: State, share: float, seed: int = 7) -> State:
    """One epoch of Adam on the log loss of the rows that are not held out; ``share`` of all such rows, here or elsewhere, are findings."""
    rng, order, _ = begun(len(x), seed)
    used = order[len(x) // 5:]
    for _ in range(state.epochs):
        rng.permutation(used)  # the generator goes on where the last epoch left it
    net, moments, step = replace(state.net), dict(state.moments), state.step
    width, filters, n = net.taps.shape[0], net.taps.shape[2], x.shape[1] - net.taps.shape[0] + 1
    weight = np.where(y > 0, 0.5 / max(1e-6, share), 0.5 / max(1e-6, 1 - share))

    def update(name: str, value, gradient):
        m, v = moments.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        moments[name] = (m, v)
        return value - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    for at in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
        step += 1
        xb, hidden = x[at], net.hidden(x[at])
        best = hidden.argmax(axis=1)                                # (batch, filters)
        top = np.take_along_axis(hidden, best[:, None, :], 1)[:, 0]
        p = 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -30, 30)))
        d = weight[at] * (p - y[at]) / max(1, len(at))
        d_top = d[:, None] * net.out * (top > 0)
        taps = np.zeros_like(net.taps)
        for k in range(width):
            chars = np.take_along_axis(xb, np.minimum(best + k, n + width - 2), 1)
            np.add.at(taps[k], (chars, np.arange(filters)[None, :]), d_top)
        net.out = update("out", net.out, d @ top + 1e-4 * net.out)
        net.bias = float(update("bias", net.bias, d.sum()))
        net.offset = update("offset", net.offset, d_top.sum(0))
        net.taps = update("taps", net.taps, taps + 1e-5 * net.taps)
    return State(net, moments, step, state.epochs + 1)


def placed(net: Network, x: np.ndarray, y: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Each row's logit, its hundredth, its label, whether it is held out, and the half of its part."""
    _, order, _ = begun(len(x), seed)
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    logit = net.logits(x)
    return {"logit": logit, "bin": np.rint(np.clip(logit, -30, 30) * 100).astype(np.int32), "label": y > 0, "held": place < len(x) // 5, "odd": place % 2 == 1}


def settle(net: Network, counts: pd.DataFrame, pick: Callable[[pd.Series, int, int], float], recall: float) -> Network:
    """Sets scale, shift and threshold from the rows counted by hundredth, label, part and half.

    One half of the held-out rows calibrates the score, the other sets the threshold. A part without both kinds of rows
    is replaced by the whole it is of, so few rows serve twice rather than not at all. ``pick(parts, bin, k)`` is the
    k-th logit, ascending for a positive scale, of the findings with that hundredth in those parts.
    """
    def both(part: pd.Series, whole: pd.Series) -> pd.Series:
        return part if counts[part]["label"].nunique() == 2 else whole

    held = both(counts["held"], counts["n"] > 0)
    judged, held = both(held & counts["odd"], held), both(held & ~counts["odd"], held)
    seen = counts[held].groupby("bin").apply(lambda g: pd.Series({"n": g["n"].sum(), "y": g["n"][g["label"]].sum()}), include_groups=False)
    p = 1 / (1 + np.exp(-seen.index.to_numpy() / 100))
    z, n, y = np.log(p + 1e-12) - np.log(1 - p + 1e-12), seen["n"].to_numpy(float), seen["y"].to_numpy(float)
    scale, shift = 1.0, 0.0
    for _ in range(200):  # calibration: a scale and a shift of the logit on held-out candidates
        gap = n / (1 + np.exp(-np.clip(scale * z + shift, -30, 30))) - y
        scale -= 0.05 * float((gap * z).sum() / (n.sum() + (n * z * z).sum()))
        shift -= 0.5 * float(gap.sum() / n.sum())
    net.scale, net.shift = scale, shift
    found = counts[judged & counts["label"]].groupby("bin")["n"].sum().sort_index(ascending=scale >= 0)
    k, upto = int((1 - recall) * found.sum()), found.cumsum()
    at = int((upto > k).to_numpy().argmax())
    logit = pick(judged, int(found.index[at]), k - int(upto.iloc[at] - found.iloc[at]))
    net.threshold = float(net.chance(np.array([logit]))[0])
    return net


def train(x: np.ndarray, y: np.ndarray, recall: float, epochs: int = 4, seed: int = 7) -> Network:
    """The training of ``fit`` on rows at hand: Adam on the log loss of four fifths, calibration and threshold from the last."""
    _, order, net = begun(len(x), seed)
    state, share = State(net), y[order[len(x) // 5:]].mean()
    for _ in range(epochs):
        state = learn(x, y, state, share, seed)
    rows = pd.DataFrame(placed(state.net, x, y, seed))
    parts = ["label", "held", "odd"]
    counts = rows.groupby(["bin", *parts]).size().rename("n").reset_index()

    def pick(judged: pd.Series, at: int, k: int) -> float:
        those = rows.merge(counts[judged & counts["label"] & (counts["bin"] == at)], on=["bin", *parts])["logit"]
        return float(those.sort_values(ascending=state.net.scale >= 0).iloc[k])

    return settle(state.net, counts, pick, recall)


def fit(documents: DataFrame, recall: float = 0.95, shard_rows: int = 32768, epochs: int = 4, seed: int = 7) -> Network | None:
    """Train on every different candidate of all documents, against the base findings.

    The candidates are dealt to shards of about ``shard_rows`` by their hash, one row each. In every epoch each shard takes
    its steps from the same weights, and the mean of what the shards reach, weighted by their rows, begins the next. The
    driver sees the weights and counts by hundredths of a logit, no candidates.
    """
    stages = Stages(documents.sparkSession)

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen, label = [], []
            for text in batch.column("text").to_pylist():
                spans = candidates(text)
                if spans:
                    label += overlaps(spans, base_findings(text))
                    seen += [window(text, *s) for s in spans]
            yield pa.RecordBatch.from_pydict({"seen": seen, "label": label}, pa.schema([("seen", pa.string()), ("label", pa.bool_())]))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("seen", "ascending"), ("label", "ascending")])
        x, y = encode(rows.column("seen").to_pylist()).astype(np.uint8), rows.column("label").to_numpy().astype(np.uint8)
        used = begun(len(y), seed)[1][len(y) // 5:]
        return pa.table({"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary()), "used": [len(used)], "known": [int(y[used].sum())]})

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                y = np.frombuffer(y.as_py(), np.uint8).astype(float)
                yield np.frombuffer(x.as_py(), np.uint8).reshape(len(y), -1).astype(np.int64), y

    def epoch_of(state: State, used: int, share: float) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, y in unpacked(batches):
                mine = learn(x, y, state, share, seed).vector() * ((len(y) - len(y) // 5) / used)
                yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(len(mine)), pa.int32()), "part": mine})
        return run

    def placing(net: Network) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, y in unpacked(batches):
                yield pa.RecordBatch.from_pydict(placed(net, x, y, seed))
        return run

    windows = stages.write(documents.select("text").mapInArrow(every, "seen string, label boolean").distinct().withColumn("key", F.xxhash64("seen")), "windows")
    n, known = windows.agg(F.count("*"), F.count_if("label")).first()
    if known in (0, n):
        stages.drop(windows)
        return None
    shard = F.pmod("key", F.lit(-(-n // shard_rows))).alias("shard")
    shards = stages.write(windows.groupBy(shard).applyInArrow(pack, "x binary, y binary, used long, known long"), "shards")
    stages.drop(windows)
    used, found = shards.agg(F.sum("used"), F.sum("known")).first()
    state = State(begun(min(n, shard_rows), seed)[2])
    for _ in range(epochs):
        # summed as decimals, exactly, so that the order in which shards arrive plays no part
        parts = shards.mapInArrow(epoch_of(state, used, found / used), "at int, part double")
        mean = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,24)")).cast("double").alias("part")).toPandas()
        state = state.merged(mean.sort_values("at")["part"].to_numpy())
    rows = stages.write(shards.mapInArrow(placing(state.net), "logit double, bin int, label boolean, held boolean, odd boolean"), "logits")
    parts = ["label", "held", "odd"]
    counts = rows.groupBy("bin", *parts).agg(F.count("*").alias("n")).toPandas().sort_values(["bin", *parts], ignore_index=True)

    def pick(judged: pd.Series, at: int, k: int) -> float:
        those = [(F.col("held") == r.held) & (F.col("odd") == r.odd) for r in counts[judged].drop_duplicates(["held", "odd"]).itertuples()]
        up = F.asc("logit") if state.net.scale >= 0 else F.desc("logit")
        return rows.filter(F.col("label") & (F.col("bin") == at) & reduce(Column.__or__, those)).orderBy(up).offset(k).limit(1).first()["logit"]

    net = settle(state.net, counts, pick, recall)
    stages.drop(shards, rows)
    return net


def find(documents: DataFrame, network: Network | None) -> DataFrame:
    """The rows with ``findings``: an array of (start, kind, end, score), ascending; one pass, no shuffle."""
    kept = documents.drop("findings")
    names = kept.columns
    at = next(n for n in names if n.lower() == "text")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            base = [base_findings(t) for t in texts]
            found: list[list[tuple[int, int, int, float]]] = [[(s, k, e, 1.0) for s, k, e in b] for b in base]
            if network is not None:
                seen, owner = [], []
                for n, text in enumerate(texts):
                    spans = candidates(text)
                    for span, known in zip(spans, overlaps(spans, base[n])):
                        if not known:
                            seen.append(window(text, *span))
                            owner.append((n, *span))
                for (n, start, end), p in zip(owner, network.score(encode(seen)) if seen else ()):
                    if p >= network.threshold:
                        found[n].append((start, 3, end, float(p)))
            rows = [[{"start": s, "kind": KINDS[k], "end": e, "score": p} for s, k, e, p in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*names, "findings"])

    element = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()),
                            T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("findings", T.ArrayType(element))]))


def digest(findings: F.Column) -> F.Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
