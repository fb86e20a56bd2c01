"""Pairs of embeddings above a cosine, by dual traversal of cover trees.

On unit vectors a cosine is a distance, so a tree of nested balls bounds all pairs under two of its
nodes: a pair of nodes farther apart than both covering radii plus the threshold is dropped, and
one whose farthest members are still within it is linked as a whole. Radii halve from level to
level; every node's centre is also a node of the next level.

The tree has two parts. Its upper levels are made by Spark: a label's vectors are a cell, a cell
of more than ``cell_rows`` is dealt to its nearest pivots until every cell is small, and pairs of
cells are followed down those levels, pruned by the cells' radii. The lower levels are built and
traversed inside the task of a pair of cells, which holds two cells at most.

Only equal labels are compared. Equal vectors are one point with a number of copies. A task gives
back counts and one link to a local root per point, never the pairs.

Defined results: a vector that is NULL, empty, zero or holds NULL or a non-finite component, and
one without label, links with nothing and is its own class; so are vectors of different length
to each other. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import Stages, components

CELL_ROWS = 8192
BATCH = 512
SMALL = 64  # points of a node that is not opened any more
LEAF = 1 << 20  # pairs of points that are compared at once instead of opening their nodes
ROUGH = 1e-3  # single precision drops no distance below a bound by less than this
SLACK = 1e-7  # bounds leave room for rounding; pairs themselves are decided by their cosine


class CoverTree:
    """Nested levels over unit rows ``x``: nodes by level, with children, covering radius and members."""

    def __init__(self, x: np.ndarray, first_radius: float = 1.0, levels: int = 6):
        # single precision chooses centres and drops pairs with room to spare; radii and links are double
        self.x, self.single = x, x.astype(np.float32)
        n = len(x)
        self.centre, self.children, self.members, self.radius = [0], [[]], [np.arange(n)], [0.0]
        todo = [(0, first_radius, levels)]
        while todo:
            node, radius, left = todo.pop()
            members = self.members[node]
            self.radius[node] = float(distance(x[members] @ x[self.centre[node]]).max()) if len(members) > 1 else 0.0
            if len(members) == 1 or self.radius[node] == 0.0 or not left:
                continue
            for centre, part in self._cover(members, self.centre[node], radius):
                self.centre.append(centre)
                self.children.append([])
                self.members.append(part)
                self.radius.append(0.0)
                self.children[node].append(len(self.centre) - 1)
                if len(part) > 1:
                    todo.append((len(self.centre) - 1, radius / 2, left - 1))

    def _cover(self, members: np.ndarray, own: int, radius: float) -> list[tuple[int, np.ndarray]]:
        """Centres such that every member is within ``radius`` of its own; the node's own centre is the first."""
        rest, least = np.r_[own, members[members != own]], 1 - radius * radius / 2
        out = []
        while len(rest):
            batch = rest[:BATCH]
            near = self.single[batch] @ self.single[batch].T >= least
            chosen: list[int] = []
            open_ = np.ones(len(batch), bool)
            for i in range(len(batch)):
                if open_[i]:
                    chosen.append(i)
                    open_ &= ~near[i]
            centres = batch[chosen]
            dots = self.single[rest] @ self.single[centres].T
            nearest = dots.argmax(axis=1)
            covered = dots[np.arange(len(rest)), nearest] >= least
            nearest[: len(batch)][chosen], covered[: len(batch)][chosen] = np.arange(len(chosen)), True
            order = np.argsort(nearest[covered], kind="stable")
            parts = np.split(rest[covered][order], np.cumsum(np.bincount(nearest[covered], minlength=len(chosen)))[:-1])
            out += list(zip(centres.tolist(), parts))
            rest = rest[~covered]
        return out


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


class Links:
    """Link counts and local classes of points that carry ``copies``."""

    def __init__(self, copies: np.ndarray):
        self.copies, self.count, self.root = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            i, j = self.find(i), self.find(j)
            if i != j:
                self.root[max(i, j)] = min(i, j)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, self.copies[b])
        np.add.at(self.count, b, self.copies[a])
        self.join(a, b)

    def all_between(self, a: np.ndarray, b: np.ndarray) -> None:
        self.count[a] += self.copies[b].sum()
        self.count[b] += self.copies[a].sum()
        self.join(np.r_[a[1:], b], np.full(len(a) + len(b) - 1, a[0]))

    def all_within(self, a: np.ndarray) -> None:
        self.count[a] += self.copies[a].sum() - self.copies[a]
        self.join(a[1:], np.full(len(a) - 1, a[0]))


def traverse(left: CoverTree, right: CoverTree | None, cosine: float, links: Links, shift: int) -> None:
    """Dual traversal; ``right`` None compares the left tree with itself. Right points count from ``shift``."""
    reach, one = math.sqrt(2 - 2 * cosine), right is None
    right = left if one else right
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        same = one and a == b
        ma, mb = left.members[a], right.members[b]
        apart = 0.0 if same else float(distance(left.x[left.centre[a]] @ right.x[right.centre[b]]))
        most = 2 * left.radius[a] if same else apart + left.radius[a] + right.radius[b]
        if not same and apart > left.radius[a] + right.radius[b] + reach + SLACK:
            continue
        if most <= reach - SLACK:
            links.all_within(ma) if same else links.all_between(ma, mb + shift)
            continue
        ca, cb = left.children[a], right.children[b]
        if (not ca and not cb) or len(ma) * len(mb) <= LEAF:
            _leaves(left, right, ma, mb, same, cosine, links, shift)
            continue
        # the wider node is opened; children of both at once where both are wide
        ka = ca if ca and (same or not cb or left.radius[a] >= right.radius[b] / 2) else [a]
        kb = ka if same else cb if cb and (ka == [a] or right.radius[b] >= left.radius[a] / 2) else [b]
        ka = sorted(ka, key=lambda k: left.radius[k])
        kb = ka if same else sorted(kb, key=lambda k: right.radius[k])
        ra, rb = np.array([left.radius[k] for k in ka]), np.array([right.radius[k] for k in kb])
        xa, xb = left.x[[left.centre[k] for k in ka]], right.x[[right.centre[k] for k in kb]]
        sa, sb = left.single[[left.centre[k] for k in ka]], right.single[[right.centre[k] for k in kb]]
        size_a, size_b = np.array([len(left.members[k]) for k in ka]), np.array([len(right.members[k]) for k in kb])
        small_a, small_b = np.zeros(len(ka), bool), np.zeros(len(kb), bool)
        points: list[tuple[np.ndarray, np.ndarray]] = []
        # strips of nodes without and with extent, so that each has a narrow bound
        for at, end, begin, stop in _strips(np.count_nonzero(ra == 0), len(ra), np.count_nonzero(rb == 0), len(rb), same):
            dots = sa[at:end] @ sb[begin:stop].T
            widest = float(ra[at:end].max() + rb[begin:stop].max()) + reach + ROUGH
            i, j = np.nonzero(dots >= 1 - widest * widest / 2)
            i, j = i + at, j + begin
            if same:
                i, j = i[j >= i], j[j >= i]
            value = np.einsum("ij,ij->i", xa[i], xb[j])
            single = (ra[i] == 0) & (rb[j] == 0)
            near = distance(value) <= ra[i] + rb[j] + reach + SLACK
            open_ = near & ~single
            small = open_ & (size_a[i] <= SMALL) & (size_b[j] <= SMALL)
            for p, q in zip(i[open_ & ~small].tolist(), j[open_ & ~small].tolist()):
                todo.append((ka[p], kb[q]))
            small_a[i[small]], small_b[j[small]] = True, True
            # nodes without extent hold one point each: the pair is decided by its cosine
            found = single & (value >= cosine)
            if same:
                found &= i != j
            points.append((i[found], j[found]))
        # small nodes near some other small one are compared point by point, all at once
        if same:
            small_a |= small_b
            small_b = small_a
        # points that are both among those are compared there, and must not count twice
        for i, j in points:
            left_out = ~(small_a[i] & small_b[j])
            pa = np.array([left.centre[ka[p]] for p in i[left_out]], np.int64)
            pb = np.array([right.centre[kb[q]] for q in j[left_out]], np.int64)
            links.pairs(pa, pb + shift)
        if small_a.any():
            ma = np.concatenate([left.members[ka[p]] for p in np.flatnonzero(small_a)])
            mb = ma if same else np.concatenate([right.members[kb[q]] for q in np.flatnonzero(small_b)])
            _leaves(left, right, ma, mb, same, cosine, links, shift)


def _strips(cut_a: int, n_a: int, cut_b: int, n_b: int, same: bool) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of both sides, none across a cut; of a node with itself those on and above the diagonal."""
    edges = sorted({*range(0, n_a, BATCH), cut_a, n_a})
    for at, end in zip(edges, edges[1:]):
        begin = at if same else 0
        for low, high in ((begin, cut_b), (max(begin, cut_b), n_b)):
            if low < high:
                yield at, end, low, high


def _leaves(left: CoverTree, right: CoverTree, ma: np.ndarray, mb: np.ndarray, same: bool, cosine: float, links: Links, shift: int) -> None:
    for at in range(0, len(ma), BATCH):
        begin = at if same else 0
        i, j = np.nonzero(left.single[ma[at:at + BATCH]] @ right.single[mb[begin:]].T >= cosine - ROUGH)
        i, j = i + at, j + begin
        if same:
            i, j = i[j > i], j[j > i]
        found = np.einsum("ij,ij->i", left.x[ma[i]], right.x[mb[j]]) >= cosine
        links.pairs(ma[i[found]], mb[j[found]] + shift)


def unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cells(points: DataFrame, cell_rows: int, stages: Stages) -> tuple[DataFrame, list[DataFrame]]:
    """Points with their cell, and for each level (cell, parent, centre, radius) of all cells there."""
    def split(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or pivots.empty:
            return rows.assign(cell=rows["cell"], parent=rows["cell"], centre=0, gap=0.0)[columns]
        p = pivots.drop_duplicates("h").sort_values("h")
        gap = distance(unit(rows["embedding"]) @ unit(p["embedding"]).T)
        nearest = gap.argmin(axis=1)
        centre = p["h"].to_numpy()[nearest]
        return rows.assign(parent=rows["cell"], cell=rows["cell"] + "/" + pd.Series(centre, index=rows.index).astype(str), centre=centre,
                           gap=gap[np.arange(len(rows)), nearest])[columns]

    columns = ["h", "embedding", "copies", "cell", "parent", "centre", "gap"]
    schema = "h bigint, embedding array<float>, copies bigint, cell string, parent string, centre bigint, gap double"
    levels = []
    while True:
        sizes = points.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > cell_rows)
        sizes = stages.write(sizes, "crowded")
        if sizes.isEmpty():
            return points, levels
        marked = points.join(sizes, "cell", "left")
        salt = F.pmod(F.xxhash64("h", F.lit(1)), F.ceil(F.col("n") / cell_rows))
        crowded = marked.filter("n is not null").withColumn("salt", salt)
        # about two pivots for each cell to be, drawn by hash; every block of a cell gets them all
        pivots = (crowded.filter(F.pmod(F.xxhash64("h", F.lit(len(levels) + 2)), F.col("n")) < 4 * F.ceil(F.col("n") / cell_rows))
                  .select(F.col("h").alias("h"), F.col("embedding").alias("embedding"), F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / cell_rows) - 1)).alias("salt")))
        dealt = (crowded.drop("n").groupBy("cell", "salt").cogroup(pivots.groupBy("cell", "salt")).applyInPandas(split, schema))
        calm = marked.filter("n is null").select("h", "embedding", "copies", "cell", F.col("cell").alias("parent"), F.lit(None).cast("bigint").alias("centre"),
                                                 F.lit(None).cast("double").alias("gap"))
        level = stages.write(calm.unionByName(dealt), "cells")
        centres = level.filter("h = centre").select("cell", F.col("embedding").alias("at"))
        levels.append(level.groupBy("cell", "parent").agg(F.max("gap").alias("radius")).join(centres, "cell", "left"))
        if level.groupBy("parent").agg(F.countDistinct("cell").alias("k")).filter("k > 1").isEmpty():
            return level, levels  # points that no pivot tells apart
        points = level


def _cell_pairs(points: DataFrame, levels: list[DataFrame], reach: float) -> DataFrame:
    """(left, right) cells that may hold links: the pairs of a level follow from those of the level above."""
    pairs = points.select(F.regexp_extract("cell", "^[^/]*", 0).alias("left")).distinct().withColumn("right", F.col("left"))
    for cells in levels:
        down = pairs
        for side in ("left", "right"):
            own = cells.select(F.col("parent").alias(side), F.col("cell").alias(f"{side}_cell"), F.col("at").alias(f"{side}_at"), F.col("radius").alias(f"{side}_r"))
            down = down.join(own, side)
        norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v.cast("double") * v))
        dot = F.aggregate(F.zip_with("left_at", "right_at", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
        apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot / (norm("left_at") * norm("right_at"))))
        near = apart.isNull() | F.col("left_r").isNull() | F.col("right_r").isNull() | (apart <= F.col("left_r") + F.col("right_r") + reach + SLACK)
        pairs = down.filter((F.col("left_cell") <= F.col("right_cell")) & near).select(F.col("left_cell").alias("left"), F.col("right_cell").alias("right"))
        # both orders of two different parents lead to the same pairs of cells
        pairs = pairs.distinct()
    return pairs


def near_vectors(embeddings: DataFrame, stages: Stages, cosine: float = 0.93, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    sound = F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & some, F.lit(False))
    rows = embeddings.select("vec_id", F.when(sound, F.col("label")).alias("label"), F.when(sound, F.col("embedding").cast("array<float>")).alias("embedding"))
    rows = rows.withColumn("h", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")))
    points = (rows.filter("h is not null").groupBy("h").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"),
                                                           F.first("label").alias("label"), F.first("embedding").alias("embedding")))
    points = stages.write(points.withColumn("cell", F.concat_ws("x", F.xxhash64("label").cast("string"), F.size("embedding").cast("string"))), "points")
    placed, levels = _cells(points.select("h", "embedding", "copies", "cell"), cell_rows, stages)
    reach = math.sqrt(2 - 2 * cosine)
    pairs = stages.write(_cell_pairs(placed, levels, reach).withColumn("pair", F.concat_ws("|", "left", "right")), "cell-pairs")
    sides = pairs.select("pair", F.col("left").alias("cell"), F.lit(0).alias("side"), (F.col("left") == F.col("right")).alias("same")).unionByName(
        pairs.filter("left <> right").select("pair", F.col("right").alias("cell"), F.lit(1).alias("side"), F.lit(False).alias("same")))
    brought = placed.select("h", "embedding", "copies", "cell").join(sides, "cell").select("pair", "side", "h", "embedding", "copies")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "h"], ignore_index=True)
        x, split = unit(group["embedding"]), int((group["side"] == group["side"].iloc[0]).sum())
        links = Links(group["copies"].to_numpy(np.int64))
        if split == len(group):
            traverse(CoverTree(x), None, cosine, links, 0)
        else:
            traverse(CoverTree(x[:split]), CoverTree(x[split:]), cosine, links, split)
        h = group["h"].to_numpy()
        root = h[[links.find(i) for i in range(len(h))]]
        touched = links.count > 0
        return pd.DataFrame({"h": h[touched], "links": links.count[touched], "root": root[touched]})

    found = stages.write(brought.groupBy("pair").applyInPandas(compare, "h bigint, links bigint, root bigint"), "found")
    classes = components(found.select(F.col("h").alias("a"), F.col("root").alias("b")), stages)
    counts = found.groupBy("h").agg(F.sum("links").alias("links"))
    of_point = (points.select("h", "copies", "first").join(counts, "h", "left").join(classes.withColumnRenamed("node", "h"), "h", "left")
                .withColumn("root", F.coalesce("root", "h")))
    firsts = of_point.groupBy("root").agg(F.min("first").alias("component_id"))
    of_point = of_point.join(firsts, "root").select("h", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "h").join(of_point, "h", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"))
