"""Boosted regression trees grown for many settings and folds at once.

Features are cut into quantile bins once. Then every level of every tree of all fits is one aggregate:
tasks add up gradients and rows by (fit, node, feature, bin), the sums are shuffled, and the best
split of a node comes from running sums over its bins. What reaches the driver is one row per fit and node of a
level, a number that the settings bound (fits times 2^depth), never the training rows.

A split gains G_l^2 / (N_l + penalty) + G_r^2 / (N_r + penalty) - G^2 / (N + penalty), halved, less ``least_gain``;
a leaf says -G / (N + penalty), where G sums prediction minus label and N counts rows. Values not above a
cut go left; missing ones (null or NaN) go where the gain is larger. Ties take the first feature, then the
lowest cut, then missing values to the left.

Gradients are summed as whole numbers of 2^-20, so no sum depends on the order of tasks, and a
repeated task or run gives the same trees. Rows and features are sampled by hashes of the row's key.

A fold is a number per row, not a table: a crossed fit leaves its fold out and is judged on it; an expanding fit f
learns from stretches 0 to f and is judged on f + 1. Rows marked as holdout are learned from by no fit; they tell when to
stop: after ``patience`` rounds without a gain there, keeping the trees up to the best round.

Defined cases: rows without label are left out. No training rows: the fit predicts 0. No holdout
rows: all rounds are kept. A feature that is always missing, or has one value, is never split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from basketlens.operators.quantiles import quantile_rows
from basketlens.session import stored

SCALE = 1 << 20
SUMS = "fit int, node int, feature int, bin int, g long, n long"
CELLS = 1 << 21  # sums held by a task before it passes them on
HELD, JUDGED = 0, 1


@dataclass(frozen=True)
class Setting:
    """How one ensemble is grown; ``columns`` is the share of features for a tree, or for a node with ``by_node``."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    child_rows: int = 1
    split_rows: int = 2
    rows: float = 1.0
    columns: float = 1.0
    by_node: bool = False
    least_gain: float = 0.0
    penalty: float = 1.0


@dataclass
class Tree:
    """Splits and values by node; the root is 1 and the children of i are 2 i and 2 i + 1."""

    splits: dict[int, tuple[int, int, bool]] = field(default_factory=dict)  # feature, bin, missing to the left
    values: dict[int, float] = field(default_factory=lambda: {1: 0.0})

    def arrays(self) -> tuple[np.ndarray, ...]:
        size = max(self.values) + 1
        feature, cut = np.full(size, -1), np.zeros(size, np.int64)
        missing, value = np.zeros(size, bool), np.zeros(size)
        for node, split in self.splits.items():
            feature[node], cut[node], missing[node] = split
        for node, v in self.values.items():
            value[node] = v
        return feature, cut, missing, value


def leaves(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The node every row of ``bins`` ends in."""
    feature, cut, missing, _ = tree
    node = np.ones(len(bins), np.int64)
    moving = np.flatnonzero(feature[node] >= 0)
    while len(moving):
        here = node[moving]
        x = bins[moving, feature[here]]
        left = np.where(x == 0, missing[here], x <= cut[here])
        node[moving] = 2 * here + ~left
        moving = moving[feature[node[moving]] >= 0]
    return node


def hashed(*parts: int | np.ndarray) -> np.ndarray:
    """A number in [0, 1) for every combination of the parts."""
    x = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (x ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    return x / 2.0**64


@dataclass
class Fit:
    """One setting on one fold; ``fold`` None learns from all rows."""

    number: int
    setting: Setting
    fold: int | None
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    held: list[float] = field(default_factory=list)  # error on the holdout after 0, 1, ... trees
    judged: list[float] = field(default_factory=list)  # error on the rows of the fold left out
    done: bool = False

    def best(self) -> int:
        """The number of trees with the least error on the holdout."""
        return self.held.index(min(self.held)) if self.held and not math.isnan(self.held[0]) else len(self.trees)

    def error(self) -> float:
        """The error of the kept trees on the rows left out."""
        return self.judged[self.best()]


@dataclass(frozen=True)
class Ensemble:
    """A grown ensemble by itself."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    base: float
    rate: float
    trees: tuple[Tree, ...]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction; other columns pass as they are."""
        names, place = df.columns, [df.columns.index(c) for c in self.features]
        schema = StructType([*df.drop(out).schema.fields, StructField(out, DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = [tree.arrays() for tree in self.trees]
            for batch in batches:
                bins = binned([batch.column(i) for i in place], self.cuts)
                total = np.full(len(bins), self.base)
                for tree in trees:
                    total += self.rate * tree[3][leaves(tree, bins)]
                kept = [i for i, c in enumerate(names) if c != out]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(total)], [*(names[i] for i in kept), out])

        return df.mapInArrow(run, schema)


def binned(columns: Sequence[pa.Array], cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of every value: 0 for missing ones, else 1 and the number of cuts below it."""
    bins = np.zeros((len(columns[0]), len(columns)), np.uint8)
    for j, (column, own) in enumerate(zip(columns, cuts)):
        values = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
        bins[:, j] = np.where(np.isnan(values), 0, np.searchsorted(np.asarray(own, float), values, "left") + 1)
    return bins


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> tuple[tuple[float, ...], ...]:
    """Distinct exact quantiles of each feature, ``bins`` - 1 at most."""
    if not 2 <= bins <= 255:
        raise ValueError("a bin is one byte: 2 to 255 of them")
    # NaN counts as missing and would otherwise be the largest value
    known = rows.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in features])
    rows = quantile_rows(known, features, [i / bins for i in range(1, bins)]).collect()  # bins rows a feature
    return tuple(tuple(sorted({r.value for r in rows if r.name == c})) for c in features)


class Boosting:
    """``rows`` in bins, ready to grow fits on.

    ``rows`` needs the features, ``label``, ``fold`` (int), ``holdout`` (boolean) and ``key`` (long, of its own for
    every row); the binned rows are stored once.
    """

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, *, bins: int = 32, seed: int = 42) -> None:
        self.features, self.seed = tuple(features), seed
        rows = rows.where(F.col(label).isNotNull())
        self.cuts = quantile_cuts(rows.where("not holdout"), features, bins)
        self.width = max(map(len, self.cuts), default=0) + 2
        cuts, wide = self.cuts, len(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = binned(batch.columns[:wide], cuts)
                data = pa.array([row.tobytes() for row in found], pa.binary())
                yield pa.RecordBatch.from_arrays([data, *batch.columns[wide:]], ["bins", "y", "fold", "holdout", "key"])

        sent = rows.select(
            *[F.col(c).cast("double") for c in features], F.col(label).cast("double").alias("y"), F.col("fold").cast("int"),
            F.coalesce("holdout", F.lit(False)).alias("holdout"), F.col("key").cast("long"),
        )
        self.rows = stored(sent.mapInArrow(run, "bins binary, y double, fold int, holdout boolean, key long"), "bins")

    def grow(
        self, settings: Sequence[Setting], folds: Sequence[int | None], *, expanding: bool = False, patience: int = 50, kept: int = 8
    ) -> list[Fit]:
        """One fit for every setting and fold. Predictions so far are stored every ``kept`` rounds."""
        fits = [Fit(i, s, f) for i, (s, f) in enumerate((s, f) for s in settings for f in folds)]
        self._start(fits, expanding)
        rows = self.rows.withColumn("margins", F.expr(f"array({', '.join(f'{f.base!r}D' for f in fits)})"))
        stored_to, turn = 0, 0
        while any(not f.done for f in fits):
            going = [f for f in fits if not f.done]
            if turn - stored_to == kept:
                rows, stored_to = stored(self._with_margins(rows, fits, stored_to, turn), "margins"), turn
            trees = {f.number: Tree() for f in going}
            open_nodes: dict[int, list[int]] = {f.number: [1] for f in going}
            level = 0
            while open_nodes:
                sums = self._sums(rows, fits, stored_to, turn, trees, open_nodes, level, expanding)
                found = self._best(sums, fits).collect()  # a row per fit and open node, and two errors per fit
                if level == 0:
                    self._note(found, fits, open_nodes, patience)
                open_nodes = self._split(found, fits, trees, open_nodes, level)
                level += 1
            for f in going:
                if not f.done:
                    f.trees.append(trees[f.number])
            turn += 1
        return fits

    def ensemble(self, fit: Fit) -> Ensemble:
        return Ensemble(self.features, self.cuts, fit.base, fit.setting.rate, tuple(fit.trees[: fit.best()]))

    def first_splits(self, settings: Sequence[Setting], folds: Sequence[int | None], *, expanding: bool = False) -> DataFrame:
        """The root's best split for every setting and fold: fit, best (gain, -feature, -bin, missing_left and the sums of
        both sides), total."""
        fits = [Fit(i, s, f) for i, (s, f) in enumerate((s, f) for s in settings for f in folds)]
        self._start(fits, expanding)
        rows = self.rows.withColumn("margins", F.expr(f"array({', '.join(f'{f.base!r}D' for f in fits)})"))
        sums = self._sums(rows, fits, 0, 0, {f.number: Tree() for f in fits}, {f.number: [1] for f in fits}, 0, expanding)
        return self._best(sums, fits).where("node = 1")

    # ------------------------------------------------------------------------------------

    def _start(self, fits: list[Fit], expanding: bool) -> None:
        units = F.round(F.col("y") * SCALE).cast("long")
        totals = self.rows.where("not holdout").groupBy("fold").agg(F.sum(units).alias("g"), F.count("y").alias("n")).collect()
        for f in fits:
            own = [r for r in totals if learns(r.fold, f.fold, expanding)]
            n = sum(r.n for r in own)
            f.base = sum(r.g for r in own) / SCALE / n if n else 0.0

    def _with_margins(self, rows: DataFrame, fits: list[Fit], begin: int, end: int) -> DataFrame:
        recent = {f.number: (f.setting.rate, [t.arrays() for t in f.trees[begin:end]]) for f in fits}
        wide, count = len(self.features), len(fits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, margins = unpacked(batch, wide, count)
                for k, (rate, trees) in recent.items():
                    for tree in trees:
                        margins[:, k] += rate * tree[3][leaves(tree, bins)]
                offsets = pa.array(np.arange(0, margins.size + 1, count), pa.int32())
                moved = pa.ListArray.from_arrays(offsets, pa.array(margins.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], moved], batch.schema.names)

        return rows.mapInArrow(run, rows.schema)

    def _sums(
        self, rows: DataFrame, fits: list[Fit], begin: int, turn: int, trees: Mapping[int, Tree], open_nodes: Mapping[int, list[int]],
        level: int, expanding: bool,
    ) -> DataFrame:
        """(fit, node, feature, bin, g, n) over the rows that each fit learns from; at the root also, as node 0, the
        squared errors on holdout and judged rows."""
        wide, width, seed, count = len(self.features), self.width, self.seed, len(fits)
        jobs = []
        for f in fits:
            if f.number in open_nodes:
                nodes = open_nodes[f.number]
                share = max(1, math.ceil(f.setting.columns * wide))
                draws = [hashed(seed, f.number, turn, n if f.setting.by_node else 0, np.arange(wide)) for n in nodes]
                allowed = np.array([np.argsort(np.argsort(d, kind="stable"), kind="stable") < share for d in draws])
                past = [t.arrays() for t in f.trees[begin:turn]]
                jobs.append((f.number, f.setting, f.fold, past, trees[f.number].arrays(), nodes, allowed))

        def emitted(sums: dict) -> Iterator[pa.RecordBatch]:
            for k, nodes, g, n in sums.values():
                at = np.flatnonzero(n)
                slot, feature, b = at // (wide * width), at // width % wide, at % width
                yield table(k, np.asarray(nodes)[slot], feature, b, g[at], n[at])
            sums.clear()

        def table(k: int, *columns) -> pa.RecordBatch:
            kinds = [pa.int32()] * 3 + [pa.int64()] * 2
            arrays = [pa.array(np.asarray(c).astype(t.to_pandas_dtype())) for c, t in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(arrays[0]), k, np.int32)), *arrays], ["fit", "node", "feature", "bin", "g", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict = {}
            errors = np.zeros((count, 2, 2), np.int64)
            for batch in batches:
                bins, margins = unpacked(batch, wide, count)
                y, fold, held, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))
                held = held.astype(bool)
                for k, setting, own, past, tree, nodes, allowed in jobs:
                    margin = margins[:, k].copy()
                    for done in past:
                        margin += setting.rate * done[3][leaves(done, bins)]
                    learning = learns(fold, own, expanding)
                    if level == 0:
                        squares = np.rint((margin - y) ** 2 * SCALE).astype(np.int64)
                        for kind, which in ((HELD, held & learning), (JUDGED, ~held & judges(fold, own, expanding))):
                            errors[k, kind] += squares[which].sum(), which.sum()
                    place = np.full(max(nodes) * 2 + 2, -1)
                    place[nodes] = np.arange(len(nodes))
                    slot = place[leaves(tree, bins)]
                    take = learning & ~held & (slot >= 0)
                    if setting.rows < 1:
                        take &= hashed(seed, k, turn, key) < setting.rows
                    slot = slot[take]
                    at = (slot[:, None] * wide + np.arange(wide)) * width + bins[take]
                    units = np.rint((margin - y) * SCALE)[take]
                    use = allowed[slot]
                    size = len(nodes) * wide * width
                    # whole numbers below 2^53 stay exact as doubles within a batch
                    g = np.bincount(at[use], np.broadcast_to(units[:, None], at.shape)[use], size).astype(np.int64)
                    n = np.bincount(at[use], minlength=size)
                    if k in sums:
                        sums[k][2][:] += g
                        sums[k][3][:] += n
                    else:
                        sums[k] = (k, nodes, g, n)
                    if sum(len(s[2]) for s in sums.values()) > CELLS:
                        yield from emitted(sums)
            yield from emitted(sums)
            for k, *_ in jobs if level == 0 else ():
                yield table(k, [0, 0], [0, 0], [HELD, JUDGED], errors[k, :, 0], errors[k, :, 1])

        parts = rows.mapInArrow(run, SUMS)
        return parts.groupBy("fit", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))

    def _best(self, sums: DataFrame, fits: list[Fit]) -> DataFrame:
        """(fit, node, best, total) of the nodes; for node 0 ``errors``, a map from kind to sum and number."""
        limits = {  # one array each, a constant in the plan
            name: F.expr(f"array({', '.join(f'{getattr(f.setting, name)!r}{kind}' for f in fits)})[fit]")
            for name, kind in (("penalty", "D"), ("least_gain", "D"), ("child_rows", ""), ("split_rows", ""))
        }
        cells = Window.partitionBy("fit", "node", "feature")
        upto = cells.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        missing = lambda c: F.sum(F.when((F.col("bin") == 0) & (F.col("node") > 0), F.col(c)).otherwise(0)).over(cells)
        ways = F.array(
            F.struct(F.lit(True).alias("missing_left"), F.col("gu").alias("gl"), F.col("nu").alias("nl")),
            F.struct(F.lit(False).alias("missing_left"), (F.col("gu") - F.col("gm")).alias("gl"), (F.col("nu") - F.col("nm")).alias("nl")),
        )
        sides = (
            sums.withColumns({"gu": F.sum("g").over(upto), "nu": F.sum("n").over(upto), "gt": F.sum("g").over(cells),
                              "nt": F.sum("n").over(cells), "gm": missing("g"), "nm": missing("n")})
            .withColumn("way", F.explode(ways))
            .select("*", "way.*", (F.col("gt") - F.col("way.gl")).alias("gr"), (F.col("nt") - F.col("way.nl")).alias("nr"))
            .withColumns(limits)
        )
        real = lambda c: F.col(c) / F.lit(float(SCALE))
        part = lambda g, n: real(g) * real(g) / (F.col(n) + F.col("penalty"))
        gain = F.lit(0.5) * (part("gl", "nl") + part("gr", "nr") - part("gt", "nt")) - F.col("least_gain")
        possible = (F.col("nl") >= F.greatest("child_rows", F.lit(1))) & (F.col("nr") >= F.greatest("child_rows", F.lit(1)))
        possible &= (F.col("nt") >= F.col("split_rows")) & (F.col("node") > 0)
        found = F.when(possible, gain)
        best = F.struct(
            found.alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "missing_left", "gl", "nl", "gr", "nr"
        )
        errors = F.map_from_entries(F.collect_list(F.when((F.col("node") == 0) & F.col("missing_left"), F.struct("bin", F.struct("g", "n")))))
        return sides.groupBy("fit", "node").agg(
            F.max(F.when(found > 0, best)).alias("best"), F.max(F.struct("gt", "nt")).alias("total"), errors.alias("errors")
        )

    def _note(self, found: list, fits: list[Fit], open_nodes: dict[int, list[int]], patience: int) -> None:
        """Errors after the trees so far; fits that are finished leave."""
        for r in found:
            if r.node == 0:
                f = fits[r.fit]
                for kind, into in ((HELD, f.held), (JUDGED, f.judged)):
                    g, n = r.errors[kind]
                    into.append(math.sqrt(g / SCALE / n) if n else math.nan)
                f.done = len(f.trees) >= f.setting.rounds or len(f.trees) - f.best() >= patience
        for f in fits:
            if f.number in open_nodes and (f.done or len(f.held) <= len(f.trees)):  # without rows there are no errors
                f.done = True
                del open_nodes[f.number]

    def _split(
        self, found: list, fits: list[Fit], trees: dict[int, Tree], open_nodes: dict[int, list[int]], level: int
    ) -> dict[int, list[int]]:
        """Apply the best splits; the nodes to look at next, by fit."""
        after: dict[int, list[int]] = {}
        for r in sorted((r for r in found if r.node and r.fit in open_nodes), key=lambda r: (r.fit, r.node)):
            setting, tree, penalty = fits[r.fit].setting, trees[r.fit], fits[r.fit].setting.penalty
            if level == 0:
                tree.values[1] = leaf(r.total.gt, r.total.nt, penalty)
            if r.best is None:
                continue
            left, right = 2 * r.node, 2 * r.node + 1
            tree.splits[r.node] = (-r.best.feature, -r.best.bin, r.best.missing_left)
            tree.values[left] = leaf(r.best.gl, r.best.nl, penalty)
            tree.values[right] = leaf(r.best.gr, r.best.nr, penalty)
            if level + 1 < setting.depth:
                after.setdefault(r.fit, []).extend([left, right])
        return after


def learns(fold: int | np.ndarray, own: int | None, expanding: bool) -> bool | np.ndarray:
    """Whether a fit learns from rows of a fold."""
    if own is None:
        return fold == fold
    return fold <= own if expanding else fold != own


def judges(fold: np.ndarray, own: int | None, expanding: bool) -> np.ndarray:
    if own is None:
        return fold != fold
    return fold == (own + 1 if expanding else own)


def leaf(g: int, n: int, penalty: float) -> float:
    return -(g / SCALE) / (n + penalty) if n else 0.0


def unpacked(batch: pa.RecordBatch, wide: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and margins of a batch, a row each; the margins may be written to."""
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, wide)
    return bins, batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, count).copy()
