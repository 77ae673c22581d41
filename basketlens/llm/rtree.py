"""Hard-negative mining over STR-packed R-trees.

Rows are dealt to shards of about ``shard_rows`` by ranges of label and of the coordinate that spreads most, and every shard
packs one R-tree for each of its labels by sort-tile-recursive: rows are sorted and cut into slabs by one coordinate after
the other, the widest first, until a slab is a leaf; consecutive boxes make the boxes above. For an anchor, a box's
coordinates bound every inner product inside it from above and below. A best-first queue opens the box with the highest bound next,
and leaves out boxes that miss all score windows or lie strictly below the score that is kth by then.

One search finds the positives (own label, no window), a second one the negatives (other labels, a window for each
positive). A search goes in rounds over 1, 8, 64, ... shards' worth of rows in random order: each round starts from the kth
scores of those before, so an anchor's answers shuffled stay about ``growth * k`` a round however many shards there are. Within a round, shards
meet blocks of anchors: shard rows are held, anchors stream past.

Scores are integers: components become floor(scale * x). As long as no sum can pass 2**53 they are multiplied as doubles, which is
exact, otherwise as Python integers; a positive's score beyond 64 bits counts as the nearest 64-bit one, a negative's is returned as that.

Defined cases: rows whose id, label or vector is null, or whose vector holds a null or non-finite component, take no part. Rows that
share an id are one row, the smallest by label and vector. Shorter vectors count as padded with zeros. Equal scores go by
smaller id. An anchor without other rows of its label has no positive and no rows. Other columns play no part.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, small_batches
from basketlens.session import stored

LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    positives: int = 5
    negatives: int = 5
    low_percent: int = 80  # of the positive's score
    high_percent: int = 100
    scale: int = 256
    shard_rows: int = 8192
    leaf_rows: int = 64
    fanout: int = 8
    growth: int = 8  # of the shards from round to round
    block_anchors: int = 1 << 16


# one shard ------------------------------------------------------------------------------------


def tiled(vectors: np.ndarray, rows: np.ndarray, axes: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows in leaves: cut into slabs by the first axis, each slab by the next."""
    leaves = -(-len(rows) // leaf)
    if leaves <= 1:
        return [rows]
    slabs = max(2, math.ceil(leaves ** (1 / max(1, len(axes)))))
    order = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
    size = leaf * -(-leaves // slabs)
    rest = np.roll(axes, -1) if len(axes) == 1 else axes[1:]
    return [part for i in range(0, len(order), size) for part in tiled(vectors, order[i : i + size], rest, leaf)]


class Tree:
    """Boxes of one label's rows in a shard: node 0 is the root, and every leaf is a run of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings) -> None:
        spread = vectors.max(0) - vectors.min(0) if len(vectors) else np.zeros(vectors.shape[1])
        axes = np.argsort(-spread, kind="stable")
        deep = max(1, min(len(axes), math.ceil(math.log2(max(2, -(-len(ids) // settings.leaf_rows))))))
        leaves = tiled(vectors, np.arange(len(ids)), axes[:deep], settings.leaf_rows)
        order = np.concatenate(leaves)
        self.ids, self.vectors = ids[order], vectors[order]
        cuts = np.cumsum([0, *map(len, leaves)])
        low = [np.minimum.reduceat(self.vectors, cuts[:-1], axis=0)]
        high = [np.maximum.reduceat(self.vectors, cuts[:-1], axis=0)]
        while len(low[-1]) > 1:
            starts = np.arange(0, len(low[-1]), settings.fanout)
            low.append(np.minimum.reduceat(low[-1], starts, axis=0))
            high.append(np.maximum.reduceat(high[-1], starts, axis=0))
        self.low, self.high = np.concatenate(low[::-1]), np.concatenate(high[::-1])
        levels = [len(x) for x in low[::-1]]
        first = np.cumsum([0, *levels])
        self.leaf_from, self.cuts = int(first[-2]), cuts
        self.children: list[range] = []
        for depth, n in enumerate(levels[:-1]):
            for i in range(n):
                begin = int(first[depth + 1]) + i * settings.fanout
                self.children.append(range(begin, min(begin + settings.fanout, int(first[depth + 2]))))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of every query (row) with a point of every box (column)."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Best:
    """The k best (score, id) of one window: higher scores first, then smaller ids."""

    def __init__(self, low: int, high: int, k: int, bound: int) -> None:
        self.low, self.high, self.k, self.heap = max(low, bound), high, k, []

    @property
    def floor(self) -> int:
        """A score below this can't be among the k."""
        return max(self.low, self.heap[0][0]) if len(self.heap) == self.k else self.low

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        near = np.flatnonzero((scores >= self.floor) & (scores <= self.high))
        for i in near:
            entry = int(scores[i]), -int(ids[i])
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            elif entry > self.heap[0]:
                heapq.heapreplace(self.heap, entry)


def searched(trees: list[Tree], places: list[tuple], query: np.ndarray, own: int | None, wanted: list[Best]) -> int:
    """Fill ``wanted`` from all trees, best box first; gives back the number of leaves opened.

    ``places`` has each tree's (lowest, highest) bounds for this query.
    """
    opened = 0
    queue: list[tuple] = []

    def push(t: int, node: int) -> None:
        low, high = places[t][0][node], places[t][1][node]
        hopes = [min(high, b.high) for b in wanted if high >= b.floor and low <= b.high and b.floor <= b.high]
        if hopes:
            heapq.heappush(queue, (-max(hopes), t, node))

    for t in range(len(trees)):
        push(t, 0)
    while queue:
        bound, t, node = heapq.heappop(queue)
        if all(-bound < b.floor for b in wanted):
            break
        tree = trees[t]
        if node < tree.leaf_from:
            for child in tree.children[node]:
                push(t, child)
            continue
        low, high = places[t][0][node], places[t][1][node]
        need = [b for b in wanted if high >= b.floor and low <= b.high]
        if not need:
            continue
        opened += 1
        a, z = tree.cuts[node - tree.leaf_from], tree.cuts[node - tree.leaf_from + 1]
        ids, scores = tree.ids[a:z], tree.vectors[a:z] @ query
        if own is not None:
            others = ids != own
            ids, scores = ids[others], scores[others]
        for best in need:
            best.offer(ids, scores)
    return opened


def matrix(vectors: list[np.ndarray], dim: int, kind: type) -> np.ndarray:
    out = np.zeros((len(vectors), dim), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


# the table ------------------------------------------------------------------------------------


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, vec) of ``rows`` (id, label, embedding) that take part, one for each id."""
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    known = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
    one = known.groupBy("id").agg(F.min(F.struct("label", "embedding")).alias("one"))
    return one.select("id", "one.label", F.col("one.embedding").alias("embedding"))


def sharded(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` (id, label, vec) with shard and turn, the round in which a shard is searched."""
    totals = rows.select(F.posexplode("vec").alias("at", "x")).groupBy("at").agg(F.var_pop("x").alias("v"))
    widest = totals.agg(F.max_by("at", F.struct("v", -F.col("at")))).first()[0]  # one row for each coordinate before
    n = rows.count()
    shards = max(1, -(-n // settings.shard_rows))
    axis = F.coalesce(F.get("vec", F.lit(widest or 0)), F.lit(0.0))
    spread = rows.repartitionByRange(shards, "label", axis, "id").withColumn("shard", F.spark_partition_id())
    spread = stored(spread, "sharded")
    sizes = spread.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    # a row for each shard; rounds take 1, 8, 64, ... shards' worth of rows
    order = W.orderBy(F.xxhash64("shard"), "shard")
    turn = F.ceil(F.log(F.sum("n").over(order) / F.lit(settings.shard_rows)) / math.log(settings.growth))
    numbers = sizes.select("shard", (F.row_number().over(order) - 1).alias("number"), F.greatest(F.lit(0), turn).cast("int").alias("turn"))
    return spread.join(stored(numbers, "turns"), "shard").drop("shard").withColumnRenamed("number", "shard")


FOUND = "anchor long, place int, id long, score long"


def round_found(shards: DataFrame, asked: DataFrame, k: int, exact: bool, dim: int, settings: Settings) -> DataFrame:
    """(anchor, place, id, score): each shard's best rows for every window of every anchor in ``asked``.

    The shards' numbers are copied to every block of anchors and the anchors to every shard: a task holds one shard.
    """
    schema = to_arrow_schema(StructType.fromDDL(FOUND))
    kind = float if exact else object
    first, last = shards.agg(F.min("shard"), F.max("shard")).first()
    blocks = max(1, -(-asked.count() // settings.block_anchors))
    held = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "label", "vec")
    blank = [F.lit(None).cast("boolean").alias("same"), *(F.lit(None).cast("array<long>").alias(c) for c in ("lows", "highs", "bounds"))]
    held = held.select("shard", "block", F.lit(0).alias("kind"), "id", "label", "vec", *blank)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    streamed = asked.withColumn("block", block).withColumn("kind", F.lit(1))
    streamed = streamed.withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(last)))).select(held.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, labels, vectors = None, [], [], []
        trees: dict[int, Tree] | None = None
        for batch in batches:
            found = []
            columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            queries = []
            for i in range(batch.num_rows):
                here = columns["shard"][i].as_py(), columns["block"][i].as_py()
                if here != key:
                    found += answered(trees or {}, queries, k, kind, dim)
                    key, ids, labels, vectors, trees, queries = here, [], [], [], None, []
                vec = columns["vec"][i].values.to_numpy(zero_copy_only=False)
                if not columns["kind"][i].as_py():
                    ids.append(columns["id"][i].as_py())
                    labels.append(columns["label"][i].as_py())
                    vectors.append(vec)
                    continue
                if trees is None:
                    trees = planted(np.array(ids, np.int64), np.array(labels, np.int64), matrix(vectors, dim, float), kind, settings)
                queries.append([vec, *(columns[c][i].as_py() for c in ("id", "label", "same", "lows", "highs", "bounds"))])
                if len(queries) == 256:
                    found += answered(trees, queries, k, kind, dim)
                    queries = []
            found += answered(trees or {}, queries, k, kind, dim)
            if found:
                yield emit(found, schema)

    dealt = held.union(streamed).repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
    return small_batches(dealt).mapInArrow(run, FOUND)


def planted(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, kind: type, settings: Settings) -> dict[int, Tree]:
    return {int(x): Tree(ids[labels == x], whole(vectors[labels == x], kind), settings) for x in np.unique(labels)}


def whole(vectors: np.ndarray, kind: type) -> np.ndarray:
    """Whole numbers held as doubles, as doubles or as Python integers."""
    return vectors if kind is float else np.frompyfunc(int, 1, 1)(vectors)


def answered(trees: dict[int, Tree], queries: list[list], k: int, kind: type, dim: int) -> list[tuple]:
    if not queries or not trees:
        return []
    points = whole(matrix([q[0] for q in queries], dim, float), kind)
    bounds = {label: tree.bounds(points) for label, tree in trees.items()}
    found = []
    for i, (_, own, label, same, lows, highs, floors) in enumerate(queries):
        chosen = [x for x in trees if (x == label) == same]
        wanted = [Best(low, high, k, floor) for low, high, floor in zip(lows, highs, floors)]
        searched([trees[x] for x in chosen], [(bounds[x][0][i], bounds[x][1][i]) for x in chosen], points[i], own, wanted)
        for place, best in enumerate(wanted):
            found += [(own, place, -neg, max(LOW, min(HIGH, score))) for score, neg in best.heap]
    return found


def nearest(shards: DataFrame, asked: DataFrame, k: int, exact: bool, dim: int, settings: Settings) -> DataFrame:
    """(anchor, place, id, score, rank): the first k rows of every window, over all shards."""
    turns = [r.turn for r in shards.select("turn").distinct().orderBy("turn").collect()]  # one for each power of ``growth``
    found = None
    order = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    for turn in turns:
        if found is not None:
            full = found.where(F.col("rank") == k).select("anchor", "place", "score")
            full = full.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("full"))
            bound = lambda place, old: F.greatest(old, F.coalesce(F.col("full")[place], F.lit(LOW)))
            asked = asked.drop("full").join(full.withColumnRenamed("anchor", "id"), "id", "left")
            raised = F.transform("bounds", lambda x, i: F.when(F.col("full").isNull(), x).otherwise(bound(i, x)))
            asked = stored(asked.withColumn("bounds", raised).drop("full"), "asked")
        new = round_found(shards.where(F.col("turn") == turn), asked, k, exact, dim, settings)
        new = new if found is None else found.drop("rank").unionByName(new)
        found = stored(new.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")
    if found is None:
        return shards.sparkSession.createDataFrame([], FOUND + ", rank int")
    return found


def mined(rows: DataFrame, anchors: Column, settings: Settings = Settings()) -> DataFrame:
    """Hard negatives for the rows of ``rows`` (id, label, embedding) for which ``anchors`` holds, searched among all rows.

    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``rank`` counts an
    anchor's and positive's negatives from 1.
    """
    known = usable(rows.select("id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")))

    def floored(x: Column) -> Column:
        """floor(scale * x) as a double; from 2**52 on every double is a whole number."""
        most = F.lit(sys.float_info.max)
        return F.when(F.abs(x) < 2.0**52 / settings.scale, F.floor(x * settings.scale).cast("double")).otherwise(
            F.greatest(-most, F.least(most, x * settings.scale))
        )

    whole_numbers = F.transform("embedding", floored)
    shards = stored(sharded(known.select("id", "label", whole_numbers.alias("vec")), settings), "shards")
    size = shards.agg(F.max(F.size("vec")).alias("dim"), F.max(F.array_max(F.transform("vec", F.abs))).alias("most")).first()
    dim, most = size.dim or 1, size.most or 0.0
    exact = dim * most * most < 2.0**53

    start = shards.where(anchors).select("id", "label", "vec")
    one = lambda x: F.array(F.lit(x).cast("long"))
    start = start.select("*", F.lit(True).alias("same"), one(LOW).alias("lows"), one(HIGH).alias("highs"), one(LOW).alias("bounds"))
    start = stored(start, "anchors")
    positives = nearest(shards, start, settings.positives, exact, dim, settings)
    positives = positives.select("anchor", F.col("id").alias("positive"), F.col("score").alias("aim"), F.col("rank").alias("nth"))

    # windows low_percent * aim <= 100 * score <= high_percent * aim, in whole numbers
    wide = F.col("aim").cast("decimal(38,0)")
    low = -F.floor(-(wide * settings.low_percent) / 100)
    window = F.struct("nth", low.cast("long").alias("low"), F.floor(wide * settings.high_percent / 100).cast("long").alias("high"))
    sides = positives.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(window)).alias("w"))
    asked = start.select("id", "label", "vec").join(sides, "id")
    asked = asked.select("id", "label", "vec", F.lit(False).alias("same"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    asked = stored(asked.withColumn("bounds", F.transform("lows", lambda x: F.lit(LOW).cast("long"))), "asked")
    negatives = nearest(shards, asked, settings.negatives, exact, dim, settings)

    met = negatives.select("anchor", (F.col("place") + 1).alias("nth"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    return positives.join(met, ["anchor", "nth"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("aim").alias("positive_score"),
        "negative_score",
    )
