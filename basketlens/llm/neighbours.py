"""Near-duplicate embeddings by NN-descent.

1. Vectors that are equal in label and components form a class, stood for by its smallest id and a count.
2. Every vector starts with neighbours from a few random hyperplane tables, whose buckets hold
   a bounded number of vectors on average at any input size. The number of tables grows with that of hyperplanes, so that a
   lone pair at the threshold is missed by all with a chance of ``miss``. A bucket out of bounds
   is split by further hyperplanes through one of its vectors until it is within them.
3. NN-descent: around every vector its neighbours and those whose neighbour it is are joined with each
   other, and each keeps the ``neighbours`` most similar ones it has met; repeated until lists
   hardly change. Neighbours below ``explore`` are not kept: they lead to no link.
4. Where a list is saturated, full of links to the last place, there may be more. The components of
   such lists are searched again for links to other ones only, and merged, until there are none;
   then their vectors are compared block by block, and links are counted, never listed.
5. The recall is audited by brute force for a bounded number of vectors against all, drawn
   independently of what was found; below ``recall`` the search goes on with more tables.

Links are edges with a cosine, in double precision, of at least ``threshold`` between vectors of one label;
components are found by alternating large-star and small-star.

Defined cases: a null label, a null vector, null or non-finite components and zero vectors link
with nothing, as do vectors of different length. Copies link with each other. A null vec_id
links with nothing, has no component and is kept. Rows that share a vec_id are vectors of their own that reach each
other. Other columns of the input play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit
from basketlens.llm.components import connected
from basketlens.session import stored


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    explore: float = 0.9
    neighbours: int = 12
    tables: int = 8
    bucket: int = 64
    settled: float = 0.001
    block: int = 512
    miss: float = 0.01
    audit: int = 1024
    audit_linked: int = 100
    most_audit: int = 16384
    recall: float = 0.95
    attempts: int = 3


LISTS = "id long, others array<long>, sims array<double>"


def unit(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def cleaned(table: DataFrame) -> DataFrame:
    """(vec_id, same, label, vector): unit vectors in double precision; ``same`` is null if it links with nothing."""
    kinds = {c: table.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    out = StructType.fromDDL(f"vec_id {kinds['vec_id']}, same binary, label {kinds['label']}, vector binary")
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, vector, label in zip(*(c.to_pylist() for c in batch.columns)):
                same = data = None
                if vec_id is not None and label is not None and vector and None not in vector:
                    x = np.array(vector, np.float64)
                    most = np.abs(x).max()
                    if np.isfinite(most) and most > 0:
                        same = xxhash.xxh3_128_digest(x.tobytes() + repr(label).encode())
                        x = x / most  # no overflow in the norm
                        data = (x / np.sqrt((x * x).sum())).tobytes()
                rows.append((vec_id, same, label, data))
            yield emit(rows, schema)

    return table.select("vec_id", "embedding", "label").mapInArrow(run, out)


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first ``n_keys`` columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, key=lambda row: row[:n_keys])


def best(ids: np.ndarray, sims: np.ndarray, own: int, k: int, least: float) -> tuple[list[int], list[float]]:
    """The k most similar ids, each once, the node itself left out."""
    good = np.flatnonzero((sims >= least) & (ids != own))
    good = good[np.lexsort((ids[good], -sims[good]))]
    _, first = np.unique(ids[good], return_index=True)
    good = good[np.sort(first)[:k]]
    return ids[good].tolist(), sims[good].tolist()


def joined(rows: list[tuple[int, int, bytes, float]], k: int, explore: float) -> Iterator[tuple]:
    """Lists that come of comparing vectors (id, part, vector, worst similarity kept) of different parts with each other."""
    parts = np.array([row[1] for row in rows], np.int64)
    if (parts == parts[0]).all():
        return
    ids = np.array([row[0] for row in rows], np.int64)
    x = unit([row[2] for row in rows])
    sims = np.where(parts[:, None] != parts, x @ x.T, -2.0)
    worst = np.array([row[3] for row in rows])
    for i in np.flatnonzero((sims > worst[:, None]).any(1)):
        others, values = best(ids, sims[i], ids[i], k, max(explore, worst[i]))
        if others:
            yield int(ids[i]), others, values


def runs(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    """Runs of at most ``size`` rows, of which adjoining ones share half."""
    run: list[tuple] = []
    fresh = False
    for row in rows:
        run.append(row)
        fresh = True
        if len(run) == size:
            yield run
            run, fresh = run[size // 2 :], False
    if fresh:
        yield run


PLACE = ["label", "dim", "code"]


def place_type(rows: DataFrame) -> str:
    return f"label {rows.schema['label'].dataType.simpleString()}, dim int, code long, id long"


def code_of(*numbers: int) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(np.array(numbers, np.int64).tobytes())).astype(np.int64))


def dealt(nodes: DataFrame, settings: Settings, attempt: int) -> DataFrame:
    """(label, dim, code, id): the place of every node in each of its label's hyperplane tables."""
    schema = to_arrow_schema(StructType.fromDDL(place_type(nodes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            out = []
            for id_, label, dim, bits, tables, vector in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(vector, np.float64)
                for t in range(attempt * tables, (attempt + 1) * tables):
                    if (t, dim) not in planes:
                        planes[t, dim] = np.random.default_rng([t, dim]).standard_normal((62, dim))
                    code = int((planes[t, dim][:bits] @ x > 0) @ (1 << np.arange(bits))) if bits else 0
                    out.append((label, dim, code_of(t, code), id_))
            yield emit(out, schema)

    return nodes.select("id", "label", "dim", "bits", "tables", "vector").mapInArrow(run, place_type(nodes))


def refined(places: DataFrame, vectors: DataFrame, settings: Settings) -> DataFrame:
    """``places`` (label, dim, code, id) with oversized ones split by hyperplanes through one of their own vectors.

    Repeated until all are within bounds. A place that such planes leave whole holds vectors
    that are equal up to rounding; it stays, and its adjoining runs share half.
    """
    most = 8 * settings.bucket
    split = place_type(places) + ", whole long"
    schema = to_arrow_schema(StructType.fromDDL(split))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for label, dim, code, id_, vector, middle, n in zip(*(c.to_pylist() for c in batch.columns)):
                if code not in planes:
                    if len(planes) == 5000:
                        planes.clear()
                    bits = 1 + math.ceil(math.log2(n / most))
                    planes[code] = np.random.default_rng([code & (2**63 - 1), dim]).standard_normal((bits, dim))
                sides = planes[code] @ (np.frombuffer(vector, np.float64) - np.frombuffer(middle, np.float64)) > 0
                out.append((label, dim, code_of(code, int(sides @ (1 << np.arange(len(sides))))), id_, n))
            yield emit(out, schema)

    rest, within = places.withColumn("whole", F.lit(0).cast("long")), []
    while True:
        rest = stored(rest, "places")
        pivot = F.min_by("id", F.xxhash64("id", "code")).alias("pivot")
        counts = rest.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("n"), F.max("whole").alias("before"), pivot)
        big = stored(counts.where((F.col("n") > most) & (F.col("n") != F.col("before"))), "big")
        if big.isEmpty():
            break
        within.append(rest.join(big, PLACE, "left_anti"))
        middles = big.join(vectors.select(F.col("id").alias("pivot"), F.col("vector").alias("middle")), "pivot")
        inside = rest.join(middles, PLACE).join(vectors, "id")
        rest = inside.select(*PLACE, "id", "vector", "middle", "n").mapInArrow(run, split)
    for each in within:
        rest = rest.unionByName(each)
    return rest.drop("whole")


def met(places: DataFrame, state: DataFrame, settings: Settings) -> DataFrame:
    """Lists found by joining all of one place; ``state`` has id, part, vector and worst."""
    lists = to_arrow_schema(StructType.fromDDL(LISTS))
    k, explore, most = settings.neighbours, settings.explore, 8 * settings.bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, 3):
            found = [each for part in runs(rows, most) for each in joined([row[3:] for row in part], k, explore)]
            if found:
                yield emit(found, lists)

    rows = places.join(state.select("id", "part", "vector", "worst"), "id").select(*PLACE, "id", "part", "vector", "worst")
    return rows.repartition(*PLACE).sortWithinPartitions(*PLACE, "id").mapInArrow(run, LISTS)


def merged(lists: DataFrame, settings: Settings) -> DataFrame:
    """One list per node: the best of all its lists."""
    schema = to_arrow_schema(StructType.fromDDL(LISTS))
    k, explore = settings.neighbours, settings.explore

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (own,), rows in grouped(batches, 1):
            others, sims = [], []
            for _, more, values in rows:
                others, sims = best(np.array(others + more, np.int64), np.array(sims + values), own, k, explore)
            out.append((own, others, sims))
            if len(out) == 2000:
                yield emit(out, schema)
                out = []
        if out:
            yield emit(out, schema)

    return lists.repartition("id").sortWithinPartitions("id").mapInArrow(run, LISTS)


def searched(members: DataFrame, places: DataFrame, known: DataFrame, first: DataFrame, settings: Settings) -> DataFrame:
    """The lists ``first`` and what ``places`` hold, improved by NN-descent until they settle.

    ``members`` has id, label, dim, part and vector; only vectors of different parts get into lists. Around every
    node all are joined that are its neighbours or have it as theirs, in these lists or the ``known`` ones.
    """
    explore, size = settings.explore, F.size("others")
    vectors = members.select("id", "vector")
    fresh = met(places, members.withColumn("worst", F.lit(explore)), settings)
    lists = stored(merged(first.union(fresh), settings), "lists")
    total = members.count()
    while True:
        worst = F.when(size >= settings.neighbours, F.array_min("sims")).otherwise(F.lit(explore))
        state = members.join(lists.select("id", worst.alias("worst")), "id", "left").fillna(explore, ["worst"])
        edges = known.union(lists).select(F.col("id").alias("u"), F.explode("others").alias("v"))
        both = edges.union(edges.select("v", "u")).union(members.select(F.col("id").alias("u"), F.col("id").alias("v"))).distinct()
        around = both.join(members.select(F.col("id").alias("u"), "label", "dim"), "u")
        around = refined(around.select("label", "dim", F.col("u").alias("code"), F.col("v").alias("id")), vectors, settings)
        better = stored(merged(lists.union(met(around, state, settings)), settings), "lists")
        old = lists.select("id", F.col("others").alias("old"))
        changed = better.join(old, "id", "left").where(~F.col("others").eqNullSafe(F.col("old"))).count()
        lists = better
        if changed <= settings.settled * total:
            return lists


def linked(lists: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): the links in lists, smaller id first."""
    pairs = lists.select("id", F.explode(F.arrays_zip("others", "sims")).alias("p")).where(F.col("p.sims") >= settings.threshold)
    return pairs.select(F.least("id", "p.others").alias("a"), F.greatest("id", "p.others").alias("b")).distinct()


def spread(nodes: DataFrame, places: DataFrame, lists: DataFrame, links: DataFrame, settings: Settings) -> tuple[DataFrame, ...]:
    """Links, components and open components, once no list is saturated across the border of a component.

    A component is open if one of its lists is full of links, which may have displaced others. Open
    components are searched again for links to each other only, which those inside cannot displace, and
    merged by them, until none is found.
    """
    full = (F.size("others") >= settings.neighbours) & (F.array_min("sims") >= settings.threshold)
    full = stored(lists.where(full).select("id"), "full")
    known = lists
    while True:
        component = stored(connected(links).withColumnRenamed("node", "id"), "parts")
        open_ = stored(component.join(full, "id", "left_semi").select("component").distinct(), "open")
        members = component.join(open_, "component", "left_semi").join(nodes.select("id", "label", "dim", "vector"), "id")
        members = stored(members.withColumnRenamed("component", "part"), "members")
        several = members.groupBy("label", "dim").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b")
        members = members.join(several, ["label", "dim"], "left_semi")
        if members.isEmpty():
            return links, component, open_
        own = members.select("id")
        inner = known.join(own, "id", "left_semi")
        outer = searched(members, places.join(own, "id", "left_semi").select(*PLACE, "id"), inner, lists.limit(0), settings)
        fresh = stored(linked(outer, settings), "links")
        if fresh.isEmpty():
            return links, component, open_
        links = stored(links.union(fresh).distinct(), "links")
        known = known.union(outer)


def counted(members: DataFrame, settings: Settings) -> DataFrame:
    """(id, weight): weight of the linked vectors of every member's component, block against block.

    ``members`` has component, id, vector and n. Each block pair is one group; what leaves it is a
    number per vector.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    cuts = stored(sizes.select("component", F.ceil(F.col("size") / settings.block).cast("int").alias("cuts")), "cuts")
    rows = members.join(cuts, "component").withColumn("own", F.pmod(F.xxhash64("id"), "cuts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    asked = rows.select("component", F.col("own").alias("i"), every.alias("j"), F.lit(True).alias("query"), "id", "vector", "n")
    met = rows.select("component", every.alias("i"), F.col("own").alias("j"), F.lit(False).alias("query"), "id", "vector", "n")
    schema = to_arrow_schema(StructType.fromDDL("id long, weight long"))
    threshold = settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in grouped(batches, 3):
            ids, vectors, others, weights = [], [], [], []
            for *_, query, id_, vector, n in block:
                if query:
                    ids.append(id_)
                    vectors.append(vector)
                else:
                    others.append((id_, vector))
                    weights.append(n)
            if ids and others:
                near = unit(vectors) @ unit([v for _, v in others]).T >= threshold
                near &= np.array(ids)[:, None] != np.array([i for i, _ in others])
                yield emit(list(zip(ids, (near @ np.array(weights, np.int64)).tolist())), schema)

    keys = ["component", "i", "j"]
    dealt = asked.union(met).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "id long, weight long").groupBy("id").agg(F.sum("weight").alias("weight"))


def resolved(nodes: DataFrame, links: DataFrame, component: DataFrame, open_: DataFrame, settings: Settings) -> DataFrame:
    """(id, component, weight) of every node that has a link."""
    weights = nodes.select("id", "n")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    closed = component.join(open_, "component", "left_anti").select("id")
    listed = both.join(closed, F.col("a") == F.col("id"), "left_semi").join(weights, F.col("b") == F.col("id"))
    listed = listed.groupBy("a").agg(F.sum("n").alias("weight")).select(F.col("a").alias("id"), "weight")
    members = component.join(open_, "component", "left_semi").join(nodes.select("id", "vector", "n"), "id")
    weight = listed.union(counted(members, settings))
    return stored(component.join(weight, "id").select("id", "component", "weight"), "resolved")


def audited(nodes: DataFrame, found: DataFrame, settings: Settings) -> float:
    """Recall of links, the lower of that by vector and that by link, for random vectors against all.

    The vectors are drawn by hashes of their ids, whatever was found. The draw grows until ``audit_linked`` of
    them have a link in truth, it holds ``most_audit`` or it holds all.
    """
    size = settings.audit
    while True:
        drawn = nodes.orderBy(F.xxhash64("id", F.lit(9)), "id").limit(size)
        asked = [(r.id, r.label, r.dim, bytes(r.vector)) for r in drawn.select("id", "label", "dim", "vector").collect()]
        sums = compared(nodes, asked, settings.threshold).join(found, "id", "left").where("truth > 0")
        hit = F.least("truth", F.coalesce("weight", F.lit(0)))
        sums = sums.agg(F.count(F.lit(1)), F.avg(hit / F.col("truth")), F.sum(hit) / F.sum("truth")).first()
        if sums[0] >= settings.audit_linked or len(asked) < size or size >= settings.most_audit:
            return min(sums[1], sums[2]) if sums[0] else 1.0
        size = min(4 * size, settings.most_audit)


def compared(nodes: DataFrame, asked: list[tuple], threshold: float, block: int = 1024) -> DataFrame:
    """(id, truth): weight of all vectors linked with those asked for (id, label, dim, vector), block against block."""
    schema = to_arrow_schema(StructType.fromDDL("id long, truth long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: dict[tuple, list[tuple]] = {}
        for id_, label, dim, vector in asked:
            queries.setdefault((label, dim), []).append((id_, vector))
        total = dict.fromkeys((r[0] for r in asked), 0)
        for batch in batches:
            groups: dict[tuple, list[tuple]] = {}
            for id_, label, dim, vector, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (label, dim) in queries:
                    groups.setdefault((label, dim), []).append((id_, vector, n))
            for key, rows in groups.items():
                for i in range(0, len(queries[key]), block):
                    some = queries[key][i : i + block]
                    x, ids = unit([q[1] for q in some]), np.array([q[0] for q in some])
                    for j in range(0, len(rows), block):
                        own = rows[j : j + block]
                        near = x @ unit([r[1] for r in own]).T >= threshold
                        near &= ids[:, None] != np.array([r[0] for r in own])
                        for q, n in zip(some, near @ np.array([r[2] for r in own], np.int64)):
                            total[q[0]] += int(n)
        yield emit([pair for pair in total.items() if pair[1]], schema)

    truth = nodes.select("id", "label", "dim", "vector", "n").mapInArrow(run, "id long, truth long")
    return truth.groupBy("id").agg(F.sum("truth").alias("truth"))


def clustered(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding, label)."""
    spark = table.sparkSession
    rows = stored(cleaned(table), "vectors")
    classes = rows.where("same is not null").groupBy("same").agg(
        F.min("vec_id").alias("id"), F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n")
    )
    classes = stored(classes.withColumn("dim", (F.length("vector") / 8).cast("int")), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))
    bits = F.greatest(F.lit(0), F.least(F.lit(62), F.ceil(F.log2(F.col("size") / settings.bucket)))).cast("int")
    together = F.pow(F.lit(1 - math.acos(settings.threshold) / math.pi), bits)  # a pair at the threshold in one table
    tables = F.when(bits > 0, F.greatest(F.lit(settings.tables), F.ceil(math.log(settings.miss) / F.log1p(-together)))).otherwise(settings.tables)
    sizes = stored(sizes.select("label", "dim", bits.alias("bits"), tables.cast("int").alias("tables")), "sizes")
    nodes = stored(classes.join(sizes, ["label", "dim"]), "nodes")
    vectors = nodes.select("id", "vector")

    none = spark.createDataFrame([], LISTS)
    lists, links = none, spark.createDataFrame([], "a long, b long")
    members = nodes.select("id", "label", "dim", F.col("id").alias("part"), "vector")
    for attempt in range(settings.attempts):
        places = stored(refined(dealt(nodes, settings, attempt), vectors, settings), "places")
        lists = searched(members, places, none, lists, settings)
        links = stored(links.union(linked(lists, settings)).distinct(), "links")
        links, component, open_ = spread(nodes, places, lists, links, settings)
        found = resolved(nodes, links, component, open_, settings)
        recall = audited(nodes, found, settings)
        if recall >= settings.recall:
            break
    if recall < settings.recall:
        raise RuntimeError(f"recall is {recall:.3f} after {settings.attempts} attempts")

    named = classes.select("same", F.col("id"), "n").join(found, "id", "left")
    named = stored(
        named.select("same", (F.col("n") - 1 + F.coalesce("weight", F.lit(0))).alias("linked"), F.coalesce("component", "id").alias("reached")),
        "named",
    )
    out = rows.select("vec_id", "same").join(named, "same", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("reached", "vec_id").cast("long"))
    return out.select(
        "vec_id",
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
