"""Near-duplicate documents by MinHash.

1. A document's set are the hashes of its distinct two-word shingles. Documents with equal sets form a
   class; from here on its smallest id stands for it, however many copies there are.
2. Many universal hash functions give the set's minima, cut into bands; documents that agree
   in a band are in one bucket. With 48 bands of 6 rows two documents at the threshold share
   no bucket once in two million pairs.
3. In every bucket each document meets the bucket's smallest one only. Pairs are thinned by their signatures: one byte of each of the
   288 minima says how similar they are, and pairs ``margin`` per cent below the threshold go. At a margin of 12 that is five standard
   deviations, so one pair in three million at the threshold is lost by it. What remains is compared on full sets, and what is linked
   is joined into components by alternating large-star and small-star steps.
4. What the stars leave open is settled inside the buckets: where a bucket's documents are still in several components,
   those outside its largest one meet all others of the bucket in blocks, signature against signature. Pairs that pass, are of two
   components and share no earlier open bucket are compared on full sets there and then, so no pair becomes a row unless it is a link.

So full sets are compared in proportion to the pairs that pass the signature test and are not joined already: a group of near copies costs
its size plus its loners times their buckets, and documents that only share a bucket cost a comparison of signatures.

Sets are compared as a whole, on the 64-bit hashes of their shingles. Ids, classes and links are
tables; nothing but round counters reaches the driver.

Defined cases: words are lower-cased from A to Z only. Fewer than two words make one shingle; null
text or text without words has an empty set, linked with nothing. A null doc_id is linked with nothing and
kept, its component is null. Rows that share a doc_id are one document: the links of any of them
hold for all, every row comes back. Other columns of the input play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, small_batches, with_values, worker_kept
from basketlens.llm.components import connected
from basketlens.session import stored


@dataclass(frozen=True)
class Settings:
    percent: int = 80  # linked if 100 * intersection >= percent * union
    bands: int = 48
    rows: int = 6
    margin: int = 12  # per cent below the threshold at which a signature still lets a pair pass
    queries_per_block: int = 128
    members_per_block: int = 1024
    bitmap_words: int = 1 << 19


class WordHashes(dict):
    """Word to its 64-bit hash, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(worker_kept("neardup", WordHashes).__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(words) == 1:
            return _mixed(hashes + np.uint64(1))
        return np.unique(_mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + _mixed(hashes[1:])))


class Signer:
    """Minima of universal hash functions a * x + b modulo 2**32, banded."""

    def __init__(self, settings: Settings, seed: int = 1) -> None:
        random, n = np.random.default_rng(seed), settings.bands * settings.rows
        self.a = random.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
        self.b = random.integers(0, 1 << 32, n, dtype=np.uint32)
        self.shape = settings.bands, settings.rows
        self.salt = _mixed(np.arange(1, settings.bands + 1, dtype=np.uint64))

    def minima(self, found: np.ndarray, step: int = 64) -> np.ndarray:
        x = (found >> np.uint64(32)).astype(np.uint32)[:, None]
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), step):
            np.minimum(low, (x[i : i + step] * self.a + self.b).min(0), out=low)
        return low

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band."""
        with np.errstate(over="ignore"):
            key = self.salt.copy()
            for column in minima.reshape(self.shape).T.astype(np.uint64):
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
        return key.view(np.int64)

    def sketch(self, minima: np.ndarray) -> bytes:
        """One byte of each minimum."""
        with np.errstate(over="ignore"):
            return (minima * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes()


def least_matches(settings: Settings) -> int:
    """Equal bytes of two sketches from which on a pair passes; one byte in 256 is equal by chance."""
    share = max(0, settings.percent - settings.margin) / 100
    return math.ceil(settings.bands * settings.rows * (share + (1 - share) / 256))


def signed(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, n_shingles, same, bands, sketch); documents with equal sets have equal ``same``."""

    def start():
        signer = Signer(settings)

        def row(text):
            found = shingles(text)
            if not len(found):
                return [0, None, None, None]
            minima = signer.minima(found)
            return [len(found), xxhash.xxh3_128_digest(found.tobytes()), signer.bands(minima), signer.sketch(minima)]

        return row

    return with_values(docs, ["text"], "n_shingles long, same binary, bands array<long>, sketch binary", start, ["doc_id"])


def alike(blocks: DataFrame, sketches: DataFrame, settings: Settings, texts: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of a query and a member of every block whose sketches let them pass, and with ``texts`` their full sets too.

    ``blocks`` is as for ``compared`` and has part, null for one of its own, and buckets, the open ones of a document. Pairs of one part, and
    pairs that share a lower bucket than the block's, are left out.
    """
    names = [c for c in blocks.columns if c not in ("id", "query", "part", "buckets")]
    schema = to_arrow_schema(StructType.fromDDL("a long, b long"))
    least, percent, full = least_matches(settings), settings.percent, texts is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, queries, sets, table = None, [], {}, None
        for batch in batches:
            found = []
            text = batch.column(batch.num_columns - 1)  # read only where signatures pass
            columns = [c.to_pylist() for c in batch.columns[: batch.num_columns - (full)]]
            for at, (*key, query, own, part, buckets, sketch) in enumerate(zip(*columns)):
                if key != block:
                    block, queries, sets, table = key, [], {}, None
                if query:
                    queries.append((own, part, buckets, sketch, text[at] if full else None))
                    continue
                if not queries:
                    continue
                if table is None:
                    table = np.frombuffer(b"".join(q[3] for q in queries), np.uint8).reshape(len(queries), -1)
                matches = np.count_nonzero(table == np.frombuffer(sketch, np.uint8), axis=1)
                mine = None
                for i in np.flatnonzero(matches >= least):
                    other, its_part, its_buckets, _, its_text = queries[i]
                    if other == own or part is not None and part == its_part:
                        continue
                    if buckets and its_buckets and min(set(buckets).intersection(its_buckets)) != key[0]:
                        continue
                    if full:
                        mine = shingles(text[at].as_py()) if mine is None else mine
                        if i not in sets:
                            sets[i] = shingles(its_text.as_py())
                        shared = np.intersect1d(mine, sets[i], assume_unique=True).size
                        if 100 * shared < percent * (len(mine) + len(sets[i]) - shared):
                            continue
                    found.append((min(other, own), max(other, own)))
            if found:
                yield emit(found, schema)

    met = blocks.join(sketches, "id")
    met = met if texts is None else met.join(texts, "id")
    met = met.select(*names, "query", "id", "part", "buckets", "sketch", *([] if texts is None else ["text"]))
    dealt = met.repartition(*names).sortWithinPartitions(*names, F.col("query").desc(), "id")
    return small_batches(dealt).mapInArrow(run, "a long, b long")


def compared(blocks: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between the queries and the members of every block.

    ``blocks`` has block (any columns but id and query together name a block), id and query (boolean).
    A task holds the sets of one block's queries and streams the members past them.
    """
    names = [c for c in blocks.columns if c not in ("id", "query")]
    schema = to_arrow_schema(StructType.fromDDL("a long, b long"))
    percent = settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets, index = None, [], [], None
        for batch in batches:
            links = []
            for *key, query, own, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != block:
                    block, ids, sets, index = key, [], [], None
                found = shingles(text)
                if query:
                    ids.append(own)
                    sets.append(found)
                    continue
                if index is None:
                    sizes = np.array(list(map(len, sets)), np.int64)
                    tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                    order = np.argsort(tokens, kind="stable")
                    index = tokens[order], np.repeat(np.arange(len(sets)), sizes)[order], sizes
                tokens, owners, sizes = index
                first = np.searchsorted(tokens, found, "left")
                many = np.searchsorted(tokens, found, "right") - first
                places = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
                shared = np.bincount(owners[places], minlength=len(sizes))
                near = 100 * shared >= percent * (sizes + len(found) - shared)
                links += [(ids[i], own) for i in np.flatnonzero(near) if ids[i] != own]
            if links:
                yield emit(links, schema)

    rows = blocks.join(texts, "id").select(*names, "query", "id", "text")
    dealt = rows.repartition(*names).sortWithinPartitions(*names, F.col("query").desc(), "id")
    return small_batches(dealt).mapInArrow(run, "a long, b long")


def blocked(queries: DataFrame, members: DataFrame, settings: Settings) -> DataFrame:
    """Every query of a group met with every member of it: (g, qc, mc, id, ..., query), in blocks of bounded size."""
    counts = (
        queries.select("g", F.lit(1).alias("q"), F.lit(0).alias("m"))
        .union(members.select("g", F.lit(0), F.lit(1)))
        .groupBy("g")
        .agg(F.sum("q").alias("q"), F.sum("m").alias("m"))
    )
    cuts = counts.where("q > 0 and m > 0").select(
        "g",
        F.ceil(F.col("q") / settings.queries_per_block).cast("int").alias("qs"),
        F.ceil(F.col("m") / settings.members_per_block).cast("int").alias("ms"),
    )
    cuts = stored(cuts, "cuts")
    rest = [c for c in queries.columns if c != "g"]
    own = lambda column: F.pmod(F.xxhash64("id", F.lit(5)), F.col(column)).cast("int")
    every = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    asked = queries.join(cuts, "g").select("g", own("qs").alias("qc"), every("ms").alias("mc"), *rest, F.lit(True).alias("query"))
    met = members.join(cuts, "g").select("g", every("qs").alias("qc"), own("ms").alias("mc"), *rest, F.lit(False).alias("query"))
    return asked.union(met)


def linked(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    centers = pairs.select(F.col("a").alias("g"), F.col("a").alias("id")).distinct()
    rays = pairs.select(F.col("a").alias("g"), F.col("b").alias("id"))
    return compared(blocked(centers, rays, settings), texts, settings)


def chosen(texts: DataFrame, asked: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``texts`` whose id is in ``asked``.

    A bitmap of hashed ids, at most ``bitmap_words`` rows of 64 bits however many ids there are, is
    broadcast and sorts out most other texts where they are read; only the rest is shuffled to the join.
    """
    bit = lambda column: F.pmod(F.xxhash64("id", F.lit(3)), F.lit(64 * settings.bitmap_words)).alias(column)
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = asked.select(bit("bit")).groupBy((F.col("bit") / 64).cast("long").alias("word")).agg(F.bit_or(one).alias("bits"))
    near = texts.withColumn("bit", bit("bit")).withColumn("word", (F.col("bit") / 64).cast("long"))
    near = near.join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(one) != 0)
    return near.select(*texts.columns).join(asked, "id")


def clustered(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    signatures = stored(signed(docs, settings), "signatures")
    known = signatures.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("same").agg(F.min("doc_id").alias("id"), F.min_by(F.struct("bands", "sketch"), "doc_id").alias("one"))
    classes = stored(classes.select("same", "id", "one.bands", "one.sketch"), "classes")

    keys = classes.select("id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("n")).where("n > 1")
    held = stored(keys.join(buckets, "key").select("key", "id", "center", "n"), "buckets")
    stars = held.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    stars = stored(stars, "stars")

    sketches, slim = classes.select("id", "sketch"), docs.select(F.col("doc_id").alias("id"), "text")
    nobody = [F.lit(None).cast("long").alias("part"), F.lit(None).cast("array<long>").alias("buckets")]
    centers = stars.select(F.col("a").alias("g"), F.col("a").alias("id"), *nobody).distinct()
    rays = stars.select(F.col("a").alias("g"), F.col("b").alias("id"), *nobody)
    pairs = stored(alike(blocked(centers, rays, settings), sketches, settings), "pairs")
    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = stored(chosen(slim, asked, settings), "texts")
    links = stored(linked(pairs, texts, settings), "links")
    parts = stored(connected(links), "parts")

    members = open_members(held, parts)
    texts = stored(chosen(slim, members.select("id").distinct(), settings), "texts")
    more = stored(alike(blocked(members.where("lone").drop("lone"), members.drop("lone"), settings), sketches, settings, texts), "links")
    whole = connected(links.union(more))

    named = classes.select("same", "id").join(whole.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.select("same", F.coalesce("component", "id").alias("reached")), "named")
    rows = signatures.select("doc_id", "n_shingles", "same").join(named, "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def open_members(held: DataFrame, parts: DataFrame) -> DataFrame:
    """(g, id, part, buckets, lone) for the buckets whose documents are in several components; the lone are outside the largest.

    A bucket of two is its star, and one within a single component has nothing open.
    """
    part_of = parts.select(F.col("node").alias("id"), F.col("component").alias("part"))
    located = held.where("n > 2").select("key", "id").join(part_of, "id", "left")
    located = stored(located.select(F.col("key").alias("g"), "id", F.coalesce("part", "id").alias("part")), "located")
    sizes = located.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("g").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    several = stored(several.where("parts > 1").select("g", "main"), "several")
    open_ = stored(located.join(several, "g"), "open")
    buckets = open_.groupBy("id").agg(F.collect_set("g").alias("buckets"))  # one for each band at most
    members = open_.join(buckets, "id").select("g", "id", "part", "buckets", (F.col("part") != F.col("main")).alias("lone"))
    return stored(members, "members")


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without all but the first document of each component."""
    slim = docs.select("doc_id", "text")
    kept = clustered(slim, settings).where("not kept").select("doc_id").distinct()
    return docs.join(stored(kept, "dropped"), "doc_id", "left_anti")
