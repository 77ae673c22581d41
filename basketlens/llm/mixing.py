"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words. A document of the source is expected to be
taken ``target / source_size`` times, at most ``cap`` times. Walking through the source's documents
in a fixed order, these expectations are summed up from one offset in [0, 1), and a
document is emitted once for every whole number that its stretch of the sum passes.

The walk goes by size, so that neighbours in it are alike and the words taken come out
near the target whatever the offset. A document's place in the walk is found without
sorting a source in one task: documents are counted by (source, size, bucket of the id), the
small counts are summed up in two steps, and only documents of one source, size and bucket
are ranked against each other.

Defined cases: null source is a source of its own, last in order. Null text has size 0. Documents of
size 0 are walked over like any other and take no words. Repeated rows are documents
of their own. Null ids come first among equals. An empty table gives no rows. Columns of
the input are kept; only the columns added here, named below, replace ones of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.llm.arrow import word_count
from basketlens.session import stored

ADDED = ["size", "source_size", "target", "copies", "taken"]


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(source, source_size, target) for each source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all
    sizes. No target is above ``cap`` times its source; what is above is shared out again
    by weight. In the order of cap per weight the sources that reach their cap are the first
    ones, so one running sum settles all rounds at once. One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    most = cap * F.col("source_size")
    everything = W.partitionBy()
    before = W.orderBy((most / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(
        W.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = (
        per_source.withColumn("weight", weight.cast("long"))
        .withColumn("left", left)
        .withColumn("weight_left", weight_left)
        .withColumn("full", most * F.col("weight_left").cast("double") <= F.col("left").cast("double") * F.col("weight"))
    )
    rest = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("full"), most)).over(everything), F.lit(0)
    )
    sharers = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    share = (rest * F.col("weight")).cast("double") / sharers.cast("double")
    return shared.select("source", "source_size", F.when(F.col("full"), most.cast("double")).otherwise(share).alias("target"))


def offset(seed: str) -> F.Column:
    """In [0, 1), from the source's name alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_copies(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: str = "mix",
    buckets: int = 4096,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    ``docs`` needs doc_id, source and either size (words) or text. It is read three times:
    for the targets, for the counts and for the result.
    """
    if "size" not in docs.columns:
        docs = docs.withColumn("size", word_count("text"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_key")  # never null, so that
    # one partitioning serves the ranks and the joins, and rows with their texts are dealt out once
    aims = stored(targets(docs.select("source", "size"), weights, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    aims = aims.select(
        key,
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        rate.alias("_rate"),
        offset(seed).alias("_offset"),
    )
    digest = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    bucket = F.coalesce(F.pmod(digest, F.lit(buckets)), F.lit(-1)).alias("_bucket")
    groups = ["_key", "size", "_bucket"]
    by_bucket = docs.select(key, "size", bucket).groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    by_bucket = stored(by_bucket, "buckets")
    by_size = by_bucket.groupBy("_key", "size").agg(F.sum("n").alias("n"))
    earlier = lambda *order: W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    size_start = by_size.select(
        "_key",
        "size",
        F.coalesce(F.sum("n").over(earlier("size").partitionBy("_key")), F.lit(0)).alias("_before_size"),
    )
    bucket_start = by_bucket.select(
        *groups,
        F.coalesce(F.sum("n").over(earlier("_bucket").partitionBy("_key", "size")), F.lit(0)).alias("_before_bucket"),
    )
    starts = bucket_start.join(size_start, ["_key", "size"])
    starts = stored(starts.select(*groups, (F.col("_before_size") + F.col("_before_bucket")).alias("_before")), "starts")
    place = F.row_number().over(W.partitionBy(*groups).orderBy("doc_id"))
    own = [c for c in docs.columns if c not in ADDED]  # as one struct, so that no name of theirs meets one of these
    ranked = docs.select("doc_id", "size", F.struct(*own).alias("_own"), key, bucket).withColumn("_place", place).join(starts, groups).join(aims, "_key")
    rank = F.col("_before") + F.col("_place")
    passed = F.floor(rank * F.col("_rate") + F.col("_offset")) - F.floor((rank - 1) * F.col("_rate") + F.col("_offset"))
    return ranked.select(
        "_own.*",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        passed.cast("long").alias("copies"),
        (passed * F.col("size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    rows = docs.select("doc_id", "source", word_count("text").alias("size"), F.struct(*docs.columns).alias("_row"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return with_copies(rows, **settings).withColumn("_copy", copies).select("_row.*")
