"""Phrase collocations by direct-address tiling.

1. Texts become streams of word numbers, one stream per language and chunk of about ``chunk_words``
   words, breaks between pieces and documents included. A chunk keeps its own dictionary with counts; words are counted over
   all dictionaries, and those with ``least`` occurrences are ranked by frequency over the whole corpus. Ranks go
   back to every chunk by a join on its dictionary, and the streams are written with ranks, other words being breaks.
2. Neighbouring ranks are pairs, cells of a square of rank by rank. It is cut into tiles: as ranks
   follow frequency, the tiles near the corner are crowded and are counted by ``bincount`` on their cells' direct addresses; pairs of all
   other tiles are kept as sorted coordinates. Counts are summed up within a task before they are shuffled.
3. Pairs with ``least`` occurrences are ranked by frequency in turn and written to the streams, a pair's rank in place of its
   first word's. Neighbouring pairs are the phrases of three words, and neighbours among those the phrases of
   four: the same step, three times over. A phrase is counted only if both of its parts are frequent, which every candidate's are.

No vocabulary is broadcast: what a task holds is a chunk with its own dictionary and a buffer of pairs. Scores are decimals
of 38 digits, so nothing overflows.

Defined cases: null text is empty. A null language is ``und``, together with documents that say so.
Repeated rows count again. Pieces of any length are counted as a whole. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, small_batches
from basketlens.session import stored

BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # in no UTF-8 text
NORMAL = bytes.maketrans(string.ascii_uppercase.encode() + BREAKS, string.ascii_lowercase.encode() + BREAK * len(BREAKS))
BITS = 33_554_393  # of the filter of frequent pairs: the largest prime below 2**25


@dataclass(frozen=True)
class Settings:
    least: int = 30  # occurrences of a candidate
    longest: int = 4  # words
    scale: int = 2_000_000
    inside_percent: int = 80
    top: int = 2000  # phrases reported for each language
    salts: int = 64  # parts of a language that are ranked on their own first
    chunk_words: int = 1 << 18
    tile: int = 1024  # ranks on either side of a tile
    grid: int = 64  # tiles on either side that may be crowded
    buffer: int = 1 << 21  # pairs counted at once


class Numbers(dict):
    """Word to its place in a chunk's dictionary; the break is 0."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def pieces_of(text: str, most: int) -> Iterator[list[bytes]]:
    """The words of a text with breaks between its pieces, in lists that end with a break and are over ``most`` long only for one piece."""
    words = text.encode().translate(NORMAL).replace(BREAK, b" \xff ").split()
    begin = 0
    while len(words) - begin > most:
        try:
            end = words.index(BREAK, begin + most) + 1
        except ValueError:
            break
        yield words[begin:end]
        begin = end
    yield [*words[begin:], BREAK]


def chunks(docs: DataFrame, settings: Settings) -> DataFrame:
    """(chunk, lang, stream, words, counts): places in ``words`` as 32-bit integers, 0 for a break, for every language of a chunk."""
    schema = to_arrow_schema(StructType.fromDDL("chunk long, lang string, stream binary, words array<string>, counts array<long>"))
    most = settings.chunk_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 32, 0
        numbers: dict[str, Numbers] = {}
        streams: dict[str, list[np.ndarray]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, own in numbers.items():
                stream = np.concatenate(streams[lang])
                counts = np.bincount(stream, minlength=len(own))[1:]
                words = [w.decode() for w in own if w != BREAK]
                if words:
                    yield emit([(task + number, lang, stream.tobytes(), words, counts)], schema)
                    number += 1
            numbers.clear()
            streams.clear()

        for batch in batches:
            for lang, text in zip(*batch.columns):
                lang = lang.as_py()
                for words in pieces_of(text.as_py(), most):
                    own = numbers.setdefault(lang, Numbers())
                    streams.setdefault(lang, []).append(np.fromiter(map(own.__getitem__, words), np.int32, len(words)))
                    held += len(words)
                    if held >= most:
                        yield from out()
                        held = 0
        yield from out()

    texts = docs.where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return small_batches(texts).mapInArrow(run, "chunk long, lang string, stream binary, words array<string>, counts array<long>")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``rank``, from 1 by descending n and then ``order``: sorted in ranges, whose sizes are summed up."""
    spread = df.orderBy(F.desc("n"), *order).withColumn("_at", F.monotonically_increasing_id())
    spread = stored(spread, "ranked").withColumn("_part", F.shiftright("_at", 33))
    sizes = spread.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for every range
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return spread.join(before, "_part").withColumn("rank", rank).drop("_at", "_part", "_before")


def squeezed(stream: np.ndarray) -> np.ndarray:
    """``stream`` with one 0 in place of many in a row."""
    if not len(stream):
        return stream
    keep = stream != 0
    keep[1:] |= stream[:-1] != 0
    return stream[keep]


def pairs_of(stream: np.ndarray, width: int) -> np.ndarray:
    """Cell numbers of neighbouring ranks; -1 where one is missing."""
    left, right = stream[:-1], stream[1:]
    return np.where((left > 0) & (right > 0), left * width + right, -1)


def tile_counts(cells: np.ndarray, width: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(cells, counts): crowded tiles by direct address, all others by sorted coordinates."""
    tile, grid = settings.tile, settings.grid
    left = cells // width
    right = cells - left * width
    near = (left < tile * grid) & (right < tile * grid)
    at = np.full(len(cells), grid * grid, np.int32)
    at[near] = left[near] // tile * grid + right[near] // tile
    crowded = np.bincount(at, minlength=grid * grid + 1)[:-1] >= tile * tile // 8
    dense = np.append(crowded, False)[at]
    found, counts = [], []
    if crowded.any():
        order = np.argsort(at[dense], kind="stable")
        own, inside = at[dense][order], ((left % tile) * tile + right % tile)[dense][order]
        places = np.flatnonzero(crowded)
        edges = np.searchsorted(own, np.append(places, grid * grid))
        for place, a, b in zip(places, edges, edges[1:]):
            n = np.bincount(inside[a:b], minlength=tile * tile)
            hit = np.flatnonzero(n)
            found.append((hit // tile + place // grid * tile) * width + hit % tile + place % grid * tile)
            counts.append(n[hit])
    some = np.unique(cells[~dense], return_counts=True)
    return np.concatenate([*found, some[0]]), np.concatenate([*counts, some[1]])


def pair_counts(streams: DataFrame, width: int, settings: Settings) -> DataFrame:
    """(cell, n): every pair of neighbouring ranks in ``streams`` (chunk, stream)."""
    schema = to_arrow_schema(StructType.fromDDL("cell long, n long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> Iterator[pa.RecordBatch]:
            cells, counts = tile_counts(np.concatenate(held), width, settings)
            held.clear()
            for i in range(0, len(cells), 1 << 17):
                part = [pa.array(cells[i : i + (1 << 17)]), pa.array(counts[i : i + (1 << 17)])]
                yield pa.RecordBatch.from_arrays(part, schema=schema)

        for batch in batches:
            for stream in batch.column(0):
                cells = pairs_of(np.frombuffer(stream.as_py(), np.int64), width)
                held.append(cells[cells >= 0])
                if sum(map(len, held)) >= settings.buffer:
                    yield from out()
        if held:
            yield from out()

    counted = small_batches(streams).select("stream").mapInArrow(run, "cell long, n long")
    return counted.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least)


def bit_filter(frequent: DataFrame) -> np.ndarray:
    """The bits cell modulo ``BITS`` of all frequent cells: 4 MB at most, however many there are."""
    bit = F.pmod("cell", F.lit(BITS))
    one = F.expr(f"shiftleft(1L, cast(pmod(cell, {BITS}) % 64 as int))")
    words = frequent.groupBy((bit / 64).cast("long").alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    bits = np.zeros(BITS // 64 + 1, np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def renumbered(streams: DataFrame, keys: DataFrame, own, kind: str) -> DataFrame:
    """``streams`` with ranks: ``keys`` (chunk, key, rank) is each chunk's part of the ranking, gathered beside its stream.

    ``own(stream, keys, ranks)`` gives the new stream. A chunk's part is as large as the chunk at most.
    """
    table = keys.groupBy("chunk").agg(F.collect_list("key").alias("keys"), F.collect_list("rank").alias("ranks"))
    both = streams.select("chunk", "stream").join(table, "chunk").select("chunk", "stream", "keys", "ranks")
    dtype = np.dtype(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, stream, some, ranks = (batch.column(k)[i] for k in range(4))
                some, ranks = some.values.to_numpy(), ranks.values.to_numpy()
                new = squeezed(own(np.frombuffer(stream.as_py(), dtype), some, ranks))
                if len(new) > 1:
                    yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()]), pa.array([new.tobytes()], pa.binary())], ["chunk", "stream"])

    return small_batches(both).mapInArrow(run, "chunk long, stream binary")


def from_places(stream: np.ndarray, places: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Ranks in place of a dictionary's places; words without a rank are breaks."""
    table = np.zeros(int(max(stream.max(initial=0), places.max(initial=0))) + 1, np.int64)
    table[places] = ranks
    return table[stream]


def from_pairs(width: int):
    """Ranks of pairs in place of their first word's."""

    def own(stream: np.ndarray, cells: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        order = np.argsort(cells)
        cells, ranks = cells[order], ranks[order]
        pairs = pairs_of(stream, width)
        at = np.minimum(np.searchsorted(cells, pairs), len(cells) - 1)
        return np.where(cells[at] == pairs, ranks[at], 0)

    return own


def chunk_cells(streams: DataFrame, frequent: DataFrame, width: int) -> DataFrame:
    """(chunk, cell): the distinct pairs of every chunk that may be frequent."""
    bits = streams.sparkSession.sparkContext.broadcast(np.packbits(bit_filter(frequent)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(bits.value).view(bool)
        for batch in batches:
            for chunk, stream in zip(*batch.columns):
                cells = pairs_of(np.frombuffer(stream.as_py(), np.int64), width)
                cells = cells[cells >= 0]
                cells = np.unique(cells[known[cells % BITS]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), chunk.as_py())), pa.array(cells)], ["chunk", "cell"])

    return small_batches(streams).select("chunk", "stream").mapInArrow(run, "chunk long, cell long")


def phrases(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """((lang, n), phrases): words of every language, and all phrases with ``least`` occurrences from two words on.

    Phrases have lang, words, a, pre and suf (occurrences of their first and last 1, 2, ... words), and
    ``around``: the most occurrences of a phrase one word longer that they lie in, 0 if none.
    """
    cut = stored(chunks(docs.select("lang", "text"), settings), "chunks")
    entries = cut.select("chunk", "lang", F.explode(F.arrays_zip("words", "counts")).alias("e"))
    counted = stored(entries.groupBy("lang", F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("n")), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))

    words = stored(ranked(counted.where(F.col("n") >= settings.least), "lang", "word"), "ranks")
    places = cut.select("chunk", "lang", F.posexplode("words").alias("at", "word"))
    keys = places.join(words, ["lang", "word"]).select("chunk", (F.col("at") + 1).alias("key"), "rank")
    streams = stored(renumbered(cut, keys, from_places, "i4"), "streams")
    level = words.select("rank", "lang", F.array("word").alias("words"), F.col("n").alias("a"), F.array("n").alias("pre"), F.array("n").alias("suf"))

    found = None
    for length in range(2, settings.longest + 1):
        width = (level.agg(F.max("rank").alias("n")).first().n or 0) + 1
        counted = ranked(pair_counts(streams, width, settings), "cell")
        pairs = stored(counted.withColumn("first", F.expr(f"cell div {width}")).withColumn("second", F.expr(f"cell % {width}")), "pairs")
        left = level.select(F.col("rank").alias("first"), "lang", F.col("words").alias("w"), F.col("pre").alias("p"))
        right = level.select(F.col("rank").alias("second"), F.element_at("words", -1).alias("last"), F.col("suf").alias("s"))
        longer = pairs.join(left, "first").join(right, "second").select(
            "rank",
            "first",
            "second",
            "lang",
            F.concat("w", F.array("last")).alias("words"),
            F.col("n").alias("a"),
            F.concat("p", F.array("n")).alias("pre"),
            F.concat("s", F.array("n")).alias("suf"),
        )
        longer = stored(longer, f"phrases{length}")
        if length > 2:
            found = enclosed(level, longer, found)
        level = longer
        if length < settings.longest:
            some = chunk_cells(streams, pairs, width).join(pairs.select("cell", "rank"), "cell")
            streams = stored(renumbered(streams, some.select("chunk", F.col("cell").alias("key"), "rank"), from_pairs(width), "i8"), "streams")
    return totals, enclosed(level, None, found)


def enclosed(level: DataFrame, longer: DataFrame | None, found: DataFrame | None) -> DataFrame:
    """``found`` and the phrases of ``level`` with the most occurrences of a phrase in ``longer`` around them."""
    rows = level.select("rank", "lang", "words", "a", "pre", "suf")
    if longer is None:
        rows = rows.withColumn("around", F.lit(0).cast("long"))
    else:
        parts = longer.select(F.col("first").alias("rank"), "a").union(longer.select("second", "a"))
        rows = rows.join(parts.groupBy("rank").agg(F.max("a").alias("around")), "rank", "left")
        rows = rows.withColumn("around", F.coalesce("around", F.lit(0).cast("long")))
    rows = rows.drop("rank")
    return rows if found is None else found.unionByName(rows)


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score, occurrences and bytes.

    A phrase's score is floor(scale * a / (l + r)) for its lowest-scoring cut in two, l and r being the occurrences of the parts.
    A phrase is left out if one around it, of any length, has ``inside_percent`` of its occurrences or more: as occurrences
    never rise from a phrase to a longer one, looking at those one word longer is enough.
    """
    totals, found = phrases(docs, settings)
    free = found.where(100 * F.col("around").cast("decimal(38,0)") < settings.inside_percent * F.col("a").cast("decimal(38,0)"))
    cut = F.expr(
        f"""array_min(transform(sequence(1, size(words) - 1), k -> struct(
              cast({settings.scale} as decimal(9,0)) * cast(a as decimal(19,0))
                div (cast(element_at(pre, k) as decimal(19,0)) + cast(element_at(suf, size(words) - k) as decimal(19,0))) as score,
              k as k, element_at(pre, k) as l, element_at(suf, size(words) - k) as r)))"""
    )
    scored = free.withColumn("cut", cut).select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")
    )
    order = W.orderBy(F.desc("score"), F.desc("a"), "phrase")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(settings.salts))  # a language's first are among its salts' first
    scored = scored.withColumn("rank", F.row_number().over(order.partitionBy("lang", salt))).where(F.col("rank") <= settings.top)
    order = order.partitionBy("lang")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= settings.top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
