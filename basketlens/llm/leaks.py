"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words: letters A-Z become small, and everything else in ASCII but letters and
digits separates words. The windows of ``width`` consecutive words of every benchmark item (an item of fewer words is one
window) go into an automaton over normalised text, each between single blanks, so that only whole words match.
A document is normalised in the same way and walks through the automaton once; a match
marks its words, whose offsets lead back to code points of the original text.

Windows are dealt out to shards of at most ``shard_bytes`` of text by their hash: a benchmark of usual size
is one shard, and a larger one takes as many passes over the documents as it has shards. What a pass
broadcasts is a shard, so its size is bounded whatever the benchmark's, and each pass carries the hits of
those before along with its document; nothing is shuffled but the windows.

Defined cases: null or empty text has no words and no hits. An item without words has no window. Rows of the
benchmark that share an id are one item; a null id marks words but is not listed. Documents are judged row by row, repeated rows
alike. An empty benchmark contaminates nothing. Other columns of documents are kept unless an added one has their name;
other columns of the benchmark play no part. A text may have any length and is never cut.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, small_batches, with_values, worker_kept
from basketlens.session import stored

_WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]")
#: small letters, digits and bytes of other code points stand for themselves, A-Z for a-z, the rest for a blank
NORMAL = bytes(c if _WORD_BYTES.match(bytes([c])) else 0x20 for c in bytes(range(256)).lower())

ADDED = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


@dataclass(frozen=True)
class Settings:
    width: int = 10
    shard_bytes: int = 16 << 20  # of windows in one automaton


def windows(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """(window, items): the distinct windows of ``benchmark`` (item_id, text) and the sorted ids of their items as strings."""
    schema = to_arrow_schema(StructType.fromDDL("window binary, item string"))
    width = settings.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*batch.columns):
                item, words = item.as_py(), (text.as_py() or "").encode().translate(NORMAL).split()
                for begin in range(0, max(1, len(words) - width + 1) if words else 0, 65_536):
                    end = min(begin + 65_536, max(1, len(words) - width + 1))
                    found = {b" ".join(words[i : i + width]) for i in range(begin, end)}
                    yield emit([(window, item) for window in found], schema)

    items = small_batches(benchmark).select(F.col("item_id").cast("string"), "text")
    found = items.mapInArrow(run, "window binary, item string")
    return found.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


class Scanner:
    """The automaton of one shard."""

    def __init__(self, shard: list[tuple[bytes, list[str]]]) -> None:
        self.trie = ahocorasick.Automaton()
        for window, items in shard:
            self.trie.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
        if shard:
            self.trie.make_automaton()
        self.empty = not shard

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches of words (first, end), merged and in order, and the items found."""
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return hits, items
        data = b" %b " % b" ".join(words)
        blanks = None
        for end, (width, own) in self.trie.iter(data.decode("latin-1")):
            if blanks is None:
                blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20)
            last = int(np.searchsorted(blanks, end))  # words before this blank
            hits.append((last - width, last))
            items.update(own)
        return merged(hits), items


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(stretches):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((first, end))
    return out


def offsets(text: str, stretches: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Stretches of words as code points of the text, end exclusive."""
    if not stretches:
        return []
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = np.frombuffer(data.translate(NORMAL), np.uint8) != 0x20
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points that begin before a byte
    return [{"start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in stretches]


def scanned(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, n_hit, n_items, items_sha256, contaminated and hits.

    ``hits`` are the stretches of hit words as code points of the original text.
    """
    found = stored(windows(benchmark, settings), "windows")
    weight = F.length("window") + 16 * F.size("items")
    size = found.agg(F.sum(weight).alias("n")).first().n or 0
    shards = max(1, -(-size // (settings.shard_bytes // 2)))  # halves, as hashes deal unevenly
    keep = docs.columns if keep is None else keep
    spark, passed = docs.sparkSession, docs
    state = "_hits array<struct<first:int,end:int>>, _items array<string>"
    clash = {c: f"_kept_{i}" for i, c in enumerate(docs.columns) if c.startswith("_")}
    passed = docs.select(*(F.col(c).alias(clash.get(c, c)) for c in docs.columns))
    kept = [clash.get(c, c) for c in keep]
    for k in range(shards):
        rows = found.where(F.pmod(F.xxhash64("window"), F.lit(shards)) == k).collect()  # at most a shard
        shard = spark.sparkContext.broadcast(sorted((bytes(r.window), r.items) for r in rows))
        last = k == shards - 1

        def start(shard=shard, last=last, key=uuid.uuid4().hex) -> Callable:
            scanner = worker_kept(("leaks", key), lambda: Scanner(shard.value))

            def row(text: str | None, *before) -> list:
                text = text or ""
                words = text.encode().translate(NORMAL).split()
                hits, items = scanner.scan(words)
                if before:
                    hits = merged([(h["first"], h["end"]) for h in before[0]] + hits)
                    items = items.union(before[1])
                if not last:
                    return [[{"first": a, "end": b} for a, b in hits], sorted(items)]
                n = sum(b - a for a, b in hits)
                listed = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
                return [len(words), n, len(items), listed, n > 0, offsets(text, hits)]

            return row

        reads = ["text", "_hits", "_items"] if k else ["text"]
        added = ADDED + ", hits array<struct<start:long,end:long>>" if last else state
        passed = with_values(passed, reads, added, start, kept if last else list(dict.fromkeys([*kept, "text"])))
        if not last:
            passed = stored(passed, "scanned")
    back = {v: k for k, v in clash.items()}
    return passed.select(*(F.col(c).alias(back.get(c, c)) for c in passed.columns))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without any hit."""
    marked = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return scanned(marked, benchmark, settings).where("not contaminated").select("row.*")
