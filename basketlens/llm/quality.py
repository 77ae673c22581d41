"""Quality rules by distribution divergence.

Two histograms of a document are compared with those of its language over the whole corpus:
characters by class, and words by the language's most common words, all others being one
bin. The Jensen-Shannon distance (square root of the divergence in bits, so 0 to 1) must stay
within a limit for each; the limit for words is wider for the chance deviations of a small
histogram, the document's and, where a document is compared with its own language, that of the language's words
in the table. There is no least size of a language: a small one has a reference with a wider limit. A document too short for a histogram to mean anything is not judged by it.

The language's histograms are sums over all documents with that ``lang`` that pass the base rules; the document's own
language is tried first, the others only if that one rejects it, so a wrong or missing
``lang`` does not cost a clean document. Word counts are summed inside each task before the
shuffle; what reaches the driver is ``common_words`` rows and a row of classes per language.

Base rules come first: at least ``min_words`` words, and at most ``max_repeat_percent`` per
cent of them inside an eight-word window that occurs twice.

Defined cases: null or empty text has no words and fails the base rules. Null language: documents are compared
with every reference. No reference at all (empty table): only the base rules judge.
Repeated rows are judged one by one. Columns of the input are kept unless they share a name
with an added one.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, small_batches, with_values

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
WINDOW = 8
CLASSES = 8  # lower, upper, other letters and marks, digits, punctuation, symbols, space, rest
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    common_words: int = 100
    min_class_chars: int = 200
    max_class_distance: float = 0.33
    min_histogram_words: int = 50
    max_word_distance: float = 0.24
    word_distance_noise: float = 2.2  # a histogram of n words may be off by this over sqrt(n)


def class_table() -> np.ndarray:
    """Character class of every code point."""
    place = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Mn": 2, "Mc": 2, "Me": 2}
    major = {"N": 3, "P": 4, "S": 5, "Z": 6}
    table = np.full(0x110000, 7, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        table[code] = place.get(kind, major.get(kind[0], 7))
    for code in SPACES:
        table[code] = 6
    for code in b"#*$%&|<>@+=~^`\\/_":
        table[code] = 5
    return table


_TABLE: list[np.ndarray] = []


def class_counts(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(class_table())
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(_TABLE[0][codes], minlength=CLASSES)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in an eight-word window found at least twice in the list."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        mixed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        hashes = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():  # equal windows would have equal hashes
        return 0
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    ranks, width = ids, 1
    while width < WINDOW:  # ranks of windows twice as wide, exactly
        pairs = ranks[:-width] * len(ids) + ranks[width:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    twice = (np.bincount(ranks) > 1)[ranks].astype(np.int64)
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += twice
    edges[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(edges) > 0).sum())


def base_features(text: str, data: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    seen: set[bytes] = set()
    again = 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line and not line.isspace():
            seen.add(line)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, again, repeated_words(words)


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms given as counts and as shares."""
    total = counts.sum()
    if not total:
        return 1.0
    p, q = counts / total, reference
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return math.sqrt(max(0.0, float(parts.sum()) / 2))


def fails(n_words: int, n_repeat_words: int, rules: Rules) -> bool:
    """The base rules."""
    return n_words < rules.min_words or 100 * n_repeat_words > rules.max_repeat_percent * n_words


def language_counts(docs: DataFrame, rules: Rules, flush: int = 200_000) -> DataFrame:
    """(lang, kind, item, n): characters by class and lower-case words of every language's documents that pass the base rules."""
    schema = to_arrow_schema(StructType.fromDDL("lang string, kind int, item binary, n long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, 1, w, n) for lang, counter in words.items() for w, n in counter.items()]
            rows += [(lang, 0, b"%d" % c, int(n)) for lang, counts in classes.items() for c, n in enumerate(counts) if n]
            words.clear()
            classes.clear()
            return emit(rows, schema)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                data = text.encode()
                found = data.split()
                if fails(len(found), repeated_words(found), rules):
                    continue
                words.setdefault(lang, Counter()).update(data.lower().split())
                counts = class_counts(text)
                classes[lang] = classes[lang] + counts if lang in classes else counts
                if sum(map(len, words.values())) > flush:
                    yield out()
        yield out()

    known = docs.where("lang is not null and text is not null").select("lang", "text")
    parts = small_batches(known).mapInArrow(run, "lang string, kind int, item binary, n long")
    return parts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, rules: Rules) -> dict[str, tuple[np.ndarray, list[bytes], np.ndarray, int]]:
    """By language: shares of the character classes, its common words, their shares and the rest's, all its words."""
    counts = language_counts(docs, rules)
    per_kind = W.partitionBy("lang", "kind")
    top = (
        counts.withColumn("place", F.row_number().over(per_kind.orderBy(F.desc("n"), F.asc("item"))))
        .where(F.col("place") <= max(rules.common_words, CLASSES))
        .drop("place")
    )
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).withColumn("item", F.lit(None).cast("binary"))
    rows = top.unionByName(totals).collect()  # common_words + classes + 2 rows for each language
    found = {}
    for lang in sorted({r.lang for r in rows}):
        own = [r for r in rows if r.lang == lang]
        total = {r.kind: r.n for r in own if r.item is None}
        if not total.get(1):
            continue
        classes = np.zeros(CLASSES)
        for r in own:
            if r.kind == 0 and r.item is not None:
                classes[int(bytes(r.item))] = r.n / total[0]
        common = sorted((-r.n, bytes(r.item)) for r in own if r.kind == 1 and r.item is not None)[: rules.common_words]
        shares = np.array([-n for n, _ in common]) / total[1]
        found[lang] = (classes, [w for _, w in common], np.append(shares, max(0.0, 1 - shares.sum())), total[1])
    return found


def judge(found: dict, rules: Rules) -> Callable[[str | None, str | None], list]:
    """The row function: text and language to features and verdict."""

    def distances(lang: str, classes: np.ndarray, words: Counter, n: int) -> tuple[float | None, float | None]:
        shape, common, shares, _ = found[lang]
        by_class = distance(classes, shape) if classes.sum() >= rules.min_class_chars else None
        by_word = None
        if n >= rules.min_histogram_words:
            counts = np.array([words[w] for w in common] + [0])
            counts[-1] = n - counts.sum()
            by_word = distance(counts, shares)
        return by_class, by_word

    def row(text: str | None, lang: str | None) -> list:
        text = text or ""
        data = text.encode()
        words = data.split()
        features = base_features(text, data, words)
        failed = fails(len(words), features[4], rules)
        best: tuple = (None, None)
        fits = True
        if not failed and found:
            classes, counts = class_counts(text), Counter(data.lower().split())
            fits = False
            for reference in sorted(found, key=lambda x: (x != lang, x)):
                pair = distances(reference, classes, counts, len(words))
                noise = 1 / math.sqrt(len(words)) + (1 / math.sqrt(found[reference][3]) if reference == lang else 0)
                word_limit = rules.max_word_distance + rules.word_distance_noise * noise
                if best == (None, None) or sum(x or 0 for x in pair) < sum(x or 0 for x in best):
                    best = pair
                if (pair[0] or 0) <= rules.max_class_distance and (pair[1] or 0) <= word_limit:
                    best, fits = pair, True
                    break
        return [*features, failed, not failed and fits, *best]

    return row


def assessed(docs: DataFrame, rules: Rules = Rules(), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance and word_distance (null where not judged)."""
    added = FEATURES + ", base_failed boolean, kept boolean, class_distance double, word_distance double"
    found = references(docs.select("lang", "text"), rules)
    names = StructType.fromDDL(added).names
    others = [c for c in (docs.columns if keep is None else keep) if c not in names]
    return with_values(docs, ["text", "lang"], added, lambda: judge(found, rules), others)
