"""Toxicity by cumulative-link ordinal regression.

A document's severity is a grade from 0 (clean) to 3 (severe). One weight per word, shared by all
grades, makes a score; thresholds in ascending order cut it into grades: the odds of
exceeding a grade are the score above that grade's threshold. The result is the expected severity, the most likely grade, and whether the document is more likely toxic than not.

``labels`` only says toxic or not. Toxic training documents are graded 1 to 3 by thirds of how many of their
words belong to the vocabulary. The vocabulary are the words found in more toxic documents
than chance allows (likelihood ratio above twice the log of the number of words tried), so features
are few and a clean document has hardly any.

Fitting uses a sample of at most ``fit_toxic`` and ``fit_clean`` labelled rows with the smallest hashes of their ids; only this
bounded list of ids is broadcast. The clean rows are weighted up to their number among all labels. Scoring reads every text as a whole, row by row, without a shuffle.

Defined cases: null or empty text has no features and gets the score of a document without any. Labels with a
null id or toxic are left out; of repeated labels for one id the larger counts. Without a toxic or without a clean label nothing is
learned, and everything has severity 0. Repeated rows are scored alike. Other columns are kept unless an added
one has their name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, map_rows
from basketlens.session import stored

WORD = re.compile(r"[^\W\d_]+")
ADDED = "severity double, grade int, toxic boolean"


@dataclass(frozen=True)
class Settings:
    fit_toxic: int = 4000
    fit_clean: int = 6000
    vocabulary: int = 1000
    grades: int = 4
    steps: int = 400
    rate: float = 0.05
    decay: float = 1e-5


@dataclass(frozen=True)
class Model:
    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray


def features(words: dict[str, int], text: str | None) -> Counter:
    """How often each word of the vocabulary occurs."""
    counts = Counter(map(words.get, WORD.findall((text or "").lower())))
    counts.pop(None, None)
    return counts


def sampled(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic, text) of the sampled rows, and how many labels there are of either kind."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.xxhash64("doc_id", F.lit(11))
    parts = [
        known.where(F.col("toxic") == toxic).orderBy(chance, "doc_id").limit(most)
        for toxic, most in ((1, settings.fit_toxic), (0, settings.fit_clean))
    ]
    chosen = F.broadcast(stored(parts[0].union(parts[1]), "labelled"))
    return stored(docs.where("text is not null").select("doc_id", "text").join(chosen, "doc_id"), "sampled"), totals


def document_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): documents of the sample that have the word."""
    schema = to_arrow_schema(StructType.fromDDL("word string, toxic long, clean long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(set(WORD.findall(text.lower())))
            yield emit([(w, counts[1][w], counts[0][w]) for w in counts[0].keys() | counts[1].keys()], schema)

    parts = sample.select("text", "toxic").mapInArrow(run, "word string, toxic long, clean long")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def vocabulary(sample: DataFrame, n_toxic: int, n_clean: int, settings: Settings) -> dict[str, int]:
    """The words most clearly bound to toxic documents."""
    counts = stored(document_counts(sample), "words")
    tried = counts.count()
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = (a + b) / (n_toxic + n_clean)
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    ratio = 2 * (
        term(a, share * n_toxic) + term(b, share * n_clean)
        + term(n_toxic - a, (1 - share) * n_toxic) + term(n_clean - b, (1 - share) * n_clean)
    )
    clear = counts.where((a / n_toxic > b / n_clean) & (share < 1)).withColumn("ratio", ratio)
    clear = clear.where(F.col("ratio") > 2 * float(np.log(max(tried, 2))))
    best = clear.orderBy(F.desc("ratio"), "word").limit(settings.vocabulary).collect()
    return {r.word: i for i, r in enumerate(best)}


def ordinal(x: np.ndarray, y: np.ndarray, share: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the proportional-odds model, by gradient steps."""
    weights, cuts = np.zeros(x.shape[1]), np.array([1.0] + [0.0] * (settings.grades - 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(cuts), np.zeros_like(cuts)]
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    for step in range(1, settings.steps + 1):
        thresholds = np.cumsum(np.append(cuts[0], np.exp(cuts[1:])))
        score = x @ weights
        below = np.concatenate([np.zeros((len(y), 1)), logistic(thresholds - score[:, None]), np.ones((len(y), 1))], 1)
        upper, lower = below[np.arange(len(y)), y + 1], below[np.arange(len(y)), y]
        chance = np.maximum(upper - lower, 1e-12)
        slope = x.T @ (share * (upper + lower - 1)) - settings.decay * weights
        by_threshold = np.zeros(settings.grades - 1)
        for k in range(settings.grades - 1):
            steep = below[:, k + 1] * (1 - below[:, k + 1]) / chance * share
            by_threshold[k] = steep[y == k].sum() - steep[y == k + 1].sum()
        reach = by_threshold[::-1].cumsum()[::-1]  # a cut moves its own threshold and all above
        by_cut = np.append(reach[0], reach[1:] * np.exp(cuts[1:]))
        for place, (own, gain) in enumerate(((weights, slope), (cuts, by_cut))):
            first, second = moments[2 * place], moments[2 * place + 1]
            first += 0.1 * (gain - first)
            second += 0.001 * (gain**2 - second)
            own += settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return weights, np.cumsum(np.append(cuts[0], np.exp(cuts[1:])))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings) -> Model | None:
    sample, totals = sampled(docs, labels, settings)
    seen = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        return None
    words = vocabulary(sample, seen[1], seen[0], settings)
    if not words:
        return None

    def start() -> Callable:
        def row(doc_id, toxic: int, text: str) -> list:
            counts = features(words, text)
            return [str(doc_id), toxic, list(counts), list(counts.values())]

        return row

    added = "doc_id string, toxic int, at array<int>, n array<int>"
    rows = sorted(map_rows(sample.select("doc_id", "toxic", "text"), added, start).collect(), key=lambda r: (r.doc_id, str(r)))
    x = np.zeros((len(rows), len(words)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = np.log1p(r.n)
    toxic = np.array([r.toxic for r in rows])
    hits = np.array([sum(r.n) for r in rows])
    marks = np.quantile(hits[toxic == 1], np.linspace(0, 1, settings.grades)[1:-1])
    y = np.where(toxic == 1, 1 + np.searchsorted(marks, hits, "left"), 0)
    share = np.where(toxic == 1, totals[1] / seen[1], totals[0] / seen[0])
    weights, thresholds = ordinal(x, y, share / share.sum(), settings)
    return Model(words, weights, thresholds)


def severity(model: Model | None, text: str | None) -> tuple[float, int, bool]:
    """Expected severity, most likely grade, and whether toxic is the likelier."""
    if model is None:
        return 0.0, 0, False
    score = sum(model.weights[i] * np.log1p(n) for i, n in features(model.words, text).items())
    above = 1 / (1 + np.exp(np.clip(model.thresholds - score, -35, 35)))
    chances = -np.diff(np.concatenate([[1.0], above, [0.0]]))
    return float(above.sum()), int(chances.argmax()), bool(above[0] >= 0.5)


def graded(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with severity, grade and toxic; ``labels`` has doc_id and toxic."""
    model = fit(docs, labels, settings)
    added = StructType.fromDDL(ADDED)
    others = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    schema = StructType([docs.schema[c] for c in others] + added.fields)

    def start() -> Callable:
        return lambda text, *values: [*values, *severity(model, text)]

    return map_rows(docs.select("text", *others), schema, start)
