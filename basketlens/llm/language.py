"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a logistic regression over hashed character
n-grams predicts it from the text; the language whose codeword costs the least logistic loss
under these predictions wins. The score is the winner's share when losses are turned into
probabilities, and a prediction is ambiguous if the runner-up's share is close.

The classifiers are fitted on a sample of labelled rows of at most ``fit_rows``, drawn by a
hash of the id and shared out evenly among the languages, with fragments of at most
``fit_chars`` characters. Prediction reads every text as a whole, row by row, without a shuffle.

Defined cases: null text, or text without a letter, is ``und`` with score 0. Without
any labelled row everything is ``und``; with one language it is that one. Repeated rows are
predicted alike. Other columns are kept unless an added one has their name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketlens.llm.arrow import map_rows

UNKNOWN = "und"
ADDED = "lang_pred string, score double, ambiguous boolean"


@dataclass(frozen=True)
class Settings:
    fit_rows: int = 3000
    fit_chars: int = 2000
    short_chars: int = 40
    features: int = 4096
    steps: int = 150
    rate: float = 4.0
    decay: float = 1e-5
    close: float = 0.2


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    close: float


_LETTER: list[np.ndarray] = []


def grams(text: str, features: int) -> np.ndarray | None:
    """Shares of hashed 1- to 3-grams, square-rooted; None without a letter."""
    if not _LETTER:
        _LETTER.append(np.array([chr(code).isalpha() for code in range(0x110000)]))
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    letter = _LETTER[0][codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    codes = codes[np.append(True, letter[1:] | letter[:-1])]  # one space between words
    one = codes * np.uint32(2654435761)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(2246822519) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(3266489917) + one[2:]
    counts = np.zeros(features)
    for kind, hashes in enumerate((one[letter[np.append(True, letter[1:] | letter[:-1])]], two, three)):
        mixed = (hashes ^ (hashes >> np.uint32(16))) * np.uint32(668265263 + 2 * kind)
        found = np.bincount(mixed >> np.uint32(32 - features.bit_length() + 1), minlength=features)
        counts += found / max(1, len(hashes))
    return np.sqrt(counts / 3)


def codewords(n: int, tries: int = 200) -> np.ndarray:
    """A code of -1 and 1: all bits for few languages, else the random one farthest apart."""
    if n <= 5:
        bits = 2 ** (n - 1) - 1
        return np.array([[1 if row == 0 or not (column >> (n - 1 - row)) & 1 else -1 for column in range(bits, 0, -1)] for row in range(n)]) if n > 1 else np.ones((1, 1))
    random, bits = np.random.default_rng(0), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(tries):
        code = random.choice([-1, 1], (n, bits))
        gap = int((bits - (code @ code.T - 2 * bits * np.eye(n))).min()) // 2
        if gap > apart and (np.abs(code.sum(0)) < n).all():
            best, apart = code, gap
    return best


def sample(docs: DataFrame, settings: Settings) -> list[tuple[str, str]]:
    """At most about ``fit_rows`` (lang, text) pairs, the same share of each language."""
    labelled = docs.where("lang is not null and text is not null")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    each = max(1, settings.fit_rows // len(counts))
    rate = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))]), F.col("lang"))
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    latest = F.greatest(F.lit(1), F.length("text") - settings.fit_chars)
    start = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), latest).cast("int") + 1
    rows = labelled.where(chance < rate).select("lang", "doc_id", F.substring("text", start, F.lit(settings.fit_chars)).alias("text"))
    return [(r.lang, r.text) for r in sorted(rows.collect(), key=lambda r: (r.lang, str(r.doc_id), r.text))]


def fit(rows: list[tuple[str, str]], settings: Settings) -> Model | None:
    """One logistic regression per bit, by accelerated gradient steps on the whole sample."""
    random = np.random.default_rng(1)
    texts = []
    for lang, text in rows:
        at = int(random.integers(0, max(1, len(text) - settings.short_chars)))
        texts += [(lang, text), (lang, text[at : at + int(random.integers(8, settings.short_chars))])]
    found = [(lang, x) for lang, text in texts if (x := grams(text, settings.features)) is not None]
    langs = sorted({lang for lang, _ in found})
    if not langs:
        return None
    code = codewords(len(langs))
    x = np.array([x for _, x in found], np.float32)
    y = code[[langs.index(lang) for lang, _ in found]].astype(np.float32)
    share = np.array([1 / sum(lang == other for other, _ in found) for lang, _ in found], np.float32)
    share = (share / share.sum())[:, None]
    weights, bias = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    momentum, momentum_bias = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(settings.steps):
        slope = -y * share / (1 + np.exp(np.clip(y * (x @ weights + bias), -30, 30)))
        momentum = 0.9 * momentum - settings.rate * (x.T @ slope + settings.decay * weights)
        momentum_bias = 0.9 * momentum_bias - settings.rate * slope.sum(0)
        weights, bias = weights + momentum, bias + momentum_bias
    return Model(langs, code, weights, bias, settings.close)


def decode(model: Model | None, text: str | None) -> tuple[str, float, bool]:
    """Language, score and whether it is ambiguous."""
    x = grams(text or "", len(model.weights)) if model else None
    if x is None:
        return UNKNOWN, 0.0, True
    bits = x @ model.weights + model.bias
    losses = np.logaddexp(0, -model.code * bits).sum(1)
    shares = np.exp(losses.min() - losses)
    shares /= shares.sum()
    best, *others = np.argsort(-shares, kind="stable")
    return model.langs[best], float(shares[best]), bool(others) and bool(shares[best] - shares[others[0]] < model.close)


def identified(docs: DataFrame, labelled: DataFrame, settings: Settings = Settings(), keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred, score and ambiguous.

    ``labelled`` has doc_id, text and lang. Only ``text`` of ``docs`` enters a prediction.
    """
    model = fit(sample(labelled, settings), settings)
    added = StructType.fromDDL(ADDED)
    others = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    schema = StructType([docs.schema[c] for c in others] + added.fields)

    def start() -> Callable:
        return lambda text, *values: [*values, *decode(model, text)]

    return map_rows(docs.select("text", *others), schema, start)
