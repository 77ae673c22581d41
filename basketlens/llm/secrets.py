"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they miss.

The field tags the tokens of a line as begin, inside or outside of a secret. Its features are the token's shape
(length, alphabet, digits, changes of class), the words before and after, and the file around
it. Only a token that could be a secret, or a short one glued to it, may be tagged begin or inside; all others
are outside by a tag dictionary, so a line falls into short independent stretches and
Viterbi decoding of these is exact for the whole line.

It is trained here: the stretches of sampled documents, tagged by the fixed patterns, plus copies
in which the secret's value, the word that names it and the signs around it are swapped for others, so
that it learns what a secret looks like and not only what the patterns know. The sample is the
``fit_stretches`` stretches with the smallest hash on either side (with and without a secret), so it is bounded, the same for any
partitioning, and drawn from all documents. Each task sends its own smallest ones only.

Scanning reads every text as a whole, row by row, without a shuffle.

Defined cases: null or empty text has no spans. Spans count code points, ends exclusive, and the
field's spans never overlap a pattern's. Without a single secret to learn from, only the
patterns work. Repeated rows give the same spans. Other columns are kept unless an
added one has their name.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import itertools
import json
import random
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from basketlens.llm.arrow import emit, with_values
from basketlens.session import stored

# fixed values: what the base patterns are
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "crf"]
LEAST = {"assign": 6, "access": 20}

CUES = (
    "password passwd pwd passphrase secret token bearer authorization auth credential credentials apikey api_key api-key key "
    "access_key secret_key private_key access-key client_secret webhook"
).split()
_ROOTS = "passw passphrase pwd secret token bearer auth credential key webhook".split()  # one is in every cue
_TOKEN = re.compile(r"[\w+/.-]+|[^\w\s]")
_DIGIT = re.compile(r"[0-9]")
_GLUED = frozenset("=+/-_.~:")
OUTSIDE, BEGIN, INSIDE = range(3)
PLACEHOLDER = "[secret]"
REACH = 8  # tokens that a cue counts for
NAMED_LENGTH = 4

Span = tuple[int, int, int]  # start, kind's place, end


@dataclass(frozen=True)
class Settings:
    fit_stretches: int = 1500
    least_length: int = 8
    swaps: int = 3
    epochs: int = 12
    rate: float = 0.3
    decay: float = 1e-4


@dataclass(frozen=True)
class Model:
    weights: dict[str, np.ndarray]
    moves: np.ndarray


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind."""
    found: list[Span] = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if _DIGIT.search(text) or len(text) >= 24:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


# features ---------------------------------------------------------------------------------


def shape(token: str) -> list[str]:
    digits = sum(c.isdigit() for c in token)
    lower = any(c.islower() for c in token)
    upper = any(c.isupper() for c in token)
    hexadecimal = all(c in "0123456789abcdef" for c in token)
    alphabet = "hex" if hexadecimal and lower and digits else f"{'a' * lower}{'A' * upper}{'9' * (digits > 0)}"
    signs = "".join(sorted(set(c for c in token if not c.isalnum())))[:4]
    kinds = ["9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "." for c in token]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    size = min(len(token) // 4, 11)
    return [
        f"size={size}",
        f"alphabet={alphabet}",
        f"both={alphabet}/{min(len(token) // 8, 6)}",
        f"signs={signs}",
        f"digits={digits * 5 // max(1, len(token))}",
        f"changes={min(changes * 8 // max(1, len(token)), 7)}",
        f"varied={min(len(set(token)) // 3, 6)}",
    ]


def around(word: str | None) -> str:
    """A neighbour as a feature: cues and signs as they are, other words by kind."""
    if word is None:
        return "none"
    low = word.lower()
    if low in CUES or len(low) == 1 and not low.isalnum():
        return low
    if any(cue in low for cue in ("secret", "token", "passw", "key")):
        return "cue"
    return "number" if any(c.isdigit() for c in low) else "word"


def file_features(text: str) -> list[str]:
    code = sum(map(text.count, "{}();=\"'"))
    return [f"code={min(code * 40 // max(1, len(text)), 5)}", f"lines={min(text.count(chr(10)), 3)}"]


@dataclass
class Stretch:
    """Consecutive tokens that may be a secret or part of one."""

    spans: list[tuple[int, int]]
    words: list[str]
    glued: list[bool]
    before: list[str | None]  # up to two words before
    after: str | None

    def features(self, file: list[str]) -> list[list[str]]:
        rows = []
        for i, word in enumerate(self.words):
            one = self.words[i - 1] if i else self.before[-1]
            two = self.words[i - 2] if i > 1 else (self.before[-1] if i else self.before[-2])
            following = self.words[i + 1] if i + 1 < len(self.words) else self.after
            rows.append(
                [*shape(word), f"-1={around(one)}", f"-2={around(two)}", f"-12={around(two)} {around(one)}"]
                + [f"+1={around(following)}", f"glued={self.glued[i]}", "bias", *file]
            )
        return rows

    def allowed(self, i: int) -> tuple[int, ...]:
        return (OUTSIDE, INSIDE) if len(self.words[i]) < 3 else (OUTSIDE, BEGIN, INSIDE)


def stretches(text: str, least: int) -> Iterator[Stretch]:
    """Every stretch of a text, line by line; words and cues before a line count for its first tokens.

    A token may be a secret if it holds a digit and is ``least`` long, or if a cue stands among the eight tokens
    before it and it is four long; what it is, the weights decide.
    """
    low = text.lower()
    roots = [root for root in _ROOTS if root in low]
    if not roots and not _DIGIT.search(text):
        return
    start, reach, last = 0, 0, ""
    for line in text.split("\n"):
        cued = bool(roots) and any(map(line.lower().__contains__, roots))
        if _DIGIT.search(line) or cued or reach:
            tokens = list(_TOKEN.finditer(line))
            tail = [None, None, *_TOKEN.findall(last)][-2:]
            near: list[bool] = []  # whether a cue is within reach of a token
            for match in tokens:
                near.append(reach > 0)
                reach = REACH if around(match[0]) == "cue" or match[0].lower() in CUES else max(0, reach - 1)
            open_: list[int] = []
            for i, match in enumerate([*tokens, None]):
                if match is not None:
                    word = match[0]
                    glued = i > 0 and tokens[i - 1].end() == match.start()
                    possible = len(word) >= least and bool(_DIGIT.search(word)) or near[i] and len(word) >= NAMED_LENGTH
                    part = bool(open_) and glued and len(word) < 3 and word[0] in _GLUED
                    if possible or part:
                        open_.append(i)
                        continue
                if open_:
                    first = open_[0]
                    yield Stretch(
                        [(start + tokens[j].start(), start + tokens[j].end()) for j in open_],
                        [tokens[j][0] for j in open_],
                        [j > 0 and tokens[j - 1].end() == tokens[j].start() for j in open_],
                        [tokens[first - k][0] if first >= k else tail[first - k] for k in (2, 1)],
                        match[0] if match is not None else None,
                    )
                    open_ = []
        start += len(line) + 1
        last = line if line.strip() else last


# the field --------------------------------------------------------------------------------


def emissions(weights: dict[str, np.ndarray], rows: list[list[str]], stretch: Stretch) -> np.ndarray:
    scores = np.full((len(rows), 3), -np.inf)
    for i, row in enumerate(rows):
        total = np.zeros(3)
        for feature in row:
            if feature in weights:
                total = total + weights[feature]
        for tag in stretch.allowed(i):
            scores[i, tag] = total[tag]
    return scores


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """The best tags of a stretch between two outside tokens."""
    best = scores[0] + moves[OUTSIDE]
    back = []
    for row in scores[1:]:
        ways = best[:, None] + moves
        back.append(ways.argmax(0))
        best = ways.max(0) + row
    tags = [int((best + moves[:, OUTSIDE]).argmax())]
    for pointers in reversed(back):
        tags.append(int(pointers[tags[-1]]))
    return tags[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    most = np.where(np.isfinite(most), most, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - most).sum(axis)) + most.squeeze(axis)


def expected(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag and move probabilities by the forward-backward algorithm."""
    n = len(scores)
    forward, backward = np.empty((n, 3)), np.empty((n, 3))
    forward[0] = scores[0] + moves[OUTSIDE]
    for i in range(1, n):
        forward[i] = scores[i] + _log_sum(forward[i - 1][:, None] + moves, 0)
    backward[-1] = moves[:, OUTSIDE]
    for i in range(n - 2, -1, -1):
        backward[i] = _log_sum(moves + (scores[i + 1] + backward[i + 1])[None, :], 1)
    total = _log_sum(forward[-1] + backward[-1], 0)
    tags = np.exp(forward + backward - total)
    pairs = np.zeros((3, 3))
    pairs[OUTSIDE] += tags[0]
    pairs[:, OUTSIDE] += tags[-1]
    for i in range(1, n):
        pairs += np.exp(forward[i - 1][:, None] + moves + scores[i] + backward[i] - total)
    return tags, pairs


def gold(stretch: Stretch, spans: list[Span]) -> list[int]:
    """Tags by the fixed patterns: tokens that share characters with a span's value."""
    tags, previous = [], None
    for start, end in stretch.spans:
        inside = next((s for s in spans if s[0] < end and start < s[2]), None)
        tags.append(OUTSIDE if inside is None else INSIDE if previous is not None and inside == previous else BEGIN)
        previous = inside
    return tags


def swapped(words: list[str], tags: list[int], before: list[str | None], draw: random.Random) -> tuple[list[str], list[str | None]]:
    """Another secret of another kind in another place."""
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]
    alphabets.append(alphabets[2] + "+/")
    alphabets.append(alphabets[2] + "_-")
    words = list(words)
    for i, tag in enumerate(tags):
        if tag == BEGIN:
            words[i] = "".join(draw.choices(draw.choice(alphabets), k=draw.choice([16, 20, 24, 32, 36, 40, 44, 64])))
            if not any(c.isdigit() for c in words[i]):
                words[i] = words[i][:-1] + "7"
    contexts = [(cue, sign) for cue in CUES for sign in (":", "=", '"', "'")] + [("export", "="), ("word", "word"), (":", '"'), ("=", '"')]
    return words, list(draw.choice(contexts))


def ordinary(draw: random.Random) -> str:
    """A long token with digits that is no secret: a path, a date, a version, a file, a part number."""
    word = lambda: "".join(draw.choices("abcdefghijklmnoprstuvw", k=draw.randint(3, 9)))
    number = lambda k: "".join(draw.choices("0123456789", k=k))
    return draw.choice(
        [
            f"//{word()}.{word()}.com/{word()}/{word()}-{number(4)}.html",
            f"//www.{word()}.org/{word()}/{word().upper()}-{number(1)}.{number(1)}",
            f"/{word()}/{word()}/{number(2)}/{word()}",
            f"{word()}_{word()}_{number(2)}.{word()[:3]}",
            f"20{number(2)}-{number(2)}-{number(2)}T{number(2)}",
            f"{number(2)}.{number(2)}.{number(4)}",
            f"{word().title()}{word().title()}{number(2)}",
            f"{word().upper()[:4]}-{number(6)}",
            f"{word()}{number(2)}.{word()}.com",
            f"{word()}-{word()}-{number(3)}",
        ]
    )


def fit(examples: list[tuple[Stretch, list[int], list[str]]], settings: Settings) -> Model | None:
    """Adaptive gradient ascent on the likelihood, one stretch at a time."""
    if not any(BEGIN in tags for _, tags, _ in examples):
        return None
    draw = random.Random(0)
    data = []
    for stretch, tags, file in examples:
        data.append((stretch, tags, stretch.features(file)))
        if BEGIN in tags:
            for _ in range(settings.swaps):
                words, before = swapped(stretch.words, tags, stretch.before, draw)
                other = Stretch(stretch.spans, words, stretch.glued, before, draw.choice([stretch.after, '"', "'", ";", None]))
                data.append((other, tags, other.features(file)))
    plain = [stretch.before for stretch, tags, _ in examples if BEGIN not in tags] or [["word", "word"]]
    for _ in range(len(data) // 2):
        other = Stretch([(0, 0)], [ordinary(draw)], [draw.random() < 0.5], draw.choice([*plain, ["http", ":"]]), draw.choice(["word", ".", None]))
        data.append((other, [OUTSIDE], other.features([])))
    weights: dict[str, np.ndarray] = {}
    squares: dict[str, np.ndarray] = {}
    moves, move_squares = np.zeros((3, 3)), np.full((3, 3), 1e-6)
    moves[OUTSIDE, INSIDE] = -np.inf
    free = np.isfinite(moves)
    for _ in range(settings.epochs):
        draw.shuffle(data)
        for stretch, tags, rows in data:
            scores = emissions(weights, rows, stretch)
            marginals, pairs = expected(scores, moves)
            truth = np.eye(3)[tags]
            for i, row in enumerate(rows):
                slope = truth[i] - marginals[i]
                if np.abs(slope).max() < 1e-4:
                    continue
                for feature in row:
                    own = weights.get(feature)
                    if own is None:
                        own, squares[feature] = np.zeros(3), np.full(3, 1e-6)
                    step = slope - settings.decay * own
                    squares[feature] += step**2
                    weights[feature] = own + settings.rate * step / np.sqrt(squares[feature])
            path = [OUTSIDE, *tags, OUTSIDE]
            seen = np.zeros((3, 3))
            np.add.at(seen, (path[:-1], path[1:]), 1)
            step = np.where(free, seen - pairs, 0)
            move_squares += step**2
            moves = np.where(free, moves + settings.rate * step / np.sqrt(move_squares), -np.inf)
    return Model(weights, moves)


def sample(docs: DataFrame, settings: Settings) -> list[tuple[Stretch, list[int], list[str]]]:
    """The stretches with the smallest hashes, as many with a secret as without."""
    schema = to_arrow_schema(StructType.fromDDL("secret boolean, hash string, example string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, list] = {True: [], False: []}
        known: set[str] = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans, file = None, None
                for stretch in stretches(text or "", settings.least_length):
                    if spans is None:
                        spans, file = base_spans(text), file_features(text)
                    tags = gold(stretch, spans)
                    parts = [stretch.spans, stretch.words, stretch.glued, stretch.before, stretch.after, tags, file]
                    example = json.dumps(parts)
                    digest = hashlib.md5(json.dumps(parts[1:]).encode()).hexdigest()
                    heap, item = kept[BEGIN in tags], (-int(digest, 16), digest, example)
                    if digest in known or len(heap) >= settings.fit_stretches and item < heap[0]:
                        continue
                    known.add(digest)
                    heapq.heappush(heap, item)
                    if len(heap) > settings.fit_stretches:
                        known.discard(heapq.heappop(heap)[1])
        yield emit([(secret, digest, example) for secret, heap in kept.items() for _, digest, example in heap], schema)

    found = stored(docs.select("text").mapInArrow(run, "secret boolean, hash string, example string"), "stretches")
    rows = []
    for secret in (True, False):
        smallest = found.where(F.col("secret") == secret).dropDuplicates(["hash"]).orderBy("hash")
        rows += smallest.limit(settings.fit_stretches).collect()
    out = []
    for row in rows:
        spans, words, glued, before, after, tags, file = json.loads(row.example)
        out.append((Stretch([tuple(s) for s in spans], words, glued, before, after), tags, file))
    return out


# scanning ---------------------------------------------------------------------------------


def all_spans(text: str, model: Model | None, settings: Settings) -> tuple[list[Span], list[Span]]:
    """(spans of the patterns, all spans) in order."""
    base = base_spans(text)
    if model is None:
        return base, base
    more: list[Span] = []
    reach = list(itertools.accumulate((end for _, _, end in base), max))
    file: list[str] | None = None
    for stretch in stretches(text, settings.least_length):
        file = file_features(text) if file is None else file
        tags = viterbi(emissions(model.weights, stretch.features(file), stretch), model.moves)
        for i, tag in enumerate(tags):
            if tag == BEGIN:
                last = i
                while last + 1 < len(tags) and tags[last + 1] == INSIDE:
                    last += 1
                start, end = stretch.spans[i][0], stretch.spans[last][1]
                ahead = bisect.bisect_left(base, (end,))  # base spans that begin before this one's end
                if not ahead or reach[ahead - 1] <= start:
                    more.append((start, len(KINDS) - 1, end))
    return base, sorted(base + more)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every stretch covered by spans replaced by one placeholder."""
    parts, at, covered = [], 0, -1
    for start, _, end in spans:
        if start >= covered:
            parts += [text[at:start], PLACEHOLDER]
        covered = at = max(covered, end)
    return "".join([*parts, text[at:]]) if parts else text


ADDED = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scanned(docs: DataFrame, settings: Settings = Settings(), keep: list[str] | None = None, redacting: bool = False) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the spans found in ``text`` and their counts.

    With ``redacting`` the columns of ``docs`` alone come back, secrets replaced in ``text`` (and ``n_chars``
    counted anew if there is such a column).
    """
    model = fit(sample(docs, settings), settings)
    if redacting:
        counting = "n_chars" in docs.columns
        changed = ["text", "n_chars"] if counting else ["text"]
        added, others = docs.select(*changed).schema, docs.columns if keep is None else keep
    else:
        changed, added = ["text"], StructType.fromDDL(ADDED)
        others = [c for c in (docs.columns if keep is None else keep) if c not in added.names]

    def start() -> Callable:
        def scan(text: str | None) -> list:
            base, spans = all_spans(text or "", model, settings)
            counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
            return [*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)]

        def clean(text: str | None, *n_chars) -> list:
            if text is None:
                return [text, *n_chars]
            cleaned = redact(text, all_spans(text, model, settings)[1])
            return [cleaned, *(n if cleaned == text else len(cleaned) for n in n_chars)]

        return clean if redacting else scan

    return with_values(docs, changed, added, start, others)
