"""Byte-level BPE: exact encoding in linear time, and decoding.

A piece's bytes are mapped to Latin-1 so that a pyahocorasick trie can hold the vocabulary. Encoding walks
through the piece, always trying the longest token first. A token may follow the one before only
if the two bytes strings together would be merged into exactly these two tokens; a sequence in
which every neighbouring pair passes is the encoding that the merges give. If no token fits, the
position is marked dead and the last token is taken back for a shorter one, so every position
is left for good at most once. The pair tests are memoised.

Pieces come from the splitting pattern and repeat a lot, so the ids of short pieces are kept in
a bounded cache, which a worker keeps from task to task. Nothing is shuffled; a document is encoded as a whole, whatever its length.

Defined cases: null text is like an empty one: no ids. Special tokens do not exist. Repeated rows
are encoded alike. Other columns are kept unless an added one has their name.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from basketlens.llm.arrow import with_values, worker_kept

CACHED_PIECE = 64  # longer pieces are not kept
CACHE_SIZE = 150_000  # pieces in either half of the cache
PAIRS_SIZE = 400_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id from a rank file: base64 and number on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class Shorter(dict):
    """Token to the longest token that is a proper prefix of it, '' if none; filled on demand."""

    def __init__(self, prefix: Callable[[str], str]) -> None:
        self.prefix = prefix

    def __missing__(self, token: str) -> str:
        self[token] = found = self.prefix(token[:-1])
        return found


class Coder:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        # white space as Unicode defines it, without the separators that Python's \s adds
        unicode_space = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(unicode_space).findall
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.trie = ahocorasick.Automaton()
        for token in self.ranks:
            self.trie.add_word(token, token)
        self.codes = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.shorter = Shorter(self.prefix)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The tokens of a short string by merging its lowest-ranked pair again and again."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            ranked = [(rank, i) for i, rank in enumerate(pairs) if rank is not None]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, before: str, token: str) -> bool:
        """Whether merging both strings together gives these two tokens; '' stands for the start."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) >= PAIRS_SIZE:
                self.pairs.clear()
            known = self.merged(before + token) == ([before, token] if before else [token])
            self.pairs[before, token] = known
        return known

    def prefix(self, text: str) -> str:
        """The longest token that ``text`` begins with, '' if none."""
        length = self.trie.longest_prefix(text)
        while length and text[:length] not in self.ranks:
            length -= 1
        return text[:length]

    def backtracked(self, text: str) -> list[str]:
        """The tokens of a piece given as Latin-1."""
        if text in self.ranks and self.fits("", text):
            return [text]
        done: list[str] = []
        dead = bytearray(len(text) + 1)
        longest, shorter, pairs = self.longest, self.shorter, self.pairs
        at, before, token = 0, "", self.prefix(text[:longest])
        while at < len(text):
            while token:
                if not dead[at + len(token)]:
                    fits = pairs.get((before, token))
                    if fits or fits is None and self.fits(before, token):
                        break
                token = shorter[token]
            if token:
                done.append(token)
                at += len(token)
                before, token = token, self.prefix(text[at : at + longest])
            elif done:
                dead[at] = 1
                last = done.pop()
                at -= len(last)
                before, token = done[-1] if done else "", shorter[last]
            else:
                raise ValueError("the vocabulary cannot spell this text")
        return done

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers, from the older half of the cache or anew."""
        ids = self.older.get(piece)
        if ids is None:
            tokens = self.backtracked(piece.encode().decode("latin-1"))
            ids = b"".join(map(self.codes.__getitem__, tokens))
        if len(piece) <= CACHED_PIECE:
            if len(self.cache) >= CACHE_SIZE:
                self.older = self.cache.copy()
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        known, fresh = self.cache.get, self.piece_ids
        return b"".join([known(piece) or fresh(piece) for piece in self.split(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def shared_coder(data: bytes, pattern: str) -> Coder:
    """The worker's coder of a vocabulary: the next task finds its caches warm."""
    return worker_kept(("bpe", hashlib.sha256(data).digest(), pattern), lambda: Coder(read_ranks(data), pattern))


def with_ids(docs: DataFrame, rank_file: str, pattern: str, digest: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_tokens and ids, an array of integers.

    With ``digest`` the SHA-256 of the ids and of the bytes decoded from them stand in place of
    the ids. The rank file is read once here and broadcast: its size is the vocabulary's.
    """
    with open(rank_file, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "n_tokens long, ids array<int>"
    names = StructType.fromDDL(added).names
    others = [c for c in (docs.columns if keep is None else keep) if c not in names]

    def start() -> Callable:
        coder = shared_coder(data.value, pattern)

        def row(text: str | None) -> list:
            ids = coder.encode(text or "")
            if not digest:
                return [len(ids) // 4, np.frombuffer(ids, "<i4")]
            decoded = coder.decode(ids)
            return [len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()]

        return row

    return with_values(docs, ["text"], added, start, others)
