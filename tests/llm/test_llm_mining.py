"""Decontamination, hard negatives and collocations against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import leaks, phrases, rtree
from tests.llm.helpers import documents

LEAK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# decontamination


def contaminated(text, items, width=10):
    """(n_words, n_hit, item ids) of a text by looking at every place."""
    words = LEAK_WORD.findall(small(text))
    hit, found = set(), set()
    for item, item_text in items:
        own = LEAK_WORD.findall(small(item_text))
        for i in range(max(1, len(own) - width + 1) if own else 0):
            window = own[i : i + width]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(found)


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short one"),
    (3, None),
    (4, " .,; "),
    (5, "SHORT... one"),
    (None, "nameless item"),
    (6, "é ü 漢字 b"),
    (7, "a a a"),
    (2, "another text of item two"),
    (10, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]
TEXTS = [
    "alpha-BETA gamma.delta\nepsilon zeta,eta theta iota kappa lambda mu nu",
    "x beta gamma delta epsilon zeta eta theta iota kappa lambda",
    "beta gamma delta epsilon zeta eta theta iota kappa lambda! short one, Short One",
    "shorter one, a short\x00one",
    "nameless   item and another text of item two",
    "É é ü 漢字 b 漢字b",
    "a a a a b a a",
    "A a a",
    None,
    "",
    " \n\t.",
    "short",
    "one short " * 3000 + "short one " * 3000,
]


@pytest.mark.parametrize("shard_bytes", [16 << 20, 400])
def test_hits_against_brute_force(spark, shard_bytes):
    docs = documents(spark, list(enumerate(TEXTS)) + [(3, TEXTS[0]), (None, TEXTS[1])])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = leaks.scanned(docs, items, leaks.Settings(shard_bytes=shard_bytes), keep=["doc_id", "text"]).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        n, hit, found = contaminated(r.text, ITEMS)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), digest, hit > 0)
        pieces = [r.text[h.start : h.end] for h in r.hits]
        assert sum(len(LEAK_WORD.findall(small(p))) for p in pieces) == hit
        assert all(LEAK_WORD.match(small(p)[0]) and LEAK_WORD.match(small(p)[-1]) for p in pieces)


def test_hits_in_random_texts(spark):
    rng = random.Random(5)
    words = ["aa", "b", "ab", "ba", "a"]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 16)))) for i in range(12)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 80))) for _ in range(60)]
    docs, table = documents(spark, list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string")
    for r in leaks.scanned(docs, table, leaks.Settings(width=4)).collect():
        n, hit, found = contaminated(r.text, items, 4)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))


@pytest.mark.parametrize("shard_bytes", [16 << 20, 64])
def test_leaks_odd_tables(spark, shard_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clash = documents(spark, [(1, "a short one")]).selectExpr("*", "5 as n_hit", "'x' as hits", "'y' as _hits", "'z' as _items")
    settings = leaks.Settings(shard_bytes=shard_bytes)
    row = leaks.scanned(clash, items, settings).first()
    assert (row.n_hit, row._hits, row._items, row.source) == (2, "y", "z", "s") and row.hits[0].asDict() == {"start": 2, "end": 11}
    assert leaks.scanned(documents(spark, []), items, settings).count() == 0
    row = leaks.scanned(documents(spark, [(1, "a short one")]), items.limit(0), settings).first()
    assert not row.contaminated and row.n_items == 0
    kept = leaks.clean(clash.unionByName(documents(spark, [(2, "fine")]).selectExpr("*", "6 as n_hit", "'x' as hits", "'y' as _hits", "'z' as _items")), items)
    assert [(r.doc_id, r.n_hit, r._hits) for r in kept.collect()] == [(2, 6, "y")] and kept.columns == clash.columns


# hard negatives


def hard_negatives(rows, every=100):
    """Brute force over (id, label, vector) as the contract says."""
    good = {}
    for i, label, v in sorted((r for r in rows if None not in r), key=lambda r: (r[0], r[1])):
        if all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in good.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in good.items() if i != a)
        for neg, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(s, i) for s, i, other in scored if other != label and -80 * neg <= -100 * s <= -100 * neg][:5]
            out += [(a, p, rank + 1, i, -neg, -s) for rank, (s, i) in enumerate(fit)]
    return sorted(out)


def found(spark, rows, settings, every=100, kind="double"):
    table = spark.createDataFrame(rows, f"id long, label int, embedding array<{kind}>").repartition(3)
    return sorted(tuple(r) for r in rtree.mined(table, F.col("id") % every == 0, settings).collect())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_hard_negatives_against_brute_force(spark, seed, shard_rows):
    rng = np.random.default_rng(seed)
    rows = [(int(i), int(rng.integers(0, 3)), rng.normal(size=4).round(1).tolist()) for i in rng.permutation(700)]
    rows += [(1000 + i, 1, [0.5, 0.5, 0.5, 0.5]) for i in range(120)]  # a hot vector, all ties
    rows += [(2000, None, [1.0] * 4), (2100, 1, None), (2200, 1, [1.0, None, 1.0, 1.0]), (2300, 2, [math.nan, 0.0, 0.0, 0.0])]
    rows += [(2400, 2, [math.inf, 0.0, 0.0, 0.0]), (None, 1, [1.0] * 4), (2500, 7, [0.1] * 4), rows[0]]
    settings = rtree.Settings(shard_rows=shard_rows, leaf_rows=8, growth=2, block_anchors=5)
    wanted = hard_negatives(rows)
    assert len(wanted) > 40
    assert found(spark, rows, settings) == wanted


def test_hard_negatives_odd_tables(spark):
    assert found(spark, [], rtree.Settings()) == []
    assert found(spark, [(0, 1, [1.0, 2.0])], rtree.Settings()) == []
    large = [(100 * i, i % 2, [1e6 * (i + 1), 3.0 * i]) for i in range(6)] + [(1, 0, []), (7, 1, [2.0])]
    assert found(spark, large, rtree.Settings()) == hard_negatives([(i, x, (v + [0.0, 0.0])[:2]) for i, x, v in large])


def test_boxes_bound_their_rows_and_the_queue_leaves_boxes_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 5)) * 40
    points = np.floor(np.repeat(centres, 50, axis=0) * 4 + rng.normal(size=(600, 5)))
    settings = rtree.Settings(leaf_rows=16)
    tree = rtree.Tree(np.arange(600), points, settings)
    assert sorted(tree.ids) == list(range(600)) and max(np.diff(tree.cuts)) <= 16
    query = points[17]
    low, high = tree.bounds(query[None, :])
    for leaf, (a, z) in enumerate(zip(tree.cuts, tree.cuts[1:])):
        scores = tree.vectors[a:z] @ query
        assert low[0][tree.leaf_from + leaf] <= scores.min() and scores.max() <= high[0][tree.leaf_from + leaf]
    best = rtree.Best(rtree.LOW, rtree.HIGH, 5, rtree.LOW)
    opened = rtree.searched([tree], [(low[0], high[0])], query, 17, [best])
    assert opened < (len(tree.cuts) - 1) // 2
    order = sorted((-(points[i] @ query), i) for i in range(600) if i != 17)[:5]
    assert sorted((-s, -i) for s, i in best.heap) == order


# collocations


def collocated(rows, least, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in candidates.items():
        around = [
            b
            for (other, *longer), b in candidates.items()
            if other == lang and len(longer) > len(words) and any(longer[i : i + len(words)] == words for i in range(len(longer)))
        ]
        if any(100 * b >= 80 * a for b in around):
            continue
        cuts = [(2_000_000 * a // (f[lang, *words[:k]] + f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, *words[:k]], f[lang, *words[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "a", "é", "x-y", "漢字"]
    weights = [9, 6, 4, 4, 3, 2, 1, 1]

    def text():
        words = rng.choices(vocabulary, weights, k=rng.randrange(0, 60))
        return "".join(w + rng.choice([" "] * 6 + [". ", "\n", "\t", ",", " new york city "]) for w in words)

    rows = [(rng.choice(["en", "de", None, "und"]), text()) for _ in range(150)]
    rows += [("fr", None), (None, ""), ("it", " .,"), ("en", "a " * 400), rows[0], rows[0]]
    table = spark.createDataFrame(rows, "lang string, text string").withColumn("word", F.lit(1)).repartition(5)
    settings = phrases.Settings(least=6, chunk_words=300, buffer=200, tile=2, grid=2)
    wanted = collocated(rows, 6)
    assert len(wanted) > 60
    got = sorted(tuple(r) for r in phrases.collocations(table, settings).collect())
    ranks = {r[:2]: r for r in got}
    assert [(lang, phrase, a, x, y, n, s) for (lang, _, phrase, a, x, y, n, s) in sorted(ranks.values())] == wanted
    first = phrases.collocations(table, phrases.Settings(least=6, top=3)).collect()
    assert sorted(tuple(r) for r in first) == [r for r in got if r[1] <= 3]


def test_tiles_count_as_sorting_does():
    rng = np.random.default_rng(1)
    width = 50
    cells = np.minimum(rng.zipf(1.3, 5000), 49) * width + np.minimum(rng.zipf(1.3, 5000), 49)
    for settings in (phrases.Settings(tile=4, grid=5), phrases.Settings(), phrases.Settings(tile=64)):
        got = dict(zip(*map(np.ndarray.tolist, phrases.tile_counts(cells, width, settings))))
        assert got == Counter(cells.tolist())


def test_collocations_odd_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None), (None, "one two")], "lang string, text string")).count() == 0
    long = spark.createDataFrame([(None, "To be or not to be " * 40_000)], "lang string, text string")
    rows = phrases.collocations(long, phrases.Settings(chunk_words=1000)).collect()
    assert {r.lang for r in rows} == {"und"} and rows[0].n == 240_000
    assert {(r.phrase, r.a) for r in rows} == {(p, a) for _, p, a, *_ in collocated([(None, "to be or not to be " * 40_000)], 30)}
