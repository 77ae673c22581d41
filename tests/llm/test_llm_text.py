"""Quality rules, secret scans, byte-level BPE and language identification."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from basketlens.llm import bpe, catalog, language, quality, secrets, toxicity
from tests.conftest import SF_DIR
from tests.llm.helpers import base_features, documents, secret_spans, sha

ODD = [
    None, "", " ", "\n\n \t", "a", "a\x1cb c", "x " * 5000, "word" * 20000, "é ü  日本 🙂", "A\nA\nA\n\n\n",
    "the same eight words are in this line\n" * 4, "# * $ % & | < >", "\x00 zero",
]
joined = lambda parts, n: st.lists(st.sampled_from(parts), max_size=n).map("".join)
TEXTS = st.text(st.sampled_from(list("ab \n\t#é$")), max_size=120)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# op1


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_base_features_match_brute_force(text):
    data = text.encode()
    assert quality.base_features(text, data, data.split()) == base_features(text)[:5]


def test_quality_query_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in catalog.QUERIES["op1_distribution_divergence"](spark, SF_DIR).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        r = got[row.doc_id]
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == base_features(row.text)
        assert not (r.base_failed and r.kept)


def test_quality_keeps_good_documents_and_drops_most_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = catalog.QUERIES["op1_distribution_divergence"](spark, sf).where("not base_failed").collect()
    good = [r.kept for r in got if labels.get(r.doc_id) == 1]
    junk = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert all(good)
    assert np.mean(junk) < 0.35


def test_quality_odd_texts_and_clashing_columns(spark):
    df = documents(spark, [(i, t) for i, t in enumerate(ODD)] + [(0, None), (0, None), (None, "b")])
    df = df.selectExpr("*", "1 as kept", "'x' as n_words", "array(1) as extra")
    rows = quality.assessed(df).collect()
    assert len(rows) == len(ODD) + 3 and "extra" in rows[0].asDict()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_features(r.text)
    assert quality.assessed(df.where("false")).count() == 0
    alone = documents(spark, [(1, "Some plain words. " * 40, None)])
    assert quality.assessed(alone).first().kept is False  # repeats


def test_quality_keeps_clean_documents_of_a_rare_language(spark):
    draw = random.Random(6)
    common, rare = [f"c{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)], [f"r{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    rows = [(i, " ".join(draw.choices(common, k=300)), "en") for i in range(40)]
    rows += [(100 + i, " ".join(draw.choices(rare, k=150)), "is") for i in range(10)]
    rows += [(200, "again and " * 100, "is"), (201, " ".join(draw.choices(rare, k=150)), "en"), (202, " ".join(draw.choices(rare, k=150)), None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.assessed(documents(spark, rows)).collect()}
    assert all(got[i] == (False, True) for i in [*range(40), *range(100, 110)])
    assert got[200] == (True, False) and got[201] == got[202] == (False, False)


def test_quality_has_no_least_size_of_a_language(spark):
    draw = random.Random(7)
    words = {lang: [f"{lang}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] for lang in "abc"}
    text = lambda lang, n: " ".join(draw.choices(words[lang], k=n))
    rows = [(i, text("a", 300), "a") for i in range(30)] + [(100 + i, text("b", 60), "b") for i in range(4)]
    rows += [(200, text("c", 400), None), (201, text("c", 60), None), (202, text("c", 400), "a")]
    got = {r.doc_id: r.kept for r in quality.assessed(documents(spark, rows)).collect()}
    assert all(got[i] for i in [*range(30), *range(100, 104)])
    assert not got[200] and not got[202]  # a small language's wider limit holds for its own documents only


def test_distance_is_between_zero_and_one():
    p = np.array([0.5, 0.5, 0])
    assert quality.distance(np.array([5, 5, 0]), p) == 0
    assert quality.distance(np.array([0, 0, 9]), p) == 1
    assert quality.distance(np.array([0, 0, 0]), p) == 1


# op6


@given(joined([*"aAf0 9=:\"'_-", "token", "api_key", "AKIA", "PassWord", "ſ", "\u212a", "0123456789ab" * 2], 25))
@settings(max_examples=300, deadline=None)
def test_base_spans_match_brute_force(text):
    assert [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in secrets.base_spans(text)] == secret_spans(text)


def test_secret_query_against_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in catalog.QUERIES["op6_crf_secrets"](spark, SF_DIR).collect():
        base = secret_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(base))
        assert set(base) <= set(filter(None, r.spans.split(",")))
        counts = [sum(s.startswith(kind) for s in base) for kind in ("assign", "access", "hex")]
        assert [r.n_assign, r.n_access, r.n_hex] == counts


def trained(seed):
    draw = random.Random(seed)
    lines = []
    for _ in range(150):
        secret = "".join(draw.choices("0123456789abcdef", k=40))
        number = "".join(draw.choices("0123456789", k=16))
        lines.append(f'some words then token = "{secret}" and more\ncall {number[:3]}-{number[3:7]} on 10.1.2.{number[:2]} or {number}')
    examples = []
    for line in lines:
        spans = secrets.base_spans(line)
        examples += [(s, secrets.gold(s, spans), secrets.file_features(line)) for s in secrets.stretches(line, 8)]
    return secrets.fit(examples, secrets.Settings())


def test_field_finds_secrets_without_the_pattern_and_leaves_numbers_alone():
    model, settings_ = trained(1), secrets.Settings()
    draw, found, wrong = random.Random(2), 0, 0
    for _ in range(50):
        value = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=40))
        base, spans = secrets.all_spans(f"Authorization: Bearer {value} sent", model, settings_)
        found += not base and any(k == 3 for _, k, _ in spans)
        number = "".join(draw.choices("0123456789", k=16))
        plain = f"pay {number} or +1 (702) 555-{number[:4]} from 192.168.1.{number[:2]}, see mail{number[:2]}@x{number[:1]}.example.com"
        wrong += bool(secrets.all_spans(plain, model, settings_)[1])
    assert found >= 45 and wrong == 0


def test_viterbi_is_the_best_path():
    draw = np.random.default_rng(0)
    moves = draw.normal(size=(3, 3))
    moves[0, 2] = -np.inf
    for n in (1, 2, 4):
        scores = draw.normal(size=(n, 3))
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n)

        def value(path):
            whole = [0, *path, 0]
            return sum(scores[i, t] for i, t in enumerate(path)) + sum(moves[a, b] for a, b in zip(whole, whole[1:]))

        assert value(secrets.viterbi(scores, moves)) == max(map(value, paths))
        tags, _ = secrets.expected(scores, moves)
        values = np.exp([value(p) for p in paths])
        brute = [[values[paths[:, i] == t].sum() / values.sum() for t in range(3)] for i in range(n)]
        assert np.allclose(tags, brute)


def test_redaction_and_odd_texts(spark):
    df = documents(spark, [(i, t) for i, t in enumerate(ODD)] + [(99, 'x token = "0123456789abcdef0123456789abcdef" y')])
    rows = {r.doc_id: r for r in secrets.scanned(df, redacting=True).collect()}
    assert rows[99].text == f'x {secrets.PLACEHOLDER}" y' and rows[99].n_chars == len(rows[99].text)
    assert [rows[i].text for i in range(len(ODD))] == ODD
    spans = secrets.scanned(df.withColumn("spans", df.doc_id)).collect()
    assert all(r.spans == "" for r in spans if r.doc_id != 99)
    assert secrets.scanned(df.where("false")).count() == 0


# op8


@pytest.fixture(scope="module")
def coder():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return bpe.Coder(bpe.read_ranks(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tiktokens(coder):
    ranks = {token.encode("latin-1"): rank for token, rank in coder.ranks.items()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


@given(st.one_of(joined([*"aeinrst \n\t'", "the", "ing", "'ll", "\x1c", "\x85", "\u3000", "é"], 60), st.text(max_size=60)))
@settings(max_examples=500, deadline=None)
def test_encoding_is_tiktokens(coder, tiktokens, text):
    assert ids(coder, text) == tiktokens.encode_ordinary(text)
    assert coder.decode(coder.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["ab" * 20000, " " * 30000, "anrewh" * 5000, "日本" * 5000, "x" * 3000 + "\n" * 3000])
def test_long_pieces(coder, tiktokens, text):
    assert ids(coder, text) == tiktokens.encode_ordinary(text)


def test_every_token_is_its_own_encoding(coder):
    assert all(coder.fits("", token) for token in coder.ranks)


def test_bpe_query_round_trip(spark, docs, tiktokens):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = catalog.QUERIES["op8_byte_bpe"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens = np.array(tiktokens.encode_ordinary(texts[r.doc_id] or ""), "<u4")
        assert r.n_tokens == len(tokens)
        assert r.ids_sha256 == __import__("hashlib").sha256(tokens.tobytes()).hexdigest()
        assert r.decoded_sha256 == sha(texts[r.doc_id] or "")


def test_bpe_odd_texts(spark, tiktokens):
    df = documents(spark, [(i, t) for i, t in enumerate(ODD)]).selectExpr("*", "'x' as ids", "2 as n_tokens")
    file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for r in bpe.with_ids(df, file, public_tokenizers.PATTERN).collect():
        assert r.ids == tiktokens.encode_ordinary(r.text or "") and r.n_tokens == len(r.ids)
    assert bpe.with_ids(df.where("false"), file, public_tokenizers.PATTERN).count() == 0


# op9


def test_language_accuracy_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = catalog.QUERIES["op9_output_codes_language"](spark, sf).collect()
    held = [(r.lang_pred, truth[r.doc_id]) for r in got if r.held_out and truth[r.doc_id]]
    assert len(got) == len(truth) and len(held) > 100
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_codewords_differ_and_every_bit_separates():
    for n in (2, 3, 4, 5, 9, 30):
        code = language.codewords(n)
        assert len({tuple(row) for row in code}) == n
        assert (np.abs(code.sum(0)) < n).all()


def test_language_defined_cases(spark):
    rows = [(1, "the cat and the dog " * 5, "en"), (2, "le chat et le chien " * 5, "fr"), (3, None, "en"), (4, "123 !!", None), (5, "", None)]
    df = documents(spark, rows).selectExpr("*", "'x' as lang_pred")
    got = {r.doc_id: r for r in language.identified(df, df).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["en", "fr", "und", "und", "und"]
    none = language.identified(df, df.where("false")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = language.identified(df, df.where("lang = 'en'")).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    assert language.identified(df.where("false"), df).count() == 0


# op4


def test_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = spark.read.parquet(f"{sf}/labels.parquet").where("doc_id % 2 = 0")
    got = [r for r in toxicity.graded(docs, known, keep=["doc_id"]).collect() if r.doc_id % 2 and r.doc_id in labels]
    toxic = [r.toxic for r in got if labels[r.doc_id]]
    clean = [r.toxic for r in got if not labels[r.doc_id]]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01
    assert all(0 <= r.severity <= 3 for r in got)
    assert np.mean([r.severity for r in got if labels[r.doc_id]]) > 5 * np.mean([r.severity for r in got if not labels[r.doc_id]])


def test_ordinal_gradient_fits_a_known_order():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 2))
    noise = draw.logistic(size=4000)
    y = np.searchsorted([-1.0, 0.5, 2.0], x @ [2.0, -1.0] + noise)
    weights, thresholds = toxicity.ordinal(x, y, np.full(4000, 1 / 4000), toxicity.Settings(steps=800, decay=0.0))
    assert np.allclose(weights, [2, -1], atol=0.15) and np.allclose(thresholds, [-1, 0.5, 2], atol=0.2)


def test_toxicity_defined_cases(spark):
    rows = [(i, "plain words here " * 3) for i in range(40)] + [(100 + i, f"you idiot {i} words") for i in range(40)]
    df = documents(spark, [*rows, (500, None), (501, ""), (502, "An IDIOT, idiot!"), (100, "you idiot again")]).selectExpr("*", "'x' as grade")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows] + [(100, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.graded(df, labels).collect()}
    assert got[502].toxic and got[100].toxic and not got[500].toxic and not got[501].toxic and not got[0].toxic
    none = toxicity.graded(df, labels.where("toxic = 0")).collect()
    assert {(r.severity, r.grade, r.toxic) for r in none} == {(0.0, 0, False)} and len(none) == len(rows) + 4
    assert toxicity.graded(df.where("false"), labels).count() == 0
