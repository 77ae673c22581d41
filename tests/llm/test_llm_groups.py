"""Near-duplicates, components, embeddings, mixing, pages, conversations and the pipeline."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from basketlens.llm import catalog, chat, html, mixing, neardup, neighbours, quality, template
from basketlens.llm.components import connected
from tests.conftest import SF_DIR
from tests.llm.helpers import components, documents, embedding_links, near_duplicates
from tests.oracle_compare import compare, connect


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, name):
    sql = connect(SF_DIR).sql(catalog.SQL[name]).df()
    assert compare(catalog.QUERIES[name](spark, SF_DIR).toPandas(), sql) is None


def test_queries_are_registered():
    names = entry.queries()
    assert catalog.QUERIES.keys() <= names.keys() and "pipeline" in names
    assert {int(name[2:].split("_")[0]) for name in catalog.QUERIES} == set(range(1, 14))


# components


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 560)]
    rows = connected(spark.createDataFrame(links + [(None, 3), (7, 7)], "a long, b long")).collect()
    truth = components({x for pair in links for x in pair}, links)
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in rows} == {n: truth[n] for n in ends}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# op2


def variants(seed, n):
    """Families around a base text with more and less edited copies, exact copies and loners."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(4):
        base = draw.choices(vocabulary, k=90)
        for _ in range(n):
            text = list(base)
            for _ in range(draw.choice([0, 1, 2, 4, 6, 9, 15])):
                text[draw.randrange(len(text))] = draw.choice(vocabulary) + str(draw.randrange(50))
            rows.append(" ".join(text))
    rows += [" ".join(draw.choices(vocabulary, k=40)) for _ in range(40)] + rows[:20]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_against_brute_force(spark, seed):
    rows = variants(seed, 60)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "One"), (1004, "one"), (1005, "é É"), (1006, "É é"), (1007, "a b a b a b"), (1008, "B a A b A")]
    small = neardup.Settings(queries_per_block=3, members_per_block=16)
    got = {r.doc_id: r for r in neardup.clustered(documents(spark, rows).select("doc_id", "text"), small).collect()}
    truth = near_duplicates(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == truth
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_minima_agree_as_often_as_sets_overlap():
    signer = neardup.Signer(neardup.Settings(bands=100, rows=10))
    words = [f"word{i}" for i in range(1200)]
    a, b = neardup.shingles(" ".join(words[:1000])), neardup.shingles(" ".join(words[200:]))
    jaccard = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signer.minima(a) == signer.minima(b)).mean() - jaccard) < 0.06


def test_near_duplicates_odd_tables(spark):
    df = documents(spark, [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "x"), (3, "y")])
    df = df.withColumn("kept", F.lit("?")).withColumn("n_shingles", F.lit(1))
    rows = neardup.clustered(df.select("doc_id", "text")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in rows) == [
        (-1, -1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)
    ]
    assert sorted(r.doc_id or -1 for r in neardup.deduplicated(df).collect()) == [-1, 1, 1, 3, 3]
    assert neardup.deduplicated(df).columns == df.columns
    assert neardup.clustered(df.select("doc_id", "text").where("false")).count() == 0


# op3


def clouds(seed):
    draw = np.random.default_rng(seed)
    rows = []
    for size in (1, 2, 3, 5, 30, 60):
        center = draw.normal(size=24)
        label = int(draw.integers(0, 2))
        rows += [((center + draw.normal(size=24) * 0.09).tolist(), label) for _ in range(size)]
    rows += [(draw.normal(size=24).tolist(), int(draw.integers(0, 2))) for _ in range(80)] + rows[:5] + rows[40:43]
    rows += [(None, 1), ([], 1), ([0.0] * 24, 1), ([float("nan")] * 24, 1), ([1.0] * 24, None), ([None, 1.0], 0), ([1e200, 1e200], 0), ([1e-200, 1e-200], 0), ([1.0, 1.0], 0)]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_embeddings_against_brute_force(spark, seed):
    rows = clouds(seed)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("kept", F.lit(0))
    small = neighbours.Settings(neighbours=4, bucket=16, block=8)
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.clustered(df, small).collect()}
    fine = [(i, [x / 1e200 if abs(x) > 1e100 else x * 1e200 if x and abs(x) < 1e-100 else x for x in v] if v and None not in v else v, label) for i, v, label in rows]
    assert got == embedding_links(fine)


def test_embeddings_odd_tables(spark):
    ddl = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)], ddl)
    rows = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in neighbours.clustered(df).collect())
    assert rows == [(-1, 0, -1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert neighbours.clustered(df.where("false")).count() == 0


def around(centre, cosine, n, rng):
    """Unit vectors at a cosine to ``centre``."""
    away = rng.standard_normal((n, len(centre)))
    away -= np.outer(away @ centre, centre)
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    return cosine * centre + np.sqrt(1 - cosine**2) * away


def embedded(spark, vectors):
    return spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")


def test_groups_that_fill_their_own_lists_are_linked_across(spark):
    rng = np.random.default_rng(1)
    first = np.eye(32)[0]
    second = 0.983 * first + np.sqrt(1 - 0.983**2) * np.eye(32)[1]
    vectors = np.vstack([around(first, 0.9998, 20, rng), around(second, 0.9998, 20, rng)])
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.clustered(embedded(spark, vectors)).collect()}
    assert len({c for _, c in got.values()}) == 1
    assert got == embedding_links([(i, v.tolist(), 1) for i, v in enumerate(vectors)])


def audit_tables(spark, n, pairs, found):
    """Nodes of loners and linked pairs, and what was found of the pairs."""
    rng = np.random.default_rng(2)
    loners = rng.standard_normal((n, 32))
    loners /= np.linalg.norm(loners, axis=1, keepdims=True)
    twins = np.vstack([around(v, 0.99, 1, rng) for v in loners[:pairs]])
    rows = [(i, 1, 32, bytearray(v.tobytes()), 1) for i, v in enumerate(np.vstack([loners, twins]))]
    nodes = spark.createDataFrame(rows, "id long, label int, dim int, vector binary, n long")
    ends = [(i, i, 1) for i in range(found)] + [(n + i, i, 1) for i in range(found)]
    return nodes, spark.createDataFrame(ends, "id long, component long, weight long")


def test_audit_sees_pairs_of_which_nothing_was_found(spark):
    nodes, found = audit_tables(spark, 4000, 20, 10)
    assert neighbours.audited(nodes, found, neighbours.Settings()) == 0.5
    assert neighbours.audited(*audit_tables(spark, 300, 20, 20), neighbours.Settings()) == 1


def test_crowded_places_are_split_until_within_bounds(spark):
    rng = np.random.default_rng(3)
    crowd = around(np.eye(32)[0], 0.9, 1500, rng)
    crowd = np.vstack([crowd, np.tile(np.eye(32)[1], (100, 1))])  # no plane can split these
    rows = [(i, bytearray(v.tobytes())) for i, v in enumerate(crowd)]
    vectors = spark.createDataFrame(rows, "id long, vector binary")
    places = spark.createDataFrame([(1, 32, 5, i) for i in range(1600)], "label int, dim int, code long, id long")
    got = neighbours.refined(places, vectors, neighbours.Settings(bucket=8)).collect()
    assert sorted(r.id for r in got) == list(range(1600))
    sizes = Counter(r.code for r in got)
    assert sorted(sizes.values())[-2] <= 64 and sizes.most_common(1)[0][1] in range(100, 165)
    assert len({r.code for r in got if r.id >= 1500}) == 1


def test_pairs_in_a_narrow_cone_are_found(spark):
    rng = np.random.default_rng(4)
    cone = around(np.eye(64)[0], 0.7, 1500, rng)
    vectors = np.vstack([cone, *(around(v, 0.981, 1, rng) for v in cone[:300])])
    got = {r.vec_id: r.n_links for r in neighbours.clustered(embedded(spark, vectors), neighbours.Settings(bucket=8)).collect()}
    truth = {i: n for i, (n, _) in embedding_links([(i, v.tolist(), 1) for i, v in enumerate(vectors)]).items()}
    assert sum(got.values()) >= 0.95 * sum(truth.values()) and all(got[i] <= truth[i] for i in truth)


def test_runs_share_half():
    assert list(neighbours.runs(iter("abcdefg"), 4)) == [list("abcd"), list("cdef"), list("efg")]
    assert list(neighbours.runs(iter("abcd"), 4)) == [list("abcd")] and list(neighbours.runs(iter(""), 4)) == []


# op7


def test_mixing_comes_near_its_targets(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(["w"] * draw.randrange(0, 60)), "en", source) for i, source in enumerate(draw.choices(["a", "b", None, "c"], [1, 9, 2, 1], k=3000))]
    got = mixing.with_copies(documents(spark, rows)).collect()
    assert sum(r.size for r in got) == pytest.approx(sum({r.source: r.target for r in got}.values()))
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, rel=0.03)
        assert own[0].target <= 3 * own[0].source_size
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in own)
    again = mixing.with_copies(documents(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_mixing_odd_tables(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "one", "en", None), (3, "one", "en", None), (None, "b c", "en", "b"), (5, "x " * 9000, "en", "b")]
    df = documents(spark, rows).selectExpr("*", "'x' as target", "'y' as copies", "3 as _place_")
    got = mixing.with_copies(df).collect()
    assert len(got) == 6 and all(r.taken <= 3 * r.size for r in got)
    assert [r.target for r in got if r.source == "a"] == [0.0, 0.0]
    assert mixing.with_copies(df.where("false")).count() == 0
    mix = mixing.mixed(df)
    assert mix.columns == df.columns and {(r.target, r.copies) for r in mix.collect()} == {("x", "y")}


def test_mixing_keeps_columns_of_its_own_names(spark):
    names = ["_key", "_bucket", "_place", "_source_size", "_target", "_rate", "_offset", "_before", "_own", "_row", "_copy", "n"]
    df = documents(spark, [(4096 * i, "word " * (i % 3)) for i in range(20)]).selectExpr("*", *[f"'{c}' as {c}" for c in names])
    got = mixing.with_copies(df).collect()
    assert len(got) == 20 and all(r[c] == c for r in got for c in names)
    assert mixing.mixed(df).columns == df.columns and all(r[c] == c for r in mixing.mixed(df).collect() for c in names)


# op5

joined = lambda parts, n: st.lists(st.sampled_from(parts), max_size=n).map("".join)

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site name</header>
<nav><a href=/a>Menu, one</a></nav><div class="sidebar"><p>Side, text, with, commas, here.</p></div>
<div class="content"><div><p>First &amp; foremost, a
 paragraph.<p>Second <b>bo</b>ld, one<br>line</div><ul><li>item one<li>item two</ul></div>
<div id="comments"><p>A reader, says, something, long, enough, to, score.</p></div><script>var x="<p>no</p>";</script>
<form><p>Your mail, please, now</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == "First & foremost, a paragraph. Second bold, one line item one item two"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain & simple", "plain & simple"),
        ("<p>a<p>b", "a b"),
        ("<div>x<!-- <p>no</p> --> y</div", "x y"),
        ("<article><h1>Title</h1><p>Short.</p></article><footer>f</footer>", "Title Short."),
        ("<article><h1>Only a title</h1></article>", "Only a title"),
        ("<script>alert(1)", ""),
        ("<td>a</td></b></p>c", "a c"),
        ("<head><title>t</title><p>body text", "body text"),
    ],
)
def test_small_pages(page, text):
    assert html.main_text(page) == text


def test_uneven_sections_are_kept_whole():
    long = "<section>" + "".join(f"<p>Paragraph {i}, which is long enough, says something, and ends here.</p>" for i in range(12)) + "</section>"
    last, short = "<section><p>So it ends.</p></section>", "<section><p>" + "word " * 40 + "</p></section>"
    menu = '<div><a href="/a">One</a> <a href="/b">Two</a></div>'
    for before, after in (("", last), (short, last), (last, "<div><p>A closing remark.</p></div>")):
        text = html.main_text(f"<body>{menu}{before}{long}{after}{menu}</body>")
        for part in (before, after):
            assert " ".join(re.sub("<[^>]*>", "", part).split()) in text
        assert "Two" not in text and text.count("Paragraph") == 12
    assert html.main_text(f"<article>{long}</article><div><p>Offer.</p></div>").count("Offer") == 0


@given(joined(["<p>", "</p>", "<div>", "</div>", "<b", ">", "<li>", "<!--", "-->", "<script>", "</script>", "x", " ", "&amp;", '"', "<table><tr><td>", "<nav>", "</nav>"], 40))
@settings(max_examples=300, deadline=None)
def test_any_markup_is_read(page):
    text = html.main_text(page)
    assert text == " ".join(text.split())


def test_pages_query_returns_the_article(spark):
    import re
    from html import unescape

    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in catalog.QUERIES["op5_tree_scoring_html"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    for row in rows:
        article = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        expected = " ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?(p|h1)>", " ", article))).split())
        assert got[row.page_id].text == expected and got[row.page_id].n_chars == len(expected)


def test_pages_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (None, "<p>a</p>"), (2, "<p>" + "word, " * 50000)], "page_id long, html string")
    df = df.withColumn("text", F.lit(1)).withColumn("extra", F.lit(2))
    got = {r.page_id: r for r in html.extracted(df).collect()}
    assert got[1].text == "" and got[None].text == "a" and got[2].n_chars == 50000 * 6 - 1
    assert html.extracted(df.where("false")).count() == 0


# op10


def test_template_language():
    run = template.compile(
        "{% set n = 'x' ~ 1 %}{# note #}{% for m in items %}{% if loop.first %}<{% elif m.a == \"q\" %}Q{% else %}-{% endif %}"
        "{{ m['a'] | up }}{% generation %}{{ n }}{% endgeneration %}{% if loop.last %}>{% endif %}{% endfor %}",
        {"up": str.upper},
    )
    pieces = list(run({"items": [{"a": "p"}, {"a": "q"}, {"a": "r"}]}))
    assert "".join(text for text, _ in pieces) == "<Px1QQx1-Rx1>"
    assert "".join(text for text, said in pieces if said) == "x1x1x1"


def test_constants_are_folded():
    tree = template.fold(template.parse("a{{ 'b' ~ (1 + 2) }}{% if 1 > 2 %}no{% else %}c{% endif %}{{ x | f }}"), {"f": str})
    assert tree == [("text", "ab3c"), ("output", ("filter", "f", ("name", "x")))]


@pytest.mark.parametrize("source", ["{% for x %}{% endfor %}", "{% if a %}", "{{ a( }}", "{{ a | nope }}", "{% endif %}", "{{ 'a }}", "{{ }}"])
def test_bad_templates(source):
    with pytest.raises(template.TemplateError):
        template.compile(source)


def test_templates_reach_nothing_else():
    for source in ("{{ x.__class__ }}", "{{ missing }}", "{{ x['y'] }}"):
        with pytest.raises(template.TemplateError):
            list(template.compile(source)({"x": {}}))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool<"]), joined(["<s>", "[INST]", "\\", "\\l", "</s>\n", "a", " ", "é"], 8)), max_size=5))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns):
    program = template.compile(chat.TEMPLATE, {"escape": chat.escape})
    _, text, spans = chat.whole(program({"messages": [{"role": r, "text": t} for r, t in turns]}))
    assert chat.turns(text) == turns
    said = "".join(chat.unescape(text[s["start"] : s["end"]]) for s in spans)
    assert said == "".join(t for r, t in turns if r == "assistant")


def test_chat_odd_tables(spark):
    ddl = "conv_id long, turn int, role string, text string"
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, None, "x"), (2, 5, "user", "z" * 200000), (1, 1, "assistant", "b"), (1, None, "user", "first")]
    df = spark.createDataFrame(rows, ddl).withColumn("n_turns", F.lit("?"))
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    assert chat.turns(got[1].formatted) == [("user", "first"), ("user", ""), ("assistant", "b"), ("assistant", "b")]
    assert chat.turns(got[None].formatted) == [("", "x")] and len(got[2].formatted) > 200000
    assert got[1].n_turns == 4 and len(got[1].loss_spans) == 2
    assert chat.formatted(df.where("false")).count() == 0 == chat.formatted(df.where("false"), digest=True).count()


# pipeline


def test_stages_keep_whole_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "secret scan", "source mix", "token ids"]

    kept = {r.doc_id for r in quality.assessed(docs).where("kept").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, SF_DIR).cache()
    assert {r.doc_id for r in first.collect()} == kept and first.columns == columns

    rows = [(r.doc_id, r.text) for r in first.collect()]
    heads = {i for i, (_, low) in near_duplicates(rows).items() if low == i}
    second = corpus_pipeline.near_duplicates(spark, first, SF_DIR).cache()
    assert {r.doc_id for r in second.collect()} == heads and second.columns == columns

    third = corpus_pipeline.secret_scan(spark, second, SF_DIR).cache()
    before = {r.doc_id: r.text for r in second.collect()}
    for r in third.collect():
        assert r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or "[secret]" in r.text
    assert third.count() == len(before) and third.columns == columns

    fourth = corpus_pipeline.source_mix(spark, third, SF_DIR).cache()
    copies = {r.doc_id: r.copies for r in mixing.with_copies(third).collect()}
    counts = {r.doc_id: r["count"] for r in fourth.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n} and fourth.columns == columns

    fifth = corpus_pipeline.token_ids(spark, fourth, SF_DIR)
    assert fifth.columns == [*columns, "n_tokens", "ids"] and fifth.count() == fourth.count()
    for frame in (first, second, third, fourth):
        frame.unpersist()


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_stages_take_empty_tables(spark):
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
