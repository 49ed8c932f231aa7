"""Pages, vectors, conversations, components and the pipeline against plain versions."""

import html as entities
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codeloom.llm import chat, html, shared, vectors

# Pages.


def page(body, host="a.example", number=0):
    return (number, f"https://{host}/{number}?x=1", body)


def wrapped(paragraphs, extra=""):
    return (
        "<html><head><title>t</title><style>p{}</style></head><body><div class='top menu'><a href=/>Home</a></div>"
        f"<div class=c1><div class=c2>{''.join(f'<p>{p}' for p in paragraphs)}{extra}</div><div class=side-bar-box><p>Side</div></div>"
        "<footer>foot</footer></body></html>"
    )


PAGES = "page_id long, url string, html string"


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in html.extract_pages(spark.createDataFrame(rows, PAGES)).collect()}


def test_template_of_a_host(spark):
    rnd = random.Random(1)
    prose = lambda: [" ".join(f"w{rnd.randrange(9999)}" for _ in range(rnd.randint(20, 60))) for _ in range(rnd.randint(1, 4))]
    own = {i: prose() for i in range(6)}
    rows = [page(wrapped(p, "<section class=end><p>All rights are ours</section>"), number=i) for i, p in own.items()]
    # The last page holds less in the main slot than beside it; the host's template still names the slot.
    own[6] = ["short"]
    rows.append(page(wrapped(own[6]).replace("Side", "side words " * 30), number=6))
    got = texts_of(spark, rows)
    assert got == {i: "\n\n".join(p) for i, p in own.items()}


def test_article_without_its_surroundings(spark):
    body = (
        "<body><header>Site</header><nav><li>Menu</nav><article><header><h1>T &amp; t</h1></header><p>One <a href=x>two</a> th<b>r</b>ee.<br>\n next"
        "<script>var p = '</p>';</script><form>Name <input></form><div class='ad box'>Buy</div><ul><li>x &lt;y&gt;</li><li>é&#233;</ul>"
        "<div id=comments><p>nice post</div></article><aside>Aside</aside><div class=cookie-notice>We use</div><footer>F"
    )
    assert texts_of(spark, [page(body)]) == {0: "T & t\n\nOne two three. next\n\nx <y>\n\néé"}


@pytest.mark.parametrize(
    "source,text",
    [
        (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<div", ""), ("<!-- x", ""), ("a &lt;b&gt; c &am", "a <b> c &am"),
        ("<script>x", ""), ("<article>x</article><article class=comment>y y y y y</article>", "x"), ("<body>" + "<div>" * 3000 + "deep", "deep"),
        ("<p title='a>b'>c</p>", "c"), ("<P>a\n\tb</P>", "a b"), ("<main><p>m</main><p>other other other", "m"),
    ],
)
def test_single_pages(source, text):
    assert html.main_text(source, None, []) == text


@pytest.mark.parametrize(
    "body,text",
    [
        ("<div class=post><div class=row><p>A one two</div><div class=row><p>B three</div></div>", "A one two|B three"),
        ("<div class=post><section id=intro><p>Short</section><section id=rest><p>Long long long long long</section></div>", "Short|Long long long long long"),
        ("<div class=content><p>In.<blockquote><p>A very long quote of many words indeed</blockquote><p>Out.</div>", "In.|A very long quote of many words indeed|Out."),
        ("<div class=content><h2>Head</h2><ul><li>a long first item</li><li>b</li></ul></div>", "Head|a long first item|b"),
        ("<div class=content><p>Figures<table><tr><td>many more words here</td><td>22</td></tr></table></div>", "Figures|many more words here|22"),
        ("<article><p>Part one</article><div class=ad>Buy</div><article><p>The longer part two</article>", "Part one|The longer part two"),
        ("<main><h1>Title</h1><article><p>Text</article><p>After</main><footer>f</footer>", "Title|Text|After"),
        ("<div class=x><ul><li><a href=/>Home</a><li><a href=/b>All news</a></ul><div class=y><p>Prose of the page</div></div>", "Prose of the page"),
    ],
)
def test_all_slots_of_the_main_region(body, text):
    assert html.main_text(f"<html><body><nav>Menu</nav>{body}</body></html>", None, []) == text.replace("|", "\n\n")


@pytest.mark.parametrize(
    "wrapper", ["div class='layout has-sidebar'", "div class='content with-comments'", "section id='social-history'", "div class='page widget'", "div id=promo-page"]
)
@pytest.mark.parametrize("inner", ["<article><p>Prose of it.</article>", "<main><p>Prose of it.</main>", "<div class=text><p>Prose of it.</div>"])
def test_names_of_wrappers_do_not_drop_the_main_text(wrapper, inner):
    body = f"<body><nav>Menu</nav><{wrapper}>{inner}<div class=sidebar><p>Side by side</div></{wrapper.split()[0]}><div class=comments><p>nice</div>"
    assert html.main_text(body.replace("<div class=comments><p>nice</div>", ""), None, []) == "Prose of it."
    assert html.main_text(body, None, []) == "Prose of it."


def test_names_still_drop_what_is_beside_the_article():
    body = "<article><p>Prose of the page</article><div class=related><article><p>Teaser</article></div><div class=comment-list><p>nice post and more words</div>"
    assert html.main_text(body, None, []) == "Prose of the page"
    assert html.main_text("<div class=text><p>Prose</div><div class=comments><div><p>many many many words</div></div>", None, []) == "Prose"


@pytest.mark.parametrize(
    "body,text",
    [
        ("<p title=don't>Hello world</p><p>It's here</p><p>Third para</p>", "Hello world|It's here|Third para"),
        ("<p title = \"a>b\" id='c>d' e=f'g>Text</p><p x=\"no end>More</p>", "Text|More"),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p>", "Let x=2 be."),
        ("<p>One <object data=a>two</object> <svg><text>no</text></svg>three<script>no</script> four.</p>", "One two three four."),
        ("<section id='login-guide'><p>How to log in.</section><div class='share-price'><p>It rose.</div><p class=social-history>Then.", "How to log in.|It rose.|Then."),
        ("<div class='post-comments'><p>nice</div><div class='ad-slot-inline'><p>Buy</div><div class='newsletter-signup'>Join</div>", ""),
        ("<div class='share-tools'><a href=/>On this</a> <a href=/>On that</a></div><div class='comment-has-replies'>nice</div>", ""),
    ],
)
def test_inside_an_article(body, text):
    blocks = ["Prose before.", *[t for t in text.split("|") if t], "Prose after."]
    assert html.main_text(f"<body><nav>Menu</nav><article><p>Prose before.</p>{body}<p>Prose after.</p></article>", None, []) == "\n\n".join(blocks)


def test_a_tag_without_an_end_is_read_in_linear_time():
    assert html.main_text("<p " + "a=' " * 200_000 + "='", None, []) == "" and html.main_text("<p " + "= " * 200_000, None, []) == ""


@pytest.mark.parametrize("outer", ["main", "article", "div class=recipe"])
def test_headings_that_recur_stay(spark, outer):
    def recipe(i):
        return (
            f"<nav>Menu</nav><{outer}><h1>Recipe {i}</h1><h2>Ingredients</h2><ul><li>{i} eggs<li>milk of farm {i}</ul><h2>Method</h2><p>Stir {i} times."
            f"<section><h2>Notes</h2><p>Note {i}.</section><h2>Our shop</h2><p>Buy our spoons.</{outer.split()[0]}>"
        )

    got = texts_of(spark, [page(recipe(i), number=i) for i in range(6)])
    assert got == {
        i: f"Recipe {i}\n\nIngredients\n\n{i} eggs\n\nmilk of farm {i}\n\nMethod\n\nStir {i} times.\n\nNotes\n\nNote {i}." for i in range(6)
    }


def plain_templates(rows):
    """Steady and fixed paths of each host from whole occurrence vectors."""
    hosts = {}
    for number, url, source in rows:
        hosts.setdefault(url.split("/")[2], []).append(html.tokens_of(source))
    found = {}
    for host, pages in hosts.items():
        vectors = {}
        for at, (_, tokens) in enumerate(pages):
            for path, above, times, kind in tokens:
                vectors.setdefault((path, above, kind), {})[at] = times
        sizes = {}
        for v in vectors.values():
            sizes[tuple(v.items())] = sizes.get(tuple(v.items()), 0) + 1
        often = {t: 5 * len(v) >= len(pages) for t, v in vectors.items()}
        frames = {t[0]: len(v) for t, v in vectors.items() if t[2] in ("tag", "root") and often[t]}
        steady, fixed = set(), set()
        for t, v in vectors.items():
            valid = sizes[tuple(v.items())] > 1 or often[t]
            if not valid or t[2] in ("tag", "root") or t[1] not in frames or len(v) < 3 or len({pages[at][0] for at in v}) < 3:
                continue
            if t[2] == "text" and len(v) == frames[t[1]]:
                fixed.add(t[0])
            if t[2] == "slot" and 2 * len(v) > frames[t[1]]:
                steady.add(t[1])
        if steady or fixed:
            found[host] = (sorted(steady), sorted(fixed))
    return found


def test_templates_match_whole_occurrence_vectors(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        host = rnd.choice("abc")
        layout = random.Random(host)
        parts = []
        for k in range(layout.randint(3, 6)):
            kind, share = layout.choice(["div class=x", "section", "div id=y1", "ul", "article"]), layout.choice([0.2, 0.6, 1.0])
            if rnd.random() < share:
                text = f"fixed {k}" if layout.random() < 0.6 else f"own {rnd.randrange(10**6)}"
                parts.append(f"<{kind}><h3>part {k}</h3><p>{text}<div><b>{'deep' if rnd.random() < 0.9 else i}</b></div></{kind.split()[0]}>")
        rows.append((i, f"http://{host}.example/{i}", f"<body>{''.join(parts)}<p>{i} end</body>"))
    df = spark.createDataFrame(rows, PAGES)
    got = {r["host"]: (r["steady"], r["fixed"]) for r in html.templates(df, "url", "html", html.FREQUENT_PERCENT, html.FIXED_PAGES).collect()}
    want = {f"{h}": v for h, v in plain_templates(rows).items()}
    assert len(want) == 3 and got == want


@pytest.mark.parametrize("depth", [0, 60])
def test_template_texts_without_a_name(spark, depth):
    own = {i: [f"Own text {i} of this page.", f"More {i * i}."] for i in range(6)}
    around = "".join(f"<div class='level-of-the-layout number-{'abcdefgh'[d % 8]}'>" for d in range(depth))
    rows = [
        page(f"<body>{around}<div class=main-part><h2>From our desk</h2><p>{own[i][0]}<p>Read more in our paper.<p>{own[i][1]}<div><p>Bye</div></div>", number=i)
        for i in own
    ]
    # What only some pages share, or copies of one page, is no template.
    rows += [page(f"<p>{t}", "b.example", 10 + i) for i, t in enumerate(["same", "same", "same", "other"])]
    rows += [page("<p>copy<p>again", "c.example", 20 + i) for i in range(4)]
    got = texts_of(spark, rows)
    assert {i: got[i] for i in own} == {i: "\n\n".join(t) for i, t in own.items()}
    assert [got[i] for i in range(10, 14)] == ["same", "same", "same", "other"] and {got[i] for i in range(20, 24)} == {"copy\n\nagain"}


def test_pages_of_odd_tables(spark):
    rows = [(None, None, "<p>a"), (1, "no host", None), (1, "no host", ""), (2, "http://h/", "<nav>only"), (2, "http://h/", "<nav>only")]
    got = html.extract_pages(spark.createDataFrame(rows, PAGES).withColumn("main", F.lit(1)))
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in got.collect()) == [
        ("1", "", 0), ("1", "", 0), ("2", "", 0), ("2", "", 0), ("None", "a", 1)
    ]
    assert html.extract_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r, got in zip(df.orderBy("page_id").collect(), html.extract_pages(df).orderBy("page_id").collect()):
        blocks = re.split(r"</?p>|</?h1>", re.search("<article>(.*)</article>", r["html"], re.S)[1])
        blocks = [" ".join(entities.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert got["text"] == "\n\n".join(b for b in blocks if b)


# Vectors and components.


def groups(links, ids):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("dim,given", [(16, "float"), (3, "double")])
def test_vectors_match_all_pairs(spark, dim, given):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((12, dim))
    rows = []
    for i in range(250):
        v = (base[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0, 0.1, 0.2, 0.25])) * rng.choice([1.0, 3.0])
        rows.append((i, [float(x) for x in (v.astype(np.float32) if given == "float" else v)]))
    rows += [(900, None), (901, [0.0] * dim), (902, [None] * dim), (903, [float("nan")] * dim), (904, [float("inf")] * dim), (905, [])]
    rows += [(950, rows[0][1]), (951, rows[0][1])]
    usable = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in usable.items()}
    links = [(a, b) for a in unit for b in unit if a != b and unit[a] @ unit[b] >= 0.95]
    low = groups(links, [r[0] for r in rows])
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{given}>").withColumn("v", F.lit(1)).repartition(3)
    want = {i: (i, sum(a == i for a, _ in links), low[i], low[i] == i) for i, _ in rows}
    for settings in ({}, {"cell_rows": 20, "home_rows": 16}):
        assert {r["vec_id"]: tuple(r) for r in vectors.near_vectors(df, **settings).collect()} == want


def test_vectors_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert vectors.near_vectors(spark.createDataFrame([], kind)).collect() == []
    got = vectors.near_vectors(spark.createDataFrame([(None, [1.0]), (2, [1.0]), (3, [1.0, 0.0]), (1, [2.0])], kind)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 0, None, True), (2, 1, 1, False), (3, 0, 3, True), (1, 1, 1, True)], key=str)


def test_a_ball_visits_the_cells_it_touches():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x, y = rng.normal(0, 0.2, 4), rng.normal(0, 0.2, 4)
        cell = int(((y >= 0) << np.arange(4)).sum())
        assert cell in vectors.visited(x, float(((x - y) ** 2).sum()) + 1e-12)


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)]])
def test_components(spark, edges):
    got = {r["id"]: r["component_id"] for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    edges = [e for e in edges if e[0] != e[1]]
    assert got == groups(edges, {x for e in edges for x in e})


# Conversations.


def test_snapshots_collapse(spark):
    turns = {1: "ab", 2: "abc", 3: "abc", 4: "abd", 5: "x", 6: "abcd", 7: "bc", 8: "xy"}
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", t) for c, text in turns.items() for i, t in enumerate(text)]
    random.Random(1).shuffle(rows)
    rows += [(20, 0, None, None), (21, 0, "user", ""), (22, None, "user", "<|im_end|>"), (23, 5, "user", "t"), (23, 5, "user", "t"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("i", F.lit("z")).withColumn("hash", F.lit(0))
    got = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert sorted(got, key=str) == sorted([4, 6, 7, 8, 20, 21, 22, 23, None], key=str)
    assert got[6]["n_turns"] == 4 and got[23]["n_turns"] == 2
    assert got[8]["text"] == "<|im_start|>user\nx<|im_end|>\n<|im_start|>assistant\ny<|im_end|>\n"
    assert got[22]["text"] == "<|im_start|>user\n< |im_end|><|im_end|>\n"
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_equal_conversations_stay_once(spark):
    rows = [(c, t, "user", f"m{t}") for c in (5, 3, 9) for t in range(3)]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(r["conv_id"], r["n_turns"], r["n_copies"]) for r in got] == [(3, 3, 3)]


def test_chat_runs_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    hashed = chat.hashed_turns(df, "conv_id", "turn", "role", "text")
    for part in (hashed, chat.maximal(hashed), chat.format_conversations(df)):
        assert not re.search("Python|Pandas|Arrow", part._jdf.queryExecution().toString())


# Pipeline.


def test_stages_keep_columns_and_take_effect(spark):
    rnd = random.Random(8)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    passage, copy = own(60), own(100)
    texts = {
        0: own(80), 1: "too short", 2: copy, 3: copy, 4: copy + " more", 5: f"{own(90)}\n{passage}\n{own(5)}", 6: f"{own(95)}\n{passage}\n{own(5)}",
        7: f"{own(60)} mail me@example.com {own(30)}", 8: None, 9: "spam " * 100,
    }
    rows = [(i, t, "en", "s", len(t) if t else None) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = shared.saved(stage(spark, docs, ""), "stage")
        seen[name] = {r["doc_id"]: r for r in docs.collect()} if name != "packing" else docs.collect()
        assert name == "packing" or docs.columns == columns
    assert sorted(seen["quality rules"]) == [0, 2, 3, 4, 5, 6, 7]
    assert sorted(seen["near duplicates"]) == [0, 2, 5, 6, 7]
    cut = seen["repeated passages"]
    assert passage in cut[5]["text"] and passage not in cut[6]["text"] and cut[0]["text"] == texts[0]
    assert cut[6]["n_chars"] == len(cut[6]["text"])
    assert "[EMAIL]" in seen["personal data"][7]["text"]
    assert {r["doc_id"] for r in seen["packing"]} == {0, 2, 5, 6, 7}
