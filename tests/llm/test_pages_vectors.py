"""Page and vector operators against plain versions, and on odd rows; the pipeline."""

import math
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import connect, differences
from keepsight.llm.html_text import extract_text
from keepsight.llm.near_duplicates import bands
from keepsight.llm.neighbours import nearest_neighbours
from keepsight.llm.page_blocks import parse, role_of
from keepsight.llm.queries import ORACLES, QUERIES, URL_RULES, url_rules
from keepsight.llm.url_rules import judge_urls

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), name) == []


# vectors


def nearest_by_hand(rows, k):
    sound = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, a in sound:
        if q % 5 == 0:
            scores = {}
            for i, b in sound:
                if i != q and len(a) == len(b):
                    s = float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
                    scores[i] = max(scores.get(i, -2), s)
            out[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_neighbours_recall_and_copies(table):
    random = np.random.default_rng(2)
    centres = random.normal(size=(8, 12))
    rows = [(i, (centres[i % 8] + 0.6 * random.normal(size=12)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one vector with many copies
    rows += [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [None] * 12), (2004, [math.nan] * 12)]
    rows += [(2005, [math.inf] * 12), (None, rows[1][1]), (2010, [1.0, 2.0]), (2011, [2.0, 4.1]), (3, rows[3][1])]
    df = table([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<double>, label int, score double")
    found = {}
    for r in nearest_neighbours(df, F.col("vec_id") % 5 == 0, shard_rows=200, query_rows=50).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest_by_hand(rows, 5)
    assert set(found) == {q for q, own in want.items() if own}
    hits = total = 0
    for q, own in found.items():
        own.sort()
        assert [n for n, _, _ in own] == list(range(1, len(want[q]) + 1))
        assert [x[1:] for x in own] == sorted((x[1:] for x in own), key=lambda x: (-x[1], x[0]))
        hits += len({i for _, i, _ in own} & {i for i, _ in want[q]})
        total += len(want[q])
    assert hits / total >= 0.95
    assert [i for _, i, _ in found[1000]] == [0, 1001, 1002, 1003, 1004]
    assert [i for _, i, _ in found[2010]] == [2011]


def test_neighbours_ties_of_one_direction(table):
    rows = [(i, [0.1 * (i + 1) * x for x in (1.0, -2.0, 0.3)]) for i in range(20)]
    rows += [(i, [2.0, 1.0, float(i)]) for i in range(20, 30)]
    df = table(rows, "vec_id long, embedding array<double>")
    got = nearest_neighbours(df, F.col("vec_id") == 0, shard_rows=4, query_rows=1).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    assert all(abs(r.score - 1) < 1e-12 for r in got)


def test_neighbours_ties_of_many_directions(table):
    # all rows but the query are equally near to it, in shards of a few nodes
    rows = [(0, [1.0, 0.0, 0.0])]
    rows += [(i, [1.0, math.cos(i), math.sin(i)]) for i in range(1, 40)]
    df = table(rows, "vec_id long, embedding array<double>")
    got = nearest_neighbours(df, F.col("vec_id") == 0, shard_rows=10, query_rows=1).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]


def test_neighbours_empty(table):
    df = table([], "vec_id long, embedding array<float>")
    assert nearest_neighbours(df, F.col("vec_id") % 5 == 0).count() == 0


# urls


def urls_by_hand(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = m[1].translate({c: c + 32 for c in range(65, 91)}) if m else ""
    path = m[2] if m else ""
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


URLS = [
    None, "", "example.org/es/", "http://", "http://org", "http://org/", "http://EXAMPLE.org/es/x",
    "http://a.example.org/en/12?q#f", "https://example.org/en/2", "https://xexample.org/es/", "ftp://de.com/de/",
    "http://a.com/fr/#x", "http://com/de", "http://example.org?x=/es/", "http://example.org./es/",
    "http://example.org/es/://b.com/de/", "http://ÉXAMPLE.com/de/ü", "x\n://b.com/de/\n", "http://a..com/de/",
]


def test_urls_by_hand(spark, table):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(1, URLS[6], "x", "y")] * 50 + [(None, URLS[7], "x", "y")]
    pages = table(rows, "page_id long, url string, host string, verdict string")
    found = judge_urls(pages, url_rules(spark)).collect()
    assert len(found) == len(rows)
    want = sorted(((i, *urls_by_hand(u, URL_RULES)) for i, u, *_ in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found), key=str) == want


def test_urls_nested_rules(spark, table):
    random = np.random.default_rng(4)
    labels, parts = ["a", "b", "ab", "c"], ["x", "xy", "y", "é"]

    def host():
        return ".".join(random.choice(labels, int(random.integers(1, 4))))

    def path():
        return "/" + "/".join(random.choice(parts, int(random.integers(0, 4))))

    rules = list({(host(), path()): ("block", "allow")[i % 2] for i in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    pages = table(list(enumerate(urls)), "page_id long, url string")
    df = table([*rules, (None, "/", "block"), ("a", None, "block"), rules[0]], "host string, path string, verdict string")
    found = judge_urls(pages, df).collect()
    want = {i: urls_by_hand(u, rules)[2:] for i, u in enumerate(urls)}
    assert {r.page_id: (r.rule, r.verdict) for r in found} == want
    none = judge_urls(pages, df.limit(0), default="ask").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "ask")}
    assert judge_urls(pages.limit(0), df).count() == 0


# html

FULL = (
    "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><header>Site</header>"
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "<div id='sidebar'>Side</div><!-- <p>hidden</p> --><article class='post-{i}'><h1>Head &amp; {i}</h1>"
    "<p>First <b>bo</b>ld&nbsp;text\n here.<p>Second <a href='x'>link</a>.<br>Third</p><div class='ad'>Buy</div>"
    "<form>Name <input></form><table><tr><td>c1<td>c2</table><section id='comments'><p>Me too</p></section>"
    "</article><aside>More</aside><footer>&copy; us</footer></body></html>"
)
PLAIN = (
    "<div class=top>Welcome to the site</div><ul class=x><li><a href=a>One link</a><li><a href=b>Two link</a></ul>"
    "<div class=text><p>Body number {i} of the page</p></div><div>All rights reserved</div>"
)


def text_of(df):
    return {r.page_id: r.text for r in df.collect()}


def test_html_parts(table):
    rows = [(i, f"http://a.b/{i}", FULL.replace("{i}", str(i)), "x") for i in range(6)]
    rows += [(100 + i, f"http://plain.b/{i}", PLAIN.replace("{i}", str(i)), "x") for i in range(6)]
    df = table(rows, "page_id long, url string, html string, text string")
    found = extract_text(df).collect()
    for r in found:
        if r.page_id < 100:
            want = f"Head & {r.page_id} First bold text here. Second link. Third c1 c2"
        else:
            want = f"Body number {r.page_id - 100} of the page"
        assert (r.text, r.n_chars) == (want, len(want))


def test_html_odd_pages(table):
    rows = [
        (1, None, None), (2, "http://a.b", ""), (3, "x", "just text"), (4, "http://a.b", "<p>a<b"),
        (5, "http://a.b", "<nav>menu<article>x &lt; y</article>"), (6, "http://a.b", "<script>x"),
        (7, "http://a.b", "<div " + "a='" * 2000 + ">t</div>"), (8, "http://a.b", "<p>" + "long " * 30_000),
        (None, "http://a.b", "<article>n</article>"), (9, "u", "<article>n</article>"), (9, "u", "<article>n</article>"),
    ]
    df = table(rows, "page_id long, url string, html string")
    found = extract_text(df).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    assert texts[1] == texts[2] == texts[6] == "" and texts[3] == "just text"
    assert texts[5] == "x < y" and texts[8] == " ".join(["long"] * 30_000) and texts[None] == texts[9] == "n"
    assert extract_text(df.limit(0)).count() == 0


def test_html_names_are_weak_evidence(table):
    body = "Real text of page {i} that is long enough to be the most of it"
    kinds = [
        ("layout", f"<div class='layout no-sidebar'><p>{body}</p></div>", body),
        ("post", f"<article class='post category-social'><h1 class='entry-header'>H {{i}}</h1><p>{body}</p></article>", f"H {{i}} {body}"),
        ("widget", f"<div class='widget'><p>{body}</p></div><div class='ad'>Buy {{i}}</div>", body),
        ("card", f"<div class='text'><p>{body}</p></div><div class='story-card'>Teaser {{i}}</div>", f"{body} Teaser {{i}}"),
    ]
    rows = [
        (f"{kind} {i}", f"http://{kind}.b/{i}", page.replace("{i}", f"x{i}"))
        for kind, page, _ in kinds
        for i in range(6)
    ]
    found = text_of(extract_text(table(rows, "page_id string, url string, html string")))
    for kind, _, want in kinds:
        assert [found[f"{kind} {i}"] for i in range(6)] == [want.replace("{i}", f"x{i}") for i in range(6)]


def test_html_slots_outweigh_main_names(table):
    page = "<div class='text'><p>Long text number {i} of the real article</p></div><div class='story'>See {i}</div>"
    rows = [(i, f"http://a.b/{i}", page.replace("{i}", f"x{i}")) for i in range(6)]
    found = text_of(extract_text(table(rows, "page_id long, url string, html string")))
    assert all(found[i].startswith(f"Long text number x{i}") for i in range(6))


def test_parse_roles():
    blocks, tokens = parse("<div class='a1'><p>x</p><p>y</p></div>")
    role = role_of(role_of(0, "div[class=a0]"), "p")
    assert [b.text for b in blocks] == ["x", "y"] and tokens[role].times == 2
    assert [b.role for b in blocks] == [role, role] and tokens[role].parent == role_of(0, "div[class=a0]")


def test_parse_deep_nesting_in_linear_memory():
    tracemalloc.start()
    blocks, tokens = parse("<div>" * 100_000 + "deep")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [b.text for b in blocks] == ["deep"] and len(tokens) == 100_001
    assert most < 200_000_000


def pages_of(table, page, n=12):
    rows = [(i, f"http://a.b/{i}", page(i)) for i in range(n)]
    return text_of(extract_text(table(rows, "page_id long, url string, html string")))


def test_html_template_text_in_articles(table):
    page = "<article><p>Body {i} a</p><p>Sign up to the letter</p><p>Body {i} b</p><p>Copyright by us</p></article>"
    found = pages_of(table, lambda i: page.replace("{i}", f"x{i}"))
    assert found == {i: f"Body x{i} a Body x{i} b" for i in range(12)}


def test_html_text_of_most_articles_alone_stays(table):
    # on nine of twelve pages: a class of its own, not that of the template
    found = pages_of(
        table, lambda i: f"<article><p>Body x{i}</p>{'<p>A saying</p>' if i < 9 else ''}<p>All rights</p></article>"
    )
    assert found == {i: f"Body x{i}" + (" A saying" if i < 9 else "") for i in range(12)}


def test_html_text_without_an_order_is_no_template(table):
    # once on every page, as the template's tokens, but not in one order with them
    def page(i):
        parts = ["<p>Wanders about</p>", "<h2>Part of the text</h2>"]
        return f"<article><h1>Top x{i}</h1>{''.join(parts[:: 1 if i % 2 else -1])}<p>All rights</p></article>"

    found = pages_of(table, page)
    assert all("Wanders about" in found[i] and "All rights" not in found[i] for i in range(12))


def test_html_copies_of_one_page_are_no_template(table):
    found = pages_of(table, lambda i: "<article><p>The same text</p></article>")
    assert set(found.values()) == {"The same text"}


def test_html_comments_and_adverts_in_articles_and_page_forms(table):
    page = (
        "<form><article><p>Body x{i} is what the page is about, at length</p>"
        "<div class='ad-slot-2'>Buy x{i}</div><div class='user-comments'>Me x{i}</div></article></form>"
    )
    found = pages_of(table, lambda i: page.replace("{i}", str(i)))
    assert found == {i: f"Body x{i} is what the page is about, at length" for i in range(12)}


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, left = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_dedup", "mixing", "packing"]
    docs = docs.union(docs.limit(5)).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        if name == "near_dedup":
            ids = [r.doc_id for r in docs.select("doc_id").collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) < left
    assert corpus_pipeline.pack_sequences(spark, docs, SMALL).count() > 0


def test_pipeline_drops_copies_from_80_percent_on(spark, documents):
    words = [f"w{i}" for i in range(100)]
    copy = [*words[:90], *(f"x{i}" for i in range(10))]  # 86 of 106 shingles: 0.811
    other = [*words[:88], *(f"y{i}" for i in range(12))]  # 84 of 108 shingles: 0.778
    rows = [(1, words), (2, copy), (3, [f"z{w}" for w in words]), (4, [f"z{w}" for w in other])]
    docs = documents([(i, " ".join(w), "en", "s") for i, w in rows])
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in left) == [1, 3, 4]


def test_bands_suit_the_similarity():
    assert (bands(85), bands(80)) == (6, 9)
