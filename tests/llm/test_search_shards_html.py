import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.comparing import same
from tidemark.llm import oracles
from tidemark.llm.html_text import extract_pages, main_text
from tidemark.llm.queries import queries
from tidemark.llm.sharding import stratified_shards
from tidemark.llm.topk import exact_top_k, sorted_lists, threshold_search


def test_top_k_equals_sql(spark, small):
    same(queries()["op8_exact_top_k"](spark, small), oracles.SQL["op8_exact_top_k"], small)


def test_threshold_search_equals_brute_force():
    r = np.random.default_rng(3)
    for n, dim in ((1, 3), (4, 2), (300, 8), (2000, 5)):
        vectors = r.integers(-6, 7, (n, dim)).astype(float)
        ids = r.permutation(n)
        lists = sorted_lists(vectors)
        for query in [*r.integers(-6, 7, (20, dim)).astype(float), np.zeros(dim)]:
            own = int(ids[0])
            best, scores = threshold_search(vectors, ids, lists, query, own, 5)
            wanted = sorted((-(v @ query), i) for v, i in zip(vectors, ids, strict=True) if i != own)[:5]
            assert [(-s, i) for s, i in zip(scores, best, strict=True)] == wanted


def test_the_search_stops_early():
    """Few components decide: few entries are read, few candidates scored."""
    r = np.random.default_rng(1)
    n, dim = 20_000, 32
    vectors = np.floor(r.normal(0, 1, (n, dim)) * np.geomspace(1000, 1, dim))
    lists, ids = sorted_lists(vectors), np.arange(n)
    reading: dict[str, int] = {}
    for query in vectors[:10]:
        best, scores = threshold_search(vectors, ids, lists, query, -1, 5, reading=reading)
        wanted = np.lexsort((ids, -(vectors @ query)))[:5]
        assert best.tolist() == wanted.tolist() and scores.tolist() == (vectors @ query)[wanted].tolist()
    assert reading["read"] < 10 * n * dim / 20 and reading["scored"] < 10 * n / 2


def test_reading_on_the_sample(spark):
    """What the algorithm reads of real lists: it stops, at a part of each list's depth, and scores no row twice."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    vectors, ids = np.floor(256 * np.array([r.embedding for r in rows], float)), np.array([r.vec_id for r in rows])
    lists, reading = sorted_lists(vectors), {}
    for query, own in zip(vectors[::50], ids[::50], strict=True):
        best, _ = threshold_search(vectors, ids, lists, query, own, 5, reading=reading)
        other = ids != own
        assert best.tolist() == ids[other][np.lexsort((ids[other], -(vectors[other] @ query)))][:5].tolist()
    asked = len(ids[::50])
    assert reading["read"] < 0.45 * asked * vectors.size and reading["scored"] <= asked * len(ids)


def test_a_floor_from_elsewhere_ends_the_search_at_once():
    r = np.random.default_rng(2)
    vectors = np.floor(r.normal(0, 50, (5000, 8)))
    lists, ids, query = sorted_lists(vectors), np.arange(5000), np.floor(r.normal(0, 50, 8))
    scores = vectors @ query
    reading: dict[str, int] = {}
    best, _ = threshold_search(vectors, ids, lists, query, -1, 5, floor=scores.max() * 4, reading=reading)
    assert not len(best) and not reading
    floor = np.sort(scores)[-3]
    best, got = threshold_search(vectors, ids, lists, query, -1, 5, floor=floor)
    assert best.tolist() == np.lexsort((ids, -scores))[:3].tolist() and (got >= floor).all()


def test_top_k_edges(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, [None, 1.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [9.0, 9.0]), (150, [1.0]), (151, [2.0]), (200, [])]
    table = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<float>, id string, rank int")
    got = sorted(tuple(r) for r in exact_top_k(table, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 4, 5 * 65536), (0, 2, 4, 5 * 65536), (150, 1, 151, 2 * 65536)]
    assert exact_top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    blocks = sorted(tuple(r) for r in exact_top_k(table, F.col("vec_id") % 50 == 0, block=2, query_block=1).collect())
    assert blocks == got


def test_repeated_query_ids_are_queries_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wanted = sorted([(0, 1, 3, 3 * 65536), (0, 2, 1, 65536), (0, 3, 2, 0), (0, 1, 3, 3 * 65536), (0, 2, 2, 2 * 65536), (0, 3, 1, 0)])
    for block in (4096, 1):
        assert sorted(tuple(r) for r in exact_top_k(table, F.col("vec_id") % 50 == 0, block=block).collect()) == wanted


def test_shards_follow_the_definition(spark, small):
    """The same order by a plain sort."""
    import hashlib

    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((hashlib.md5(f"tidemark:{r.doc_id}".encode()).hexdigest(), r.doc_id))
    order = sorted(((k + 0.5) / len(own), f"={source}", key, i) for source, own in by.items() for k, (key, i) in enumerate(sorted(own)))
    n = len(rows)
    wanted = {i: (p * 16 // n, p - -(-(p * 16 // n) * n // 16)) for p, (*_, i) in enumerate(order)}
    got = queries()["op4_stratified_sharding"](spark, small).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == wanted
    texts = {r.doc_id: r.text.encode() for r in rows}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.size == len(texts[r.doc_id]) + 1 and r.law == "rows" and r.grown_shard is None for r in got)


def test_every_shard_has_the_mixture(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text", "case when id % 3 = 0 then 'big' when id % 50 = 1 then null else concat('s', id % 7) end as source")
    rows = stratified_shards(docs, rows_a_bucket=50).collect()
    whole, shards = Counter(r.source for r in rows), defaultdict(Counter)
    slots = defaultdict(set)
    for r in rows:
        shards[r.shard][r.source] += 1
        slots[r.shard].add(r.slot)
    sizes = {s: sum(c.values()) for s, c in shards.items()}
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(slots[s] == set(range(n)) for s, n in sizes.items())
    assert all(abs(shards[s][k] - n / 16) <= 1.5 for s in shards for k, n in whole.items())


def test_shard_edges(spark, crowded, no_rows):
    rows = stratified_shards(crowded).collect()
    assert len(rows) == crowded.count() and len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert {r.doc_id: r.size for r in rows if r.doc_id in (3, 4)} == {3: 1, 4: 1}
    assert stratified_shards(no_rows).count() == 0


def test_rows_of_one_id_and_tied_places_are_split(spark):
    """Every bucket and cell is far too full: still each row has its own place, and counts are at most one apart."""
    one = spark.range(3000).selectExpr("7L as doc_id", "cast(id % 3 as string) as text", "'s' as source")
    alone = spark.range(3000).selectExpr("id as doc_id", "'t' as text", "cast(id as string) as source")
    none = spark.range(3000).selectExpr("cast(null as long) as doc_id", "'t' as text", "cast(null as string) as source")
    for table in (one, alone, none):
        rows = stratified_shards(table, rows_a_bucket=20).collect()
        assert sorted(r.position for r in rows) == list(range(3000))
        shards = Counter(r.shard for r in rows)
        assert len(shards) == 16 and max(shards.values()) - min(shards.values()) <= 1
        assert len({(r.shard, r.slot) for r in rows}) == 3000 and max(r.slot for r in rows) == max(shards.values()) - 1


@pytest.mark.parametrize("name", ["op4_stratified_sharding"])
def test_no_python_on_the_executors(spark, small, name):
    plan = queries()[name](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pages_of_the_sample(spark, small):
    """Its pages have one article element: what is in it, block by block."""
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        inside = re.search("<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = re.split("</?(?:p|h1)>", re.sub("<br>|</?b>", "", inside))
        assert main_text(r.html) == "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)


LONG = "This is a paragraph of some length, with commas, and a full stop. " * 4


@pytest.mark.parametrize(
    ("page", "wanted"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain", "plain"),
        ("<p>one<p>two", "one\ntwo"),
        ("<p>a&amp;b &lt;c&gt; &#233;&nbsp;x\n y</p>", "a&b <c> é x y"),
        ("<body><nav><a>m</a></nav><script>var x='<p>no</p>'</script><article><h1>T</h1><p>A<b>b</b>c</p></article><footer>f</footer>", "T\nAbc"),
        ('<div id="header">S</div><div class="cookie-notice">ok?</div><div class="sidebar">s</div><div id="content"><h1>T</h1><div class="body"><p>Hello<p>you <i>there</i></div></div><div id="comments"><p>first!</p></div>', "T\nHello\nyou there"),
        ("<article><p>x<section class=comments><article class=comment><p>long comment here</article></section></article>", "x"),
        ("<main><header><h1>T</h1></header><p>x</p><form><input value=1>Sign up</form></main>", "T\nx"),
        (f"<div><a>1</a><a>2</a><a>3</a><a>4</a></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG.strip()}\n{LONG.strip()}"),
        ("<ul><li>a<li>b</ul>", "a\nb"),
        ("<article>" + "<div>" * 5000 + "deep", "deep"),
        ("<article><p>a<!-- c --><![CDATA[x]]></p><p hidden>h</p><p style='display: none'>h</p></article>", "a"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ],
)
def test_main_text(page, wanted):
    assert main_text(page) == wanted


def test_page_rows(spark):
    table = spark.createDataFrame([(1, "u", "<p>é</p>", "t"), (1, None, None, "t"), (None, "v", "", "t")], "page_id long, url string, html string, text string")
    assert sorted(map(str, (tuple(r) for r in extract_pages(table).collect()))) == sorted(map(str, [(1, "u", "é", 1), (1, None, "", 0), (None, "v", "", 0)]))
    assert extract_pages(table.limit(0)).count() == 0


def test_random_markup_never_fails():
    r = random.Random(6)
    atoms = ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "<", ">", "&", "&amp;", "&#x;", "<!--", "-->", "<script>", "</script>", "text ", "<td>", "<table>", "<br/>", "<svg/>", '<a href="', '">', "\n", "<form>", "</form>", "</body>"]
    for _ in range(3000):
        assert isinstance(main_text("".join(r.choice(atoms) for _ in range(r.randint(0, 40)))), str)


def test_blocks_beside_the_densest_one_stay():
    page = f"<body><div id=page><h1>T</h1><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></div><div><a>x</a></div></body>"
    assert main_text(page).split("\n") == ["T", *[LONG.strip()] * 5]


def test_lists_of_links_in_an_article_stay():
    page = f"<article><p>{LONG}</p><p>{LONG}</p><ul><li><a>source one</a><li><a>source two</a><li><a>source three</a></ul></article>"
    assert main_text(page).split("\n")[2:] == ["source one", "source two", "source three"]


@pytest.mark.parametrize(
    "page",
    [
        "<body><form action=x><div>menu</div>{}</form></body>",
        "<body><form action=x><nav><a>m</a></nav><article>{}</article></form></body>",
        '<body><div class="sidebar-right">{}</div><div class="sidebar">about us</div></body>',
        '<body><div class="post share">{}</div><div class="share">tweet</div></body>',
        '<body><div id="search-result-article">{}</div><div id="search">find</div></body>',
        '<body class="no-js"><div class="page has-banner"><div class="banner">Sale</div><div class="comments-open">{}</div></div></body>',
        "<body><div role=search><input>find</div><div role=form>{}</div></body>",
    ],
)
def test_a_name_never_outweighs_the_text(page):
    text = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
    wanted = f"T\n{LONG.strip()}\n{LONG.strip()}"
    got = main_text(page.format(text)).split("\n")
    assert [x for x in got if x not in ("menu",)] == wanted.split("\n")


def test_long_threads_of_comments_go():
    page = f"<body><div class=page><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div id=comments>" + f"<div class=comment><p>{LONG}!</p></div>" * 6 + "</div></body>"
    assert main_text(page) == f"T\n{LONG.strip()}\n{LONG.strip()}"


def test_several_teasers_are_no_article():
    page = "<body><div>" + f"<p>{LONG}</p>" * 4 + "</div><div>" + "<article><a>more</a> short</article>" * 3 + "</div></body>"
    assert main_text(page).split("\n")[:4] == [LONG.strip()] * 4


def test_densities_equal_brute_force():
    """Composite text density by its definition, counted anew for each node of random trees."""
    import math

    from tidemark.llm.html_text import _densities, _Tree

    r = random.Random(9)

    def grow(depth):
        kids = [grow(depth + 1) if r.random() < 0.6 and depth < 6 else "w" * r.randint(0, 30) for _ in range(r.randint(0, 4))]
        return (r.choice(["div", "section", "span", "a", "em"]), kids)

    def markup(node):
        return node if isinstance(node, str) else f"<{node[0]}>" + "".join(map(markup, node[1])) + f"</{node[0]}>"

    def counted(node, linked):
        """characters, tags, linked characters, links below a node"""
        c = t = lc = lt = 0
        for kid in node[1]:
            if isinstance(kid, str):
                c, lc = c + len(kid), lc + len(kid) * linked
            else:
                kc, kt, klc, klt = counted(kid, linked or kid[0] == "a")
                c, t, lc, lt = c + kc, t + kt + 1, lc + klc, lt + klt + (kid[0] == "a")
        return c, t, lc, lt

    def density(node, linked, share):
        c, t, lc, lt = counted(node, linked)
        if not c:
            return 0.0
        t1, lc1, lt1 = max(t, 1), max(lc, 1), max(lt, 1)
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / t1 * math.log(max(c / lc1 * t1 / lt1, 1)) / math.log(max(base, math.e))

    checked = 0
    for _ in range(300):
        root = ("div", [grow(0) for _ in range(3)])
        c, _, lc, _ = counted(root, False)
        share = lc / c if c else 0
        wanted, sums = [], []

        def walk(node, linked):
            linked = linked or node[0] == "a"
            wanted.append(density(node, linked, share))
            sums.append(sum(density(k, linked or k[0] == "a", share) for k in node[1] if not isinstance(k, str)))
            for kid in node[1]:
                if not isinstance(kid, str):
                    walk(kid, linked)

        walk(root, False)
        tree = _Tree(markup(root))
        got, got_sums, *_ = _densities(tree, [False] * len(tree.tag))
        assert got[1:] == pytest.approx(wanted) and got_sums[1:] == pytest.approx(sums)
        checked += len(wanted)
    assert checked > 3000


def test_hostile_markup_takes_linear_time():
    import time

    began = time.perf_counter()
    for atom in ['<a href="', "<!--", "<![CDATA[", "<script>", "<a ", "<", "</", "<!", "&#", "<p ", "<td>", "='", "<p>", '<div class="a b">', "<title>"]:
        for end in ("", '">', "x"):
            main_text(atom * 100_000 + end)
    assert time.perf_counter() - began < 90


def test_ends_that_are_missing():
    assert main_text("<p>a</p><a href='x") == "a"
    assert main_text('<p title="a > b">c</p>') == "c"
    assert main_text("<p>a < b and c<d</p>") == "a < b and c"
    assert main_text("<!-- x --><p>a</p><!-->b<!--->c--!>d") == "a\nbc--!>d"
    assert main_text("<script>if (a < b) '</p>'</SCRIPT><p>x</p><script>y") == "x"


def test_page_columns_with_clashing_names(spark):
    table = spark.createDataFrame([(1, "u", "<p>x</p>", 1, "a"), (1, "u", "<p>x</p>", 1, "a")], "page_id long, url string, html string, id int, n_chars string")
    assert [tuple(x) for x in extract_pages(table).collect()] == [(1, "u", "x", 1)] * 2
