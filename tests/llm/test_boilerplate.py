from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import boilerplate, queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="ad">Buy</div><div class='cookie-notice x'>We use</div><form><p>Mail <input></p></form>
<article class="post"><header><h1>A&amp;B  head</h1></header><p><b>One
two.<br>three<p>four &lt;x&gt; &#233;<ul><li>i1<li>i2</ul><div class="comments"><p>c1</div>
<aside>side</aside><pre> a
 b</pre><div id=share>s</div></article><footer>&copy; x</footer></body></html>"""


def test_markup_leaves_out_what_is_not_the_article():
    assert boilerplate.own_texts([(1, boilerplate.blocks_of(PAGE))]) == [
        "A&B head\n\nOne two. three\n\nfour <x> é\n\ni1\n\ni2\n\na b"
    ]


@pytest.mark.parametrize(("html", "wanted"), [
    ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\n\nb"), ("a < b <c", "a < b <c"),
    ("<script>x", ""), ("<p title=\"a>b\">x</p>", "x"), ("<p title='>x</p>", "x"), ("<!-- x", ""),
    ("<main><p>a</p></main><p>b", "a"), ("<article><p>a</article><main>b</main>", "a"),
    ("<article>a</article><div>b</div><article>c</article>", "a\n\nc"), ("</p></div>x</b>", "x"),
    ("<div class=ad><div>x</div>y</div>z", "z"), ("<article><p class=ad>x<p>y</article>", "y"),
    ("<ARTICLE><P>a</P></ARTICLE>", "a"), ("<p>a&nbsp; b c</p>", "a b c"), ("<article>", ""),
    ("<article><span class='advert'>x</span>y</article>", "y"), ("<article>a<br/>b<hr>c</article>", "a b\n\nc"),
    ("<article>" + "<div>" * 2000 + "deep" + "</div>" * 2000 + "</article>", "deep"),
])
def test_malformed_and_odd_pages(html, wanted):
    assert boilerplate.own_texts([(1, boilerplate.blocks_of(html))]) == [wanted]


def repeated_by_hand(words, page, run):
    covered = [False] * len(words)
    starts = {}
    for i in range(len(words) - run + 1):
        if page[i] == page[i + run - 1]:
            starts.setdefault(tuple(words[i : i + run]), []).append(i)
    for at in starts.values():
        if len({page[i] for i in at}) > 1:
            for i in at:
                covered[i : i + run] = [True] * run
    return covered


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_covers_what_two_pages_share(seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(1, 4, 400)
    page = np.sort(rng.integers(0, 5, 400)) * 11 - 20
    for run in (1, 2, 4, 8):
        assert boilerplate.repeated_words(words, page, run).tolist() == repeated_by_hand(words.tolist(), page.tolist(), run)
        order, rank = boilerplate.suffix_order(words, run)
        keys = [tuple(words[i : i + run]) for i in order]
        assert keys == sorted(keys) and len(set(rank)) == len(set(keys))


def test_repeated_runs_of_a_host_go_and_the_pages_own_stay(spark):
    menu = "<div>Home</div><div>News</div><div>About us</div><div>Contact</div><div>all the rest of it here</div>"
    rows = [(i, f"http://h.org/{i}", f"{menu}<div>own words of page {i} number {i * 7}</div>") for i in range(5)]
    rows += [(9, "http://other.org/", menu), (10, "http://other.org/2", menu), (11, None, None), (12, "x", "")]
    found = {r.page_id: r for r in boilerplate.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert found[i].text == f"own words of page {i} number {i * 7}" and found[i].n_chars == len(found[i].text)
    # Copies are one page, so nothing of it is repeated.
    assert found[9].text == found[10].text != ""
    assert (found[11].text, found[11].n_chars, found[12].text) == ("", 0, "")


def test_passages_of_articles_stay_though_repeated(spark):
    text = "one passage of ten words that many pages print again"
    rows = [(i, "http://h.org/", f"<article><p>{text}</p><p>{i}</p></article>") for i in range(4)]
    rows += rows
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("TEXT", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("__host", F.lit("x"))
    found = boilerplate.main_texts(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in found.collect()) == sorted(f"{text}\n\n{i}" for i in range(4) for _ in range(2))
    assert boilerplate.main_texts(df.limit(0)).count() == 0


def test_every_page_goes_through_the_suffix_array(spark, monkeypatch):
    """Also pages that name their article, before the markup is asked."""
    notice = "this one notice of ten words stands on every page"
    rows = [(i, "http://h.org/", f"<div>{notice}</div><article><p>{notice}</p><p>{i}</p></article>") for i in range(3)]
    rows += [(3, None, None), (4, "http://h.org/", f"<p>{notice}</p><p>own</p>")]
    seen = []
    runs = boilerplate._runs

    def noted(windows):
        seen.append(sorted(row.id for row in windows.select("id").collect()))
        return runs(windows)

    monkeypatch.setattr(boilerplate, "_runs", noted)
    for some in (rows[:4], rows):
        df = spark.createDataFrame(some, "page_id long, url string, html string")
        found = {r.page_id: r.text for r in boilerplate.main_texts(df).collect()}
        wanted = {0: f"{notice}\n\n0", 1: f"{notice}\n\n1", 2: f"{notice}\n\n2", 3: "", 4: "own"}
        assert found == {row[0]: wanted[row[0]] for row in some}
        assert seen and all(ids == sorted(row[0] for row in some) for ids in seen)
        seen.clear()


def test_a_run_is_found_across_the_windows_of_a_host(spark):
    menu = "<div>Home News About us Contact all the rest of it here</div>"
    rows = [
        (i, "http://h.org/", f"{menu if i in (3, 37) else ''}<div>own {' '.join(f'w{i}x{k}' for k in range(20))}</div>")
        for i in range(40)
    ]
    rows += [(50, "http://h.org/", f"{menu}<article>named</article>"), (51, None, menu), (52, "http://i.org/", menu)]
    rows += [(60, "http://h.org/", "<p>seen</p><p>only in one other article, and there it is kept</p>"),
             (61, "http://h.org/", "<article>seen only in one other article, and there it is kept</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = {}
    for host in {url for _, url, _ in rows}:
        mine = [(i, html) for i, url, html in rows if url == host]
        texts = boilerplate.own_texts([(i, boilerplate.blocks_of(html)) for i, html in mine])
        wanted |= {i: text for (i, _), text in zip(mine, texts, strict=True)}
    assert wanted[3].startswith("own") and wanted[51] == wanted[52] != ""
    for max_words in (1, 60, boilerplate.MAX_WORDS):
        found = boilerplate.main_texts(df, max_words=max_words).collect()
        assert {r.page_id: r.text for r in found} == wanted and len(found) == len(rows)
        assert all(r.n_chars == len(r.text) for r in found)


@pytest.mark.parametrize(("html", "wanted"), [
    ("<article class='post category-social'>a</article>", "a"), ("<article class='post tag-search'>a</article>", "a"),
    ("<article class='search' id=comments role=search>a</article>", "a"),
    ("<div id='content' class='no-sidebar'><article>a</article>b</div>", "a"),
    ("<div class='no-sidebar'>a</div>b", "a\n\nb"), ("<div class='cookie-notice x'>a</div>b", "b"),
    ("<div class='sidebar'><p>x<article>a</article></div>", "a"),
    ("<form action=/>x<div><article>a<form>mail</form></article></div></form>", "a"),
    ("<form class=search><div class=widget><article>a</article></div><div class=ad>x</div></form>", "a"),
    ("<article>a<div class=widget><p>b</p><article>c</article></div><div class=ad>x</div></article>", "a"),
    ("<div class=ad>x<div class=promo>y</div></div><form>z</form><p>a", "a"),
    ("<nav><article>x</article></nav><p>a", "a"), ("<div class=ad><article>", ""),
])
def test_the_only_article_is_not_left_out_for_its_names_or_a_form(html, wanted):
    assert boilerplate.own_texts([(1, boilerplate.blocks_of(html))]) == [wanted]


@pytest.mark.parametrize(("html", "wanted"), [
    ("<article>a</article><section id=comments><article>c</article></section>", "a"),
    ("<section id=comments><article>c</article></section><article>a</article>", "a"),
    ("<article>a<ol class=comments><li><article>c<article>d</article></article></ol>b</article>", "a\n\nb"),
    ("<article>a<article>c</article>b</article>", "a\n\nb"), ("<article><article>a</article></article>", "a"),
    ("<article>a</article><article class='comment even' id=comment-7>c</article><article>b</article>", "a\n\nb"),
    ("<article>a</article><div id=comment-7>c</div><div class=related><article>t</article></div>", "a"),
    ("<div class='cookie notice'><article>n</article></div><article>a</article>", "a"),
    ("<form><article>a</article></form><section id=comments><article>c</article></section>", "a"),
    ("<form><main>a<div class=ad>x</div></main></form><p>b", "a"),
    ("<main>a<section id=comments><article>c</article></section></main>", "a"),
    ("<main><section id=comments><article>c</article></section></main>", "c"),
    ("<div class=sidebar><article>a</article></div><div class=related><article>t</article></div>", "a"),
    ("<article>a<div class=comments>x</div></article><article></article>", "a"),
])
def test_comments_teasers_and_notices_go_though_they_are_articles(html, wanted):
    assert boilerplate.own_texts([(1, boilerplate.blocks_of(html))]) == [wanted]


@pytest.mark.parametrize(("html", "wanted"), [
    ("<article><pre><code><span class='token comment'># keep me</span> x</code></pre></article>", "# keep me x"),
    ("<article>the <span class='social'>social</span> <em class=search>search</em> of it</article>", "the social search of it"),
    ("<article><a id=comments href=/>one</a> two<span class=ad>x</span></article>", "one two"),
    ("<p>a&#" + "9" * 5000 + ";b&#" + "0" * 5000 + "65;", "a�bA"), ("a<!-->b<!--->c<!-- x -->d", "abcd"),
    ("a <b>c</b> <!-- d", "a c"), ("a <!-- b", "a"),
])
def test_words_of_the_article_stay(html, wanted):
    assert boilerplate.own_texts([(1, boilerplate.blocks_of(html))]) == [wanted]


@pytest.mark.parametrize("html", [
    "<a " * 350_000, "<a '" * 250_000, "<a \"" * 250_000 + ">", "<!-- " * 200_000, "<!-- >" * 200_000, "<script>" * 120_000,
    "<b>" * 150_000 + "</i>" * 150_000, "<h1>" * 250_000, "<b>" * 150_000 + "<h1>" * 100_000, "<li><option><b>" * 70_000,
    "<" + "a" * 1_000_000 + "\"<>", "<form><article>" * 70_000, "<div class=ad>" * 70_000 + "x", "&#9" * 300_000, "</p>" * 250_000,
])
def test_a_megabyte_of_broken_tags_takes_seconds(html):
    start = time.process_time()
    boilerplate.blocks_of(html)
    assert time.process_time() - start < 2


def test_the_suffix_array_decides_rows_of_the_query(spark, tmp_path):
    """The pages of the tables with their articles unnamed: each host's pages against one array over all of them."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    hosts, wanted, markup = {}, {}, {}
    for row in pages.collect():
        blocks = boilerplate.blocks_of(row.html)
        markup[row.page_id] = "\n\n".join(block.text for block in blocks)
        hosts.setdefault(row.url.split("://")[1].split("/")[0].lower(), []).append((row.page_id, hash(row.html), blocks))
    for mine in hosts.values():
        texts = boilerplate.own_texts([(content, blocks) for _, content, blocks in mine])
        wanted |= {page: text for (page, _, _), text in zip(mine, texts, strict=True)}
    found = {r.page_id: r.text for r in queries.op9_main_text(spark, str(tmp_path)).collect()}
    assert found == wanted and sum(found[i] != markup[i] for i in found) > 0


@pytest.mark.parametrize(("bits", "n"), [(1, 1), (1, 2), (5, 0), (8, 3), (20, 1000), (31, 50_000), (45, 7)])
def test_packed_numbers_come_back(bits, n):
    rng = np.random.default_rng(bits)
    for numbers in (rng.integers(0, 1 << bits, n), np.full(n, (1 << bits) - 1), np.zeros(n, np.int64)):
        raw = boilerplate.packed(np.sort(numbers), bits)
        assert boilerplate.unpacked(raw).tolist() == sorted(numbers.tolist())
        assert len(raw) <= 9 + 2 + n * (max(0, bits - n.bit_length()) + 3) / 8 + 1


@pytest.mark.parametrize("scale", [1, 1 << 45])
def test_ranks_are_dense_and_stable(scale):
    keys = np.random.default_rng(5).integers(0, 40, 3000) * scale
    order, rank = boilerplate._ranked(keys)
    assert order.tolist() == np.argsort(keys, kind="stable").tolist()
    assert rank.tolist() == np.unique(keys, return_inverse=True)[1].tolist()


def prose_pages(n, words):
    """Pages of one host with words of their own, a menu on all of them and a passage on every seventh."""
    menu = "Home News About us Contact all the rest of it here"
    return [
        (i, f"http://h.org/{i}", f"<div>{menu}</div><div>{' '.join(f'w{i}x{k}' for k in range(words))}</div>"
         + ("<p>one passage of ten words that some pages print again</p>" if i % 7 == 0 else ""))
        for i in range(n)
    ]


def test_runs_go_between_windows_in_few_bytes(spark, monkeypatch):
    """Two to three bytes a run: 40 were told of each, which took 11 times the size of the pages."""
    seen = []
    runs = boilerplate._runs

    def noted(windows):
        found = runs(windows)
        seen.append((found.toArrow().nbytes, windows.select("window").distinct().count()))
        return found

    monkeypatch.setattr(boilerplate, "_runs", noted)
    df = spark.createDataFrame(prose_pages(60, 2000), "page_id long, url string, html string")
    found = {r.page_id: r.text for r in boilerplate.main_texts(df, max_words=30_000).collect()}
    assert found == {i: " ".join(f"w{i}x{k}" for k in range(2000)) for i in range(60)}
    assert all(windows > 2 and size < 4 * 60 * 2000 for size, windows in seen) and seen


def test_the_pages_texts_are_dealt_once(spark, conf):
    """Each round reads the same shuffle, so the disk does not hold the texts again."""
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.createDataFrame(prose_pages(40, 30), "page_id long, url string, html string")
    plan = boilerplate.main_texts(df, max_words=200)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len(dealt) == 3


@pytest.mark.parametrize("spare", [boilerplate.SPARE_BITS, -16])
def test_numbers_that_meet_by_chance_cover_nothing(spark, monkeypatch, spare):
    """With few bits every number is told by several windows; the exact hashes still decide."""
    monkeypatch.setattr(boilerplate, "SPARE_BITS", spare)
    rows = prose_pages(60, 40)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for max_words in (60, 400):
        found = {r.page_id: r.text for r in boilerplate.main_texts(df, max_words=max_words).collect()}
        assert found == {i: " ".join(f"w{i}x{k}" for k in range(40)) for i in range(60)}


def test_small_hosts_share_windows_and_nothing_else(spark):
    menu = "<div>Home News About us Contact all the rest of it here</div>"
    rows = [(i, f"http://h{i // 2}.org/{i}", f"{menu}<div>own text {i}</div>") for i in range(40)]
    rows += [(100 + i, f"http://alone{i}.org/", f"{menu}<div>own text {i}</div>") for i in range(40)]
    rows += [(None, None, f"{menu}<div>x</div>"), (None, None, f"{menu}<div>y</div>"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for max_words in (1, 100, boilerplate.MAX_WORDS):
        found = boilerplate.main_texts(df, max_words=max_words).collect()
        kept = "Home News About us Contact all the rest of it here"
        wanted = [f"own text {i}" for i in range(40)] + [f"{kept}\n\nown text {i}" for i in range(40)] + ["x", "y", ""]
        assert sorted(r.text for r in found) == sorted(wanted)


def test_copies_meet_in_a_window_and_very_many_are_spread(spark, monkeypatch):
    pages = prose_pages(30, 60)
    rows = [(100 * k + i, f"{url}/{k}", html) for k in range(6) for i, url, html in pages]
    rows += [(10_000 + i, f"http://h.org/c{i}", pages[1][2]) for i in range(300)] + [pages[2]] * 40
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen = []
    runs = boilerplate._runs

    def noted(windows):
        seen.extend(windows.groupBy("content", "window").count().collect())
        return runs(windows)

    monkeypatch.setattr(boilerplate, "_runs", noted)
    found = boilerplate.main_texts(df, max_words=8000).collect()
    assert sorted((r.page_id, r.text) for r in found) == sorted(
        (i, " ".join(f"w{html.split('w')[2].split('x')[0]}x{k}" for k in range(60))) for i, _, html in rows
    )
    by_content = {}
    for row in seen:
        by_content.setdefault(row["content"], []).append(row["count"])
    assert max(max(counts) for counts in by_content.values()) < 200
    assert sum(len(counts) == 1 for counts in by_content.values()) >= 28
