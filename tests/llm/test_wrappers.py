import html
import re

from pyspark.sql import functions as F

from pairloom.llm import wrappers
from pairloom.llm.queries import page_texts

DATA = "/root/testdata/sf0.001"


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def expected_article(source):
    """The pages' generator has one article of h1 and p blocks; cut it by pattern."""
    article = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
    blocks = re.split(r"</?(?:p|h1)>", article[1] if article else "")
    lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(filter(None, lines))


def test_registered_query_equals_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = page_texts(spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == expected_article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_alignment_makes_slots_options_and_repeats():
    one = page("<ul><li>a</li><li>b</li></ul><p>x</p>")
    two = page("<p>y</p><div>z</div>")
    wrapper = wrappers.infer([one, two])
    assert wrappers.expression(wrapper).endswith("<body>(<ul>(<li>#)+)?<p>#(<div>z)?")
    # The order of the pages does not matter here, nor does seeing one twice.
    assert wrappers.expression(wrappers.infer([two, one, one])) == wrappers.expression(wrapper)


def test_parts_that_are_left_out():
    source = page(
        "<header>h</header><nav>n</nav><div class='cookie-notice'>c</div><article><header>inner</header>"
        "<h1>T&amp;x&nbsp;y</h1><p>one<br>two</p><div class=ad>ad</div><aside>s</aside><form>f</form>"
        "<ul><li>i<li>j</ul><p>a<b>b</b>c<script>no('</p>')</script></p><!-- <p>gone</p> -->"
        "<section id=comments><p>me too</p></section></article><footer>f</footer>")
    part = wrappers.main_part(wrappers.infer([source]))
    assert wrappers.extract(source, part) == "T&x y\none two\ni\nj\nabc"


def test_pages_without_article_use_the_group_that_holds_the_text():
    pages = [page(
        f"<div id=top><a href=/>home</a> <a href=/b>b</a></div><div id=wrap><p>Fixed words.</p>"
        f"<p>{'text ' * (20 + i)}</p><p>more {i}</p></div><div id=low>(c)</div>") for i in range(8)]
    part = wrappers.main_part(wrappers.infer(pages))
    assert wrappers.extract(pages[3], part).split("\n")[-1] == "more 3"
    assert "home" not in wrappers.extract(pages[3], part)


def test_broken_and_odd_pages(spark):
    long = "<p>" + "word " * 50_000
    odd = ["", None, "plain & text", "<p>a<p>b", "<p>x</p", "<p>1 < 2 &lt; 3</p>", "<!-- never closed <p>a",
           "<script>x", "<p title='a>b'>q</p>", "<a " * 2000, "<" * 2000, "<div>" * 3000 + "deep", long,
           "<p>&#x41;&amp;amp;&bogus;&eacute</p>", "<table><tr><td>a<td>b<tr><td>c</table>", "</p></div>x"]
    rows = [(i, "http://h.org/", h, "clash") for i, h in enumerate(odd)] + [(None, None, "<p>z</p>", None), (3, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r.text for r in wrappers.main_texts(pages).collect() if r.url is not None}
    assert found[0] == found[1] == found[6] == found[7] == ""
    assert (found[2], found[3], found[5], found[8]) == ("plain & text", "a\nb", "1 < 2 < 3", "q")
    assert found[12] == "word " * 49_999 + "word"
    assert (found[13], found[14], found[15]) == ("A&amp;&bogus;é", "a\nb\nc", "x")
    assert found[11] == "deep"
    assert wrappers.main_texts(pages).count() == len(rows)
    assert wrappers.main_texts(pages.filter("page_id < 0")).count() == 0


def test_texts_do_not_depend_on_partitions(spark, monkeypatch):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    first = {(r.page_id, r.text) for r in wrappers.main_texts(pages).collect()}
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    again = wrappers.main_texts(pages.repartition(5, F.col("page_id"))).collect()
    assert first == {(r.page_id, r.text) for r in again}


def extracted(pages):
    part = wrappers.main_part(wrappers.infer(pages))
    return [wrappers.extract(p, part) for p in pages]


def test_the_wrapper_decides_inside_articles_and_for_every_template():
    tip = "<div class=kb-tip><p>Please give</p><p>to us today</p></div>"
    articles = [page(f"<article><h1>Title {'x' * i}</h1>{tip}<p>{'body ' * (9 + i)}</p><p>end</p></article>")
                for i in range(6)]
    others = [page(f"<div class=top>Known everywhere</div><div class=wrap><h1>Other {'y' * i}</h1><div class=tip>Same words</div>"
                   f"<p>{'more ' * (9 + i)}</p></div><div class=low>(c) us</div>") for i in range(6)]
    found = extracted(articles + others)
    assert found[2] == "Title xx\n" + ("body " * 11).strip() + "\nend"
    assert found[6 + 2] == "Other yy\n" + ("more " * 11).strip()


def test_text_that_met_a_fixed_group_is_kept_where_it_differs():
    pages = [page(f"<article><div>same</div><p>{'body ' * (9 + i)}</p></article>") for i in range(6)]
    part = wrappers.main_part(wrappers.infer(pages))
    assert wrappers.extract(pages[0], part) == ("body " * 9).strip()
    assert wrappers.extract(page("<article><div>other</div></article>"), part) == "other"


def test_names_leave_out_whole_tokens_of_small_groups_only():
    text = "<h1>Title</h1><p>" + "body " * 20 + "</p><div class='cookie-notice'>c</div>"
    expected = "Title\n" + ("body " * 20).strip()
    for source in (
            page(f"<article class='post has-comments'>{text}</article>"), page(f"<article class=comments>{text}</article>"),
            page(f"<div id=header-and-content><article>{text}</article></div>"),
            page(f"<div class='sidebar'><div>{text}</div></div>"), page(f"<form id=search>{text}</form>"),
            page(text).replace("<body>", "<body class='right-sidebar'>"),
            page(text).replace("<body>", "<body class='single comments-open search'>"),
            page(text).replace("<html>", "<html class=search>")):
        assert extracted([source]) == [expected]


def test_copies_do_not_make_a_text_fixed(spark):
    copy = page("<div id=wrap><h1>Title</h1><div>One paragraph only.</div></div>")
    assert extracted([copy] * 9) == ["Title\nOne paragraph only."] * 9
    # Nor do a few pages among many, or copies that differ in a date.
    many = [page(f"<div id=wrap><h1>T{i}</h1><p>{'text ' * (9 + i)}</p></div>") for i in range(20)]
    some = [page(f"<div id=wrap><h1>S{i}</h1><p>{'text ' * (9 + i)}</p><div>quoted</div></div>") for i in range(6)]
    assert extracted(many + some)[-1].endswith("\nquoted")
    dated = [page(f"<div id=wrap><h1>Title</h1><div>{'One paragraph only. ' * 9}</div><i>{i}</i></div>") for i in range(8)]
    assert extracted(dated)[0].startswith("Title\nOne paragraph only.")
    rows = [(i, "http://h.org/", h) for i, h in enumerate([copy] * 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.text for r in wrappers.main_texts(pages).collect()} == {"Title\nOne paragraph only."}


def test_nesting_has_no_limit():
    deep = "<div>" * 250 + "in" + "</div>" * 250
    assert extracted([page(f"<div id=wrap><article>{deep}<p>tail</p></article></div>")]) == ["in\ntail"]
    source = page("<b>" * 300 + "<p>text</p><nav>menu</nav><footer>low</footer>")
    assert extracted([source]) == ["text"]
    # Depth costs time in proportion, also for ends and scopes that match nothing near.
    source = "<p><div>" + "<b>" * 20_000 + "</i>" * 20_000 + "<div>x</div>" * 2_000 + "</li>" * 2_000
    rows = wrappers._rows(wrappers.infer([source, source + "y"]))
    assert wrappers._rows(wrappers._from_rows(rows)) == rows
    assert extracted([source, source + "y"])[1].split("\n")[-1] == "y"


def test_a_wrapper_is_bound_by_its_templates(spark):
    def numbered(i):
        word = "".join(chr(97 + int(c)) for c in str(i))
        rows = "".join(f"<div id=row-{i}-{k} class='row tag-{word}'><span id={word}{'x' * k}>{i}</span></div>" for k in range(4))
        return page(f"<article id=post-{i} class='post slug-{word}'><h1>T{i}</h1><div class=tip>Give</div>"
                    f"<p>{'text ' * (9 + i % 7)}</p>{rows}<t-{word}>z</t-{word}></article>")

    few, many = (len(wrappers._rows(wrappers.infer([numbered(i) for i in range(n)]))) for n in (20, 200))
    assert few == many < 20
    # Lists that never agree fold to a group per key.
    mixed = [page("".join(f"<{t}>{i}</{t}>" for t in (("h2", "p", "h3") * 700)[i : 1500 + i])) for i in range(3)]
    assert len(wrappers._rows(wrappers.infer(mixed))) < 3000
    rows = [(i, "http://h.org/", numbered(i)) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    parts = wrappers.host_parts(pages.select(F.lit("h.org").alias("host"), "html")).collect()
    assert len(parts) == 1 and len(parts[0].part) < 2000
    texts = {r.page_id: r.text for r in wrappers.main_texts(pages).collect()}
    assert texts[7].startswith("T7\ntext text") and "Give" not in texts[7]
