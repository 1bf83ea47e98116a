"""Main texts: known articles come back exactly out of pages of many builds."""

import html as markup
import random
import re

import pytest

from shelfmark.llm.main_text import main_text, main_text_of
from shelfmark.llm.queries import QUERIES

WORDS = "river stone, light harbour cloud. letter, garden & window <old> “paper” été straße".split(" ")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def spaced(rng, text):
    """The same words with other white space and references."""
    gap = lambda: rng.choice([" ", "\n", " \t", "&nbsp;", "<br>", "&#32;"])
    return "".join(w + gap() for w in markup.escape(text).split(" ")).removesuffix("<br>")


MENU = "<ul><li><a href='/a'>Home</a><li><a href='/b'>News</a><li><a href='/c'>About, us</a></ul>"
ASIDES = [
    f"<nav>{MENU}</nav>", f"<div class='main-menu'>{MENU}</div>", MENU, "<header><h2>The Site</h2><p>A slogan, of sorts.</p></header>",
    "<footer><p>&copy; all, rights, reserved</p></footer>", "<aside><p>Other, things, to, read, here.</p></aside>",
    "<div id='sidebar'><p>Some long, long, long text, about, nothing, at all.</p></div>",
    "<div class='cookie-notice'><p>We use cookies, and more, and you agree.</p></div>",
    "<section role='complementary'><p>Weather, sun, rain.</p></section>", "<div hidden><p>Not seen, ever.</p></div>",
    "<div class='ad'>Buy this, now.</div>", "<form><p>Your name, please</p><input><button>Send</button></form>",
    "<script>var t = '<p>a, b</p>';</script>", "<style>p > b { color: red }</style>", "<!-- <p>no, no</p> -->",
    "<section id='comments'><article class='comment'><p>Great, really, great, I, liked, it, a, lot.</p></article></section>",
    "<noscript><p>Switch, on, scripts.</p></noscript>", "<div style='display: none'>gone</div>",
]
SHELLS = [
    "<body>{0}<article>{1}</article>{2}</body>", "<body class='has-sidebar'>{0}<main><article>{1}</article>{2}</main></body>",
    "<BODY>{0}<div class='wrap'><div class='entry-content'>{1}</div>{2}</div>", "{0}<main role=main>{1}</main>{2}",
    "<body>{0}<table><tr><td>{1}</td><td>{2}</td></tr></table>", "<div><div>{0}</div><div id=content title='see hidden gem'>{1}</div>{2}</div>",
]


@pytest.mark.parametrize("seed", range(60))
def test_articles_come_back(seed):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(20, 80)) for _ in range(rng.randrange(3, 9))]
    title, items = prose(rng, 5), [prose(rng, 6) for _ in range(3)]
    texts[1:1] = items
    close = rng.choice(["</p>", ""])
    inner = f"<h1>{spaced(rng, title)}</h1>"
    for i, t in enumerate(texts):
        part = spaced(rng, t)
        if t in items:
            inner += ("<ul>" if t == items[0] else "") + f"<li>{part}" + ("</ul>" if t == items[-1] else "")
            continue
        if rng.random() < 0.4:
            part = f"<b>{part}</b>"
        inner += f"<p class='x'>{part}{close}"
        if rng.random() < 0.3:
            inner += rng.choice([a for a in ASIDES if "<header" not in a and "<p>" not in a or "<div class='cook" in a])
    some = lambda: "".join(rng.sample(ASIDES, rng.randrange(6)))
    page = "<!DOCTYPE html><head><title>Site, of, sites</title></head>" + rng.choice(SHELLS).format(some(), inner, some())
    assert main_text_of(page) == "\n".join(" ".join(t.split()) for t in [title, *texts])


def plain_article(page):
    """The given tables have one article element a page."""
    body = re.sub(r"<[^>]*$", "", page.partition("<article>")[2].partition("</article>")[0].partition("<footer>")[0])
    pieces = (re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(t for p in pieces if (t := " ".join(markup.unescape(p).split())))


def test_query_over_all_pages(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op13_main_text"](spark, folder).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain_article(pages[r.page_id].html or ""), len(r.text))


ODD = {
    None: "", "": "", " \n ": "", "<": "<", "a < b": "a < b", "plain": "plain", "<p>": "", "<!--": "", "<p>x</p": "x", "</div></p>": "",
    "<a <a": "", "<p>a<p>b": "a\nb", "<b><p>a</b><p>b": "a\nb", "&am &amp &#xD800;": "&am & �", "<h1>only</h1>": "only",
    "<article><header><h1>T</h1><span>by me</span></header><p>x</p></article>": "T\nx", "<td>a</td>": "a", "<SCRIPT>x</script >y": "y",
    "<script>x": "", "<p>a<!-- x --->b": "ab", "<div>a<div>b</div>c</div>": "a\nb\nc", "<p>1<b>2</b>3 <i>4</i>": "123 4",
}


@pytest.mark.parametrize("page", ODD, ids=repr)
def test_odd_pages(page):
    assert main_text_of(page) == ODD[page]


@pytest.mark.parametrize("page", ["<b>" * 50_000 + "x", "<div>" * 50_000 + "x", "<p><b>" * 30_000 + "x", "<a '>" * 30_000, "<ul><li>" * 20_000 + "x",
                                  "<" * 100_000, "<!-" * 50_000, "&" * 100_000])
def test_long_pages_take_linear_time(page):
    assert len(main_text_of(page)) <= len(page)


def test_rows(spark):
    rows = [(1, "u", "<p>a, b</p>", "t", 5), (1, "u", "<p>a, b</p>", "t", 5), (None, None, None, None, None),
            (2, "v", "<article>" + "<p>word, word</p>" * 20_000 + "</article>", "t", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, c0 long")
    got = main_text(pages).collect()
    assert main_text(pages).columns == ["page_id", "url", "html", "c0", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text[:5], r.n_chars, r.c0) for r in got if r.page_id != 2) == [(0, "", 0, None), (1, "a, b", 4, 5), (1, "a, b", 4, 5)]
    assert [r.n_chars for r in got if r.page_id == 2] == [20_000 * 11 - 1]
    assert main_text(pages.limit(0)).count() == 0
