"""Path scores decide what is content, with and without markup that names it."""

import re

import pytest

from tidemark.llm import html_extract

PAGES = "/root/testdata/sf0.01/pages.parquet"
PROSE = "It is a long sentence, with commas, and it goes on. And on, too, for a while; then it ends."


def wanted(markup):
    body = re.search("<article>(.*?)</article>", markup, re.S)[1]
    text = html_extract.html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?(?:p|h1|li|ul)>", " ", re.sub("<!--.*?-->", "", body, flags=re.S))))
    return " ".join(text.split())


def test_pages_whose_content_is_not_named(spark):
    """With article and main renamed to div nothing names the content of a page any more."""
    pages = spark.read.parquet(PAGES).select("html").collect()
    exact = named = 0
    for (markup,) in pages:
        want = wanted(markup)
        named += html_extract.main_text(markup) == want
        exact += html_extract.main_text(re.sub(r"(</?)(article|main)\b", r"\1div", markup)) == want
    assert named == len(pages) and exact >= 0.96 * len(pages)


def test_scores_decide(spark, monkeypatch):
    pages = [r[0] for r in spark.read.parquet(PAGES).select("html").collect()]
    before = [html_extract.main_text(p) for p in pages]
    monkeypatch.setattr(html_extract, "path_scores", lambda nodes, f=html_extract.path_scores: dict.fromkeys(f(nodes), 100.0))
    assert sum(html_extract.main_text(p) != b for p, b in zip(pages, before)) > 0.9 * len(pages)


@pytest.mark.parametrize("before,after,body", [
    ("<article>", "</article>", True), ("<div><div class=story>", "</div></div>", True), ("<div id=main><section>", "</section></div>", True), ("", "", True),
    ("<aside>", "</aside>", False), ("<div class='cookie-notice'>", "</div>", False), ("<section id=comments><ol><li>", "</section>", False), ("<form>", "</form>", False),
])
def test_surroundings(before, after, body):
    """Prose is content or not by where it lies; what lies beside it shares in its score by how near it is."""
    around = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News, sports</a></ul></nav><header>Site, name.</header>"
    page = f"<html><body>{around}<div class=story><h1>A title</h1><p>{PROSE}</p><p>{PROSE}</p><ul><li>one</li><li>two</li></ul></div>{before}<p>{PROSE}</p><p>{PROSE}</p>{after}<footer>&copy; 2024, all rights.</footer></body></html>"
    whole = f"A title {PROSE} {PROSE} one two"
    got = html_extract.main_text(page)
    assert got == (f"{PROSE} {PROSE}" if before == "<article>" else f"{whole} {PROSE} {PROSE}" if body else whole)


def test_nothing_but_surroundings():
    assert html_extract.main_text("<nav><a href=x>Home</a><a href=y>News</a></nav><footer>(c) all rights, reserved.</footer>") == ""
    assert html_extract.main_text("<article>x</article>") == "x"


def test_likeness_by_the_common_way():
    """A path shares in the score of one that it leaves late, and hardly in that of one that it leaves early."""
    same = html_extract.likeness(4, 4, 4)
    assert same == 1.0 and same > html_extract.likeness(3, 4, 4) > html_extract.likeness(3, 5, 4) > html_extract.LEAST_SHARE > html_extract.likeness(2, 3, 4) > html_extract.likeness(2, 6, 4)


def test_many_paths():
    deep = "".join(f"<div class=c{i}><p>{PROSE}</p>" for i in range(400)) + "</div>" * 400
    text = html_extract.main_text(deep)
    assert text.count(PROSE) > 200
