"""Pages whose article lies in a form or in an element with a boilerplate class."""

import time

import pytest

from evidence_spark.llm import extract as E

STORY = "\n".join(f"Paragraph {k} of the story tells what happened on that day." for k in range(6))
BODY = "".join(f"<p>{line}</p>" for line in STORY.split("\n"))


@pytest.mark.parametrize("page", [
    f"<html><body><form id='aspnetForm'><div class='menu'>home news</div><div class='page'>{BODY}</div><div class='sidebar'>more</div></form></body></html>",
    f"<html><body><div class='elementor-widget'>{BODY}</div><p>stray</p></body></html>",
    f"<html><body><div id='reply'><div>{BODY}</div></div><p>stray</p><form>q</form></body></html>",
    f"<html><body><form><div class='elementor-widget'><div class='alert'>{BODY}</div></div></form><div>stray</div></body></html>",
])
def test_articles_in_marked_elements_are_whole(page):
    assert E.text_at(E.page_blocks(page), None).removesuffix("\nstray") == STORY


def test_discussions_longer_than_the_article_go():
    talk = "".join(f"<p>Comment {k}: I think that this was told quite differently.</p>" for k in range(14))
    assert E.text_at(E.page_blocks(f"<html><body><article>{BODY}</article><section id='comments'>{talk}</section></body></html>"), None) == STORY


def test_two_templates_of_a_host_keep_their_articles(spark):
    """Six stories and four essays with a teaser at the path of the stories: all ten articles are whole."""
    essay = "\n".join(f"Thought {k} of the essay, which is long and holds a good many words." for k in range(20))
    story = lambda i: f"<html><body><div class='story'><p>Story {i}.</p>{BODY}</div></body></html>"
    other = lambda i: f"<html><body><div class='story'><p>Read next: one more piece.</p></div><div class='essay'><p>Essay {i}.</p>{''.join(f'<p>{x}</p>' for x in essay.split(chr(10)))}</div></body></html>"
    rows = [(i, f"http://one.org/{i}", story(i) if i < 6 else other(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in E.extract_pages(df).collect()}
    assert got == {i: f"Story {i}.\n{STORY}" if i < 6 else f"Essay {i}.\n{essay}" for i in range(10)}


def test_an_outer_path_is_no_other_template(spark):
    """Pages whose best container lies around or in the winning path keep to that path."""
    page = "<html><body><div class='page'><div class='story'><p>{}</p></div>{}</div></body></html>"
    rows = [(i, f"http://one.org/{i}", page.format(f"Story {i} " * 30, "" if i < 4 else "<p>aside words </p>" * 60)) for i in range(6)]
    got = {r.page_id: r.text for r in E.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: (f"Story {i} " * 30).strip() for i in range(6)}


@pytest.mark.parametrize("page, want", [
    ("<div class='a'>" * 20_000 + "deep", "deep"),
    ("<div>x" * 20_000, None),
    ("text " + "<a " * 70_000, "text"),
    ("text " + '<a "' * 50_000, "text"),
    ("text " + "<a x='" * 30_000, "text"),
    ("<span>" * 20_000 + "<h2>t" * 20_000, None),
    ("<p><table>" + "<span>" * 20_000 + "<h2>t" * 20_000, None),
    ("<form class='ad'>" * 20_000 + "words", "words"),
    ("<b></i>" * 30_000 + "words", "words"),
    ("<!--" * 50_000, ""),
    ("<script" * 30_000, ""),
    ("<p>a <i b='c>d'>e</i> f", "a e f"),
    ("<p>a <i b=\"c>d</i> e", "a d e"),
])
def test_reading_is_linear(page, want):
    start = time.time()
    got = E.text_at(E.page_blocks(page), None)
    assert time.time() - start < 3
    assert want is None and got or got == want
