import time
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradientlab.llm import REGISTRY, chat, html_text
from gradientlab.llm.common import prepare, table
from gradientlab.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<", ">>")
PARTS = [*CONTROL, "<", "[", ">", "\\", "s>", "/s>", "INST]", "/INST]", "a", " ", "\n", "é", "/"]
content = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@settings(max_examples=500, deadline=None)
@given(content)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in CONTROL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", ">>", "</s>", "a << b"]), content), max_size=5))
def test_conversations_parse_to_their_turns(turns):
    formatted = "".join(chat.render(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(formatted)] == turns


def test_escaped_only_where_needed():
    assert chat.render("user", "1 < 2 [sic] \\ >")[0] == "<s>[INST] 1 < 2 [sic] \\ > [/INST]</s>"
    assert chat.render("assistant", "ok </s>")[0] == "<s> ok <\\/s> </s>"


@pytest.mark.parametrize("broken", ["x", "<s>", "<s> a", "<s>[INST] a</s>", "<s>a </s>", "<s><< r</s>", "<s><< user >> a </s>", "<s> </s>"])
def test_parser_refuses_what_the_grammar_lacks(broken):
    with pytest.raises(ValueError):
        chat.parse(broken)


def summary(rows):
    """By conversation, from (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).hexdigest(), x or "") for c, t, r, x in rows if c == conv))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, _, x in turns)
        learnt = "".join(x for _, _, r, _, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def test_query_op5(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = REGISTRY["op5_chat"](spark, FOLDER).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == summary(rows)
    assert len(got) == len(summary(rows)) and all(r.formatted_chars > r.loss_chars for r in got)


def test_chat_with_odd_rows(spark):
    prepare(spark)
    rng = random.Random(1)
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (None, 0, "user", "no id"), (2, None, None, "no turn, no role"),
            (3, 5, "assistant", "tie"), (3, 5, "assistant", "tie"), (3, 5, "assistant", "another"), (4, 0, "assistant", "<s>" * 100_000)]
    rows += [(5, k, rng.choice(["user", "assistant", "tool\nuse"]), "".join(rng.choices(PARTS, k=6))) for k in range(700)]  # over a batch
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    folder = scratch_path(spark, "test_chat")
    chat.write_formatted(df, folder)
    got = chat.read_back(spark.read.parquet(folder)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == summary(rows)
    folder = scratch_path(spark, "test_chat")
    chat.write_formatted(df.limit(0), folder)
    assert chat.read_back(spark.read.parquet(folder)).count() == 0


LONG = "the river and the town of the valley were known to all who came from the north in that year, as it is told in the old books. "


def page(*parts):
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(parts) + "</body></html>"


def test_article_without_its_surroundings():
    got = html_text.main_text(page(
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use cookies, and that is all of it.</div>",
        "<article><h1>A title &amp; more</h1><p>" + LONG + "</p><p>Short.</p><div class='ad'>" + LONG + "</div><p>one&nbsp;two<br>three\n four</p>",
        "<script>var a = '<p>no</p>';</script><form><p>" + LONG + "</p></form><section id='comments'><p>" + LONG + "</p></section></article>",
        "<aside><p>" + LONG + "</p></aside><footer>" + LONG + "</footer>",
    ))
    assert got == "A title & more\n" + LONG.strip() + "\nShort.\none two three four"


def test_page_without_article_uses_the_two_passes():
    got = html_text.main_text(page(
        "<div>Menu</div><div><a href='a'>One</a> <a href='b'>Two</a></div>", f"<p>{LONG * 2}</p><p>Yes.</p><p>{LONG * 2}</p>",
        "<div><a href='x'>" + LONG + "</a></div><p>All rights kept</p>",
    ))
    assert got == f"{(LONG * 2).strip()}\nYes.\n{(LONG * 2).strip()}"


@pytest.mark.parametrize("before,after", [
    ("<div class='layout has-sidebar'>", "</div>"), ("<div id='page-with-nav'>", "</div>"), ("<div class='no-comments'>", "</div>"),
    ("<form action='/' id='aspnetForm'><div>", "</div></form>"), ("<div class='widget'><div>", "</div></div>"),
    ("<section class=sidebar>", "</section>"), ("<main><div class='promo'>", "</div></main>"),
])
@pytest.mark.parametrize("article", ["article", "main"])
def test_an_article_in_a_marked_wrapper(before, after, article):
    inner = f"<p>{LONG}</p><div class='legal-analysis'>Of the law.</div><p class='related-work'>Of others.</p><div class='ad-slot'>{LONG}</div>"
    got = html_text.main_text(page(f"{before}<{article}>{inner}</{article}>{after}<div class='site-footer'>{LONG}</div>"))
    assert got == LONG.strip() + "\nOf the law.\nOf others."


def test_articles_of_others_and_unwanted_parents():
    for before, after in [("<div id='comments'>", "</div>"), ("<div class='related-posts'>", "</div>"), ("<aside>", "</aside>"),
                          ("<div class='promo' hidden>", "</div>"), ("<div class='promo'><span hidden>", "</span></div>"), ("<ol class='comment-list'><li>", "</ol>")]:
        assert html_text.main_text(page(f"<article>x</article>{before}<article><p>{LONG}</p></article>{after}")) == "x"


def test_wrappers_of_a_page_without_article():
    assert html_text.main_text(page(f"<div class='has-sidebar'><div class='content no-comments'><p>{LONG}</p></div><div class='sidebar-left'>{LONG}</div></div>")) == LONG.strip()


@pytest.mark.parametrize("article", ["article", "main"])
def test_links_in_an_article(article):
    lines = ["<h1><a href=/t>A linked title</a></h1>", f"<p>{LONG}</p>", "<p>See <a href=x>the report</a> for all figures.</p>",
             "<ul><li><a href=a>Linked item</a></li><li><a href=b>Another</a> one</li></ul>", f"<p>{LONG}</p>",
             "<h2>References</h2><ol><li>Miller, J. 1999. <a href=c>Alpine plants along gradients, volume 3, pages 117-154, Basel</a></li></ol>"]
    outside = "<div><a href=/>Home</a> of all</div>" + f"<div><a href=y>{LONG}</a></div>"
    got = html_text.main_text(page(outside, f"<{article}>", *lines, f"</{article}>", outside)).split("\n")
    assert got == ["A linked title", LONG.strip(), "See the report for all figures.", "Linked item", "Another one", LONG.strip(), "References",
                   "Miller, J. 1999. Alpine plants along gradients, volume 3, pages 117-154, Basel"]


@pytest.mark.parametrize("prose", [
    "Rzeka płynęła powoli przez dolinę, a mieszkańcy miasteczka pamiętali jeszcze dawne opowieści swoich dziadków o wielkiej powodzi.",
    "Joki virtasi hitaasti laakson halki, ja kaupungin asukkaat muistivat yhä isovanhempiensa vanhat kertomukset suuresta tulvasta.",
    "Река медленно текла через долину, и жители города ещё помнили старые рассказы своих дедов о большом наводнении.",
])
def test_page_in_another_language_without_article(prose):
    links = "<ul><li><a href=a>Home</a></li><li><a href=b>" + prose + "</a></li></ul>"
    assert html_text.main_text(page(links, f"<div><p>{prose}</p><p>123.</p><p>{prose}</p></div>", links)) == f"{prose}\n123.\n{prose}"


def test_long_blocks_without_stop_words_beside_prose():
    listed = "Miller Smith Johnson Brown Davis Wilson Moore Taylor Anderson Thomas Jackson White Harris Martin"
    assert html_text.main_text(page(f"<p>{LONG}</p><div>{listed}</div>")) == LONG.strip()


@pytest.mark.parametrize("text,wanted", [
    (None, ""), ("", ""), ("   ", ""), ("<", ""), ("<article>open <b>bold <p>next &lt;p&gt; &#233; &amp;amp;", "open bold\nnext <p> é &amp;"),
    ("<article><p>a<p>b</article></div></p>", "a\nb"), ("<article><p>a <!-- no --> b <unfinished", "a b"),
    ("<ARTICLE><H2>Big</H2><P>x  y\t\nz</P></ARTICLE>", "Big\nx y z"), ("<article><p>a<script>x</article>", "a"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></article>", "one\ntwo\nc\nd"),
    ("<head><title>x</title><article><p>head left open</p></article>", "head left open"),
])
def test_broken_markup(text, wanted):
    assert html_text.main_text(text) == wanted


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "p", "/", "<p>", "</p>", "<article>", "</article>", "<div class='ad'>", "</div>", "<!--", "-->", "&", "&amp;",
                                 "<script>", "</script>", " ", "x", "'", '"', "<li>", "<td>", "<b>", "<a href=x>", "</a>", "<![CDATA[", "]]>"]), max_size=25).map("".join))
def test_any_markup_is_read(text):
    got = html_text.main_text(text)
    assert got == "\n".join(" ".join(line.split()) for line in got.split("\n")) and (not got or "" not in got.split("\n"))


def test_very_long_pages_take_linear_time():
    many = "<article>" + f"<p>{LONG}</p>" * 20_000
    assert html_text.main_text(many).count("\n") == 19_999
    assert html_text.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == ""
    assert html_text.main_text("<article>" + "<" * 50_000 + " x").endswith("x")
    assert html_text.main_text("<article>kept" + "<" * 50_000 + "x").startswith("kept")  # the unfinished tag <x ends the page


@pytest.mark.parametrize("page", [
    "<a " * 100_000 + '"', "<a b='" * 100_000, '<a b="' * 100_001 + "'", "<div>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000,
    "<li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000, "<table><td>" * 50_000, "<p>a</b>" * 50_000, "<!--" * 50_000, "&amp" * 50_000,
    "<head>" + "<div>" * 50_000 + "</span>" * 50_000, "<a x= " + " " * 100_000 + "'" * 1000 + ">b",
], ids=range(12))
def test_broken_markup_takes_linear_time(page):
    start = time.monotonic()
    html_text.main_text("<article><p>" + page)
    assert time.monotonic() - start < 5


def test_quotes_and_references_of_broken_pages():
    text = lambda inner: html_text.main_text(f"<article>{inner}</article>")
    assert text('<div class="a>two</div>') == "two"
    assert text("<p don't>it's</p>") == "it's"
    assert text('<p title = "a > b">one</p>') == "one"
    assert text("AT&<b>amp;</b>T") == "AT&amp;T"
    assert text("a &lt;b&gt; &amp;lt; <![CDATA[&lt;]]>") == "a <b> &lt; &lt;"


def test_query_op6(spark):
    """Against a reading of the pages by their one template."""
    import html
    import re

    pages = {r.page_id: r.html for r in table(spark, FOLDER, "pages").collect()}
    got = REGISTRY["op6_html_text"](spark, FOLDER).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id] or "", re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner[1] if inner else "")]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_html_frame_with_odd_rows(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, None, "a"), (None, "<article>x", "b"), (2, "<article>x", None), (2, "<article>x", None)], "page_id bigint, html string, TEXT string")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [("1", "", 0), ("2", "x", 1), ("2", "x", 1), ("None", "x", 1)]
    assert html_text.extract(df.limit(0)).count() == 0
