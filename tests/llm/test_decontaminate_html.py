"""Benchmark decontamination and main text extraction."""

import random
import re

import pytest

from martline.llm import decontaminate, html


def plain_overlaps(docs, items, window=13, most=2):
    toks = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, text in set(docs):
        a = toks(text)
        for i, item in items:
            b = toks(item)
            w = min(len(b), window)
            allowed = most if w == window else 0
            for p in range(len(a) - w + 1) if w else ():
                changed = min((sum(x != y for x, y in zip(a[p:p + w], b[q:q + w])) for q in range(len(b) - w + 1)))
                if changed <= allowed:
                    n, lo, hi, least = out.get((d, i), (0, p, p, 99))
                    out[d, i] = (n + 1, min(lo, p), max(hi, p + w - 1), min(least, changed))
    return sorted(((d, i, *v) for (d, i), v in out.items()), key=str)


def planted(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "of", "and", f"w{rnd.randrange(300)}"])
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 5, 12, 13, 14, 30])))) for i in range(14)]
    docs = []
    for d in range(70):
        body = [word() for _ in range(rnd.randrange(5, 60))]
        if rnd.random() < 0.7:
            copy = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(99)}"
            at = rnd.randrange(len(body))
            body[at:at] = copy
        text = " ".join(body)
        docs.append((d, rnd.choice([text, text.upper(), text.replace(" ", " - ")])))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_overlaps_match_brute_force(spark, docs_of, seed):
    docs, items = planted(seed)
    docs += [(70, None), (71, ""), docs[0]]
    items += [(20, None), (21, "..."), (None, "an item without an id that is long enough to be a window of tokens")]
    docs.append((72, "x an item without an id that is long enough to be some window of tokens y"))
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, tokens string")
    got = sorted((tuple(r) for r in decontaminate.contaminated(docs_of(docs), bench).collect()), key=str)
    assert got == plain_overlaps(docs, items)
    kept = {r["doc_id"] for r in decontaminate.keep_clean(docs_of(docs), bench).collect()}
    assert kept == {d for d, _ in docs} - {r[0] for r in got}


@pytest.mark.parametrize("window, substitutions", [(13, 2), (8, 1), (5, 0), (12, 3)])
def test_masks_miss_no_pattern_of_substitutions(window, substitutions):
    from itertools import combinations
    found = decontaminate.masks(window, substitutions)
    assert all(any(not set(m) & set(c) for m in found) for c in combinations(range(window), substitutions))


def test_nothing_to_compare(spark, awkward, no_docs):
    bench = spark.createDataFrame([(1, "twice the same row"), (2, "never to be found")], "item_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.contaminated(awkward, bench).collect()
    assert sorted(r["doc_id"] for r in rows) == [5, 7]
    kept = decontaminate.keep_clean(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3
    assert decontaminate.keep_clean(awkward, empty).count() == awkward.count()
    assert decontaminate.contaminated(awkward, empty).collect() == []
    assert decontaminate.contaminated(no_docs, bench).collect() == []


def test_main_path_runs_no_python(spark, docs_of):
    bench = spark.createDataFrame([(1, "an item of more than thirteen tokens that a document could hold as a passage")],
                                  "item_id long, text string")
    plan = decontaminate.contaminated(docs_of([(1, "x")]), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- pages

ARTICLE = ("The first paragraph of the article is long enough to be judged by itself and it has the words that a text has.",
           "Short one.", "The second long paragraph follows and it is of the same kind as the first one was, with you and the others.")


def page(body, head="<title>Title of the page</title><style>p{a:b}</style>"):
    return f'<!DOCTYPE html><html lang="en"><head>{head}</head><body>{body}</body></html>'


BOILERPLATE = [
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">All of the news that is in the day</a></li></ul></nav>',
    "<header><h2>The site of the town and of the people that live in it, for all who want to know</h2></header>",
    '<div id="cookie-notice"><p>We use cookies and this is the notice of it that you have to read and to agree with now.</p></div>',
    '<aside><p>This is the sidebar of the page and it has the text of the other articles that you may like to read.</p></aside>',
    '<div class="ad-banner"><p>Buy the best of all the things that are to be had in the shop that is on the corner of it.</p></div>',
    '<form><label>Name of the person that is to be told of the news of the day</label><input name="x"><button>Go</button></form>',
    '<script>var x = "<p>the text of a script is not the text of the page and it is not to be read</p>";</script>',
    "<!-- <p>the text of a comment is not the text of the page and it is not to be read by you</p> -->",
    '<section class="comments"><article class="comment"><p>I think that the article is right and that it was good of you to write it for us.</p></article></section>',
    "<footer><p>&copy; the owner of the site and of all the texts that are in it, for all of the time to come</p></footer>",
    '<div style="display: none"><p>This is hidden and it is not to be seen by the ones that read the page of the site.</p></div>',
]


def article(wrap):
    return wrap.format("".join(f"<p>{p}</p>" for p in ARTICLE))


@pytest.mark.parametrize("wrap", ["<article><h1>Head line</h1>{}</article>", "<main><h1>Head line</h1>{}</main>",
                                  '<div class="content"><h1>Head line</h1>{}</div>', "<div><h1>Head line</h1>{}</div>"])
@pytest.mark.parametrize("around", [[], *[[b] for b in BOILERPLATE], BOILERPLATE])
def test_only_the_article_remains(wrap, around):
    body = "".join(around) + article(wrap) + "".join(reversed(around))
    assert html.main_text(page(body)) == "\n\n".join(["Head line", *ARTICLE])


@pytest.mark.parametrize("name", ["layout has-sidebar", "with-ads", "no-comments", "has-header", "hasSidebar", "page-with-sidebar",
                                  "content-sidebar-wrap", "sidebar-left", "masthead-layout"])
@pytest.mark.parametrize("inner", ["<main><article>{}</article></main>", "<main>{}</main>", "<article>{}</article>"])
def test_articles_inside_of_named_wrappers_remain(name, inner):
    comments = '<section class="comments"><article><p>I think that it was good of you to write it for us, as you did.</p></article></section>'
    for tag in ("div", "section"):
        got = html.main_text(page(f'{"".join(BOILERPLATE)}<{tag} class="{name}">' + article(inner) + f"{comments}</{tag}>"))
        assert got == "\n\n".join(ARTICLE)


@pytest.mark.parametrize("around", ["<nav>{}</nav>", "<aside>{}</aside>", "<footer>{}</footer>", "<form>{}</form>", "<header>{}</header>",
                                    '<div hidden class="has-sidebar">{}</div>', '<div class="with-ads" style="display:none">{}</div>',
                                    '<ul class="sidebar">{}</ul>', '<div class="has-sidebar"><aside>{}</aside></div>'])
def test_articles_inside_of_other_boilerplate_go(around):
    assert html.main_text(page(around.format(article("<article>{}</article>")))) == ""


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "<div>{}</div>"])
def test_teasers_and_comments_do_not_replace_the_article(wrap):
    others = "".join(f'<div class="{c}"><article><p>{ARTICLE[0]}</p></article></div>' for c in ("related", "comments", "sidebar"))
    for tail in (others.replace(ARTICLE[0], "This is the one of the others that you may like."), others.replace("<article>", '<article class="comment">')):
        assert html.main_text(page(article(wrap) + tail)) == "\n\n".join(ARTICLE)


@pytest.mark.parametrize("anchor", ['<a id="x"/>', '<a id="x" />', '<a name="x">', '<a name="x"></a>', "<a>", '<a href="/x"/>', '<a href="/x">',
                                    '<a href="/x">here', "<a href=/x/>here"])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
@pytest.mark.parametrize("tail", ["", "<a name='end'></a>", "</a>"])
def test_anchors_and_unclosed_links_drop_no_paragraph(anchor, wrap, tail):
    for lead in (f"<p>{anchor}</p>", f"{ARTICLE[0]} {anchor}".join(["<p>", "</p>"])):
        got = html.main_text(page(wrap.format(lead + "".join(f"<p>{p}</p>" for p in ARTICLE) + tail)))
        assert got.endswith("\n\n".join(ARTICLE))
    got = html.main_text(page(wrap.format("".join(f"<p>{'<a name=x>' if anchor == '<a>' else ''}{p}</p>" for p in ARTICLE))))
    assert got == "\n\n".join(ARTICLE)


def test_links_around_blocks_still_count():
    card = f'<a href="/other"><div><h3>Another one</h3><p>{ARTICLE[0]}</p><p>{ARTICLE[2]}</p></div></a>'
    assert html.main_text(page(f"<div>{card}{card}</div>")) == ""
    assert html.main_text(page(f"<article>{card}<p>{ARTICLE[2]}</p></article>")) == ARTICLE[2]
    assert html.main_text(page(f'<div><p><a href="/x">{ARTICLE[0]}</a></p></div>')) == ""


def test_inside_of_blocks():
    long = "This is the text of a block that is long enough to be judged by itself, with all of the words in it"
    got = html.main_text(page(f"<article><p>{long} &amp; &lt;b&gt; &eacute;&#233;&#x1F600;\n\t two&nbsp;&nbsp;words<br>next <i>li</i>ne</p>"
                              f"<p class='a>b' title=\"x > y\">a < b and {long}<p>no end tag, {long}</article>"))
    assert got == (f"{long} & <b> éé\U0001F600 two words next line\n\na < b and {long}\n\nno end tag, {long}")


def test_blocks_of_few_stop_words_stay_inside_an_article():
    rows = ["LOUD!! WORDS!! ONLY!! " * 10, "x" * 300, "tiny"]
    body = "<article>" + "".join(f"<p>{r}</p>" for r in rows) + "</article>"
    assert html.main_text(page(body)) == "\n\n".join(r.strip() for r in rows)


def test_pages_of_all_kinds_give_a_row(spark):
    long = page("<article>" + "".join(f"<p>{p}</p>" for p in ARTICLE * 3000) + "</article>")
    odd = [(1, "u", None), (2, None, ""), (3, "u", "plain text without any mark-up"), (4, "u", "<"), (5, "u", "<p"),
           (6, "u", "</div></p><script>never closed"), (7, "u", "<div " + "a" * 50_000), (8, "u", page("")), (9, "u", long),
           (9, "u", long), (None, None, None), (10, "u", "<article><p>" + "<b>" * 5000 + "deep</article>")]
    df = spark.createDataFrame([(*r, "x", "x") for r in odd], "page_id long, url string, html string, text string, n_chars string")
    rows = html.extract_pages(df).collect()
    assert len(rows) == len(odd) and all(r["n_chars"] == len(r["text"]) for r in rows)
    got = {r["page_id"]: r["text"] for r in rows}
    assert [got[i] for i in (1, 2, 8, None)] == [""] * 4
    assert got[9] == "\n\n".join(ARTICLE * 3000) and got[10] == "deep"
    assert html.extract_pages(df.limit(0)).collect() == []
