import html as entities
import re
import time

import pytest

from pricelane.llm import html_blocks

LONG = "This paragraph has many words so that it looks like the running text of an article does. " * 3


@pytest.fixture(scope="module")
def model(spark):
    return html_blocks.train_tree(spark)


def text_of(spark, model, *pages):
    df = spark.createDataFrame([(k, f"u{k}", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    df = df.selectExpr("*", "'x' as blocks", "'y' as text")
    return [r["text"] for r in html_blocks.main_text(html_blocks.page_blocks(df), model).orderBy("page_id").collect()]


def test_tree_knows_its_table(spark, model):
    found = text_of(spark, model, *("".join(p for p, _ in parts) for parts in html_blocks.LABELLED_PAGES))
    right = 0
    for parts, got in zip(html_blocks.LABELLED_PAGES, found, strict=True):
        main = "".join(p for p, wanted in parts if wanted)
        right += got == "\n".join(b[0] for b in html_blocks.text_blocks(main))
    print("labelled pages told right:", right, "of", len(found))
    assert right >= 0.97 * len(found)


def test_other_layouts(spark, model):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><div id='cookie-banner'>We use cookies</div>"
        "<div role='navigation'><a href='/'>Home</a> <a href='/x'>News</a></div><div class='post-content'><h2>A short head</h2>"
        f"<p>{LONG}&amp; &eacute;&nbsp;x<br>y<p hidden>secret</p><script>var p='</p>'</script><p>{LONG}</div>"
        f"<div class='user-comments'><p>{LONG}</p></div><form><label>Mail</label></form><div class='ad-box'>{LONG}</div><footer>Rights</footer>"
    )
    assert text_of(spark, model, page)[0] == "\n".join(["A short head", LONG + "& é x y", LONG.strip()])


def test_odd_pages(spark, model):
    assert text_of(spark, model, None, "", "<", "<p", "<!-- x", "<script>x") == [""] * 3 + text_of(spark, model, "<p") + ["", ""]
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_blocks.main_text(html_blocks.page_blocks(empty), model).count() == 0


def test_articles_of_the_pages(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in html_blocks.op9_html_blocks(spark, folder).collect()}
    assert got.keys() == pages.keys()
    for key, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:h1|p)>", article))
        assert got[key] == "\n".join(b for b in blocks if b)


TITLE, SHORT = "A heading of the page", "One short line."
BODY = f"<h1>{TITLE}</h1><p>{LONG}</p><p>{SHORT}</p><p>{LONG}</p>"
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
WANTED = "\n".join([TITLE, LONG.strip(), SHORT, LONG.strip()])


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{MENU}<article class='post tags'>{BODY}</article><footer>Rights</footer></body>",
        f"<body class='has-sidebar'>{MENU}<article>{BODY}</article><footer>Rights</footer></body>",
        f"<body><form action='/'>{MENU}<div>{BODY}</div><footer>Rights</footer></form></body>",
        f"<body><form>{MENU}<article>{BODY}</article></form></body>",
        f"<html><head><title>T</title><body>{MENU}<article>{BODY}</article><footer>Rights</footer></body>",
        f"<body>{MENU}<article><header><h1>{TITLE}</h1></header>{BODY.split('</h1>')[1]}</article></body>",
        f"<body><div class='page with-sidebar'>{MENU}<div>{BODY}</div><div class='sidebar'><p>{LONG}</p></div></div></body>",
        f"<body>{MENU}<article>{BODY}</article><section id='comments'><article class='comment'><p>{LONG}</p></article><p>{LONG * 4}</p></section>",
        f"<body><div><a href='/'>Home</a> | <a href='/n'>News</a></div><div>{BODY}</div><div>&copy; 2020 Someone</div></body>",
    ],
)
def test_articles_in_all_layouts(spark, model, page):
    assert text_of(spark, model, page)[0] == WANTED


def test_parts_of_an_article_stay(spark, model):
    links = "<ul><li><a href='/a'>first source of it</a></li><li><a href='/b'>second source</a></li></ul>"
    page = f"<body>{MENU}<article><h1>{TITLE}</h1><p>{LONG}</p>{links}<p>{LONG}x<y or z and <b>so</b> on</p><p>It is <span hidden>SECRET</span>open.</p></article>"
    lines = [TITLE, LONG.strip(), "first source of it", "second source", LONG + "x<y or z and so on", "It is open."]
    assert text_of(spark, model, page)[0] == "\n".join(lines)


def test_neighbours_decide(model):
    weights = dict(zip(html_blocks.FEATURES, model.featureImportances.toArray()))
    assert sum(weights[f] for f in ("words_before", "link_share_before", "words_after", "link_share_after")) > 0.02
    assert sum(weights[f] for f in ("words", "link_share")) > 0.05


def test_held_out_blocks(spark, model, monkeypatch):
    """Other lengths, other joints of the layouts: nearly all blocks are told right."""
    monkeypatch.setattr(html_blocks, "_LONG", (22, 40, 52, 73, 101, 140, 200))
    monkeypatch.setattr(html_blocks, "_SHORT", (1, 2, 3, 5, 7, 8, 11))
    monkeypatch.setattr(html_blocks, "_AFTER", html_blocks._AFTER[3:] + html_blocks._AFTER[:3])
    monkeypatch.setattr(html_blocks, "_AROUND", html_blocks._AROUND[2:] + html_blocks._AROUND[:2])
    monkeypatch.setattr(html_blocks, "LABELLED_PAGES", html_blocks._pages())
    rows = html_blocks.labelled_blocks()
    struct = "struct<" + ",".join(f"{f}:double" for f in html_blocks.FEATURES) + ">"
    df = spark.createDataFrame([(r[:-1], r[-1] > 0.5) for r in rows], f"b {struct}, main boolean")
    right = df.where(html_blocks.tree_column(model, df["b"]) == df["main"]).count()
    print("held-out blocks told right:", right, "of", len(rows))
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize(
    "page",
    ["<a " * 100_000, "<div>" * 30_000 + "</p>" * 30_000, "<a href=\"" * 100_000, "<a ='\"'=\"'" * 50_000, "<svg>" * 100_000, "<" * 200_000, "<p " + " " * 300_000],
)
def test_odd_markup_takes_linear_time(page):
    start = time.perf_counter()
    html_blocks.text_blocks(page)
    assert time.perf_counter() - start < 5


def test_attributes_and_cut_tags():
    texts = lambda page: [b[0] for b in html_blocks.text_blocks(page)]
    assert texts("<p class='md hidden lg'>seen</p><p title='display:none'>too</p><p style='Display : none'>not</p>") == ["seen", "too"]
    assert texts("<p>a <i hidden>b <i>c</i> d</i> e</p><p>f <b aria-hidden=true>g</p><p>h</p>") == ["a e", "f", "h"]
    assert texts("<p>one</p><p>two <a href='x") == ["one", "two"]
    assert texts("<p>1 < 2 and 3 <4, a <b or <p>next") == ["1 < 2 and 3 <4, a <b or", "next"]
    assert texts("<svg>left open<p>kept</p>") == ["left open", "kept"]
