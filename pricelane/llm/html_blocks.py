"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags. Each block knows its words, the share of its
words inside links, both of these for the block before and after it, its kind of tag, the share of the
page's words in the part beside the article (by tag, class, id or role) that holds it, and whether it
stands in an article element. A decision tree, trained with Spark ML on a small labelled table (blocks of
``LABELLED_PAGES``), tells main text from the rest; it is applied as one column expression.

Defined results: a null, empty or tag-free-and-empty page has an empty text; a page of any length is read whole,
in time proportional to its length; unclosed tags end where their container ends; a "<" that opens no tag is
text, and a tag that the end of the page cuts off is none; repeated rows give repeated results; columns other than
the key, ``url`` and ``html`` may have any name. Scripts, styles, comments and hidden elements, inline ones
too, hold no text. ``<br>`` is white space. A part that holds most of the page together with its title or all
its unmarked articles (a form or a marked container around everything) is not beside the article.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import map_slices, table

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.S)
#: A quote counts only behind "=" and only if it is closed; nothing here is tried twice, so time is linear.
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)")
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+")
#: Elements without main text, skipped to their end tag; without one, these hide the rest, as browsers do
_RAW_TO_END = frozenset("script style".split())
_RAW = _RAW_TO_END | frozenset("noscript template svg textarea select iframe object canvas math title".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SIDE_TAGS = frozenset("nav header footer aside form button menu dialog fieldset".split())
_ARTICLE_TAGS = frozenset("article main".split())
_PLAIN_TAGS = frozenset("html body section div ul ol li table tr td p".split())
#: Words in a class, id or role that speak for a part beside the article: one feature, see ``side_share``.
_SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie "
    "cookies consent copyright disqus dialog footer form gdpr header login masthead menu nav navbar navigation newsletter notice notices alert "
    "pagination pager popup promo promotion related search share sharing sidebar signup social sponsor sponsored subscribe tags "
    "toolbar topbar widget replies responses respond".split()
)
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_KINDS = {**dict.fromkeys(_HEADINGS, 1), "li": 2, "td": 3, "th": 3, "p": 4, "blockquote": 4, "pre": 4}

FEATURES = (
    "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after", "kind", "side_share", "in_article",
)
BLOCK = "struct<text:string," + ",".join(f"{f}:float" for f in FEATURES) + ">"


def _attributes(text: str) -> dict[str, str]:
    """Names and values of a tag's attributes; the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), double or single or bare)
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    style = "".join(attributes.get("style", "").lower().split())
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )


def _side_words(attributes: dict[str, str]) -> bool:
    said = " ".join(attributes.get(name, "") for name in ("class", "id", "role"))
    return not _SIDE_WORDS.isdisjoint(re.split(r"[^a-z]+", said.lower()))


class _Part:
    """The page, or a part of it that may lie beside the article: its words and what it holds."""

    __slots__ = ("above", "words", "articles", "title", "counts")

    def __init__(self, above: _Part | None):
        self.above, self.words, self.articles, self.title, self.counts = above, 0, 0, False, True


class _Open:
    """An open block element: what holds for the blocks in it."""

    __slots__ = ("tag", "side", "article", "hidden", "header")

    def __init__(self, tag: str, side: _Part | None, article: bool, hidden: bool, header: _Part | None):
        self.tag, self.side, self.article, self.hidden, self.header = tag, side, article, hidden, header


class _Page:
    """The blocks of one page, cut while its tags go by."""

    def __init__(self):
        self.words = self.articles = 0
        self.sides: list[_Part] = []
        self.stack = [_Open("", None, False, False, None)]
        self.open: dict[str, int] = {}
        self.blocks: list[tuple] = []
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.link = 0  # height of the stack where the open link began
        self.hide: tuple[str, int] | None = None  # hidden inline element: its tag and that height
        self.depth = 0  # elements of its tag that are open

    def text(self, piece: str) -> None:
        if self.hide is None:
            self.pieces.append(piece)
            if self.link:
                self.linked.append(piece)

    def flush(self) -> None:
        text = " ".join(entities.unescape("".join(self.pieces)).split()) if self.pieces else ""
        top = self.stack[-1]
        if text and not top.hidden:
            words = text.count(" ") + 1
            share = min(1.0, len(entities.unescape(" ".join(self.linked)).split()) / words) if self.linked else 0.0
            kind = _KINDS.get(top.tag, 0)
            side = top.side
            if kind == 1 and top.header is not None and side is top.header:
                side = side.above  # a heading in the header of an article is the article's
            self.blocks.append((text, words, share, kind, side, top.article))
            self.words += words
            if side is not None:
                side.words += words
                side.title |= top.tag == "h1"
        self.pieces, self.linked = [], []

    def pop_to(self, height: int) -> None:
        while len(self.stack) > height:
            self.open[self.stack.pop().tag] -= 1
        if self.link > height:
            self.link = 0
        if self.hide is not None and self.hide[1] > height:
            self.hide = None

    def inline(self, tag: str, closing: bool, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.text(" ")
        if tag in _VOID:
            return
        if self.hide is not None and tag == self.hide[0]:
            self.depth += -1 if closing else 1
            if not self.depth:
                self.hide = None
        elif self.hide is None and not closing and attributes and _hidden(attributes):
            self.hide, self.depth = (tag, len(self.stack)), 1
        if tag == "a":
            self.link = len(self.stack) if not closing and "href" in attributes else 0

    def block(self, tag: str, closing: bool, attributes: dict[str, str]) -> None:
        self.flush()
        if tag in _VOID:
            return
        stack, top = self.stack, self.stack[-1]
        if closing:
            if self.open.get(tag):
                height = len(stack) - 1
                while stack[height].tag != tag:
                    height -= 1
                self.pop_to(height)
            return
        if top.tag == "p" or top.tag in _HEADINGS or (tag == "li" and top.tag == "li"):  # these hold no such blocks
            self.pop_to(len(stack) - 1)
            top = stack[-1]
        side, header = top.side, top.header
        article = top.article or tag in _ARTICLE_TAGS
        marked = bool(attributes) and _side_words(attributes)
        if tag in _ARTICLE_TAGS:
            if not marked:  # one that is marked may be a comment
                if side is not None:
                    side.articles += 1
                self.articles += 1
        elif tag not in ("html", "body") and (tag in _SIDE_TAGS or marked):
            side = _Part(side)
            self.sides.append(side)
            if tag == "header" and top.article:
                header = side
        self.open[tag] = self.open.get(tag, 0) + 1
        stack.append(_Open(tag, side, article, top.hidden or _hidden(attributes), header))

    def result(self) -> list[tuple]:
        """The blocks with all their features, once the page is over."""
        self.flush()
        for part in reversed(self.sides):  # inner ones come after outer ones
            if part.above is not None:
                part.above.words += part.words
                part.above.articles += part.articles
                part.above.title |= part.title
        total, articles = max(1, self.words), self.articles
        for part in self.sides:  # what holds most of the page and its title or all its articles is no side part
            part.counts = not (2 * part.words > total and (part.title or (articles > 0 and part.articles == articles)))
        nearest: dict[int, _Part | None] = {}
        for part in self.sides:
            nearest[id(part)] = part if part.counts else part.above and nearest[id(part.above)]
        edge = (None, 0, 0.0)
        padded = [edge, *self.blocks, edge]
        found = []
        for before, b, after in zip(padded, self.blocks, padded[2:]):
            text, words, share, kind, side, article = b
            side = side and nearest[id(side)]
            side_share = 1.0 if side is None else min(0.99, side.words / total)
            found.append((text, words, share, before[1], before[2], after[1], after[2], kind, side_share, float(article)))
        return found


def text_blocks(html: str) -> list[tuple]:
    """(text, *FEATURES) of each block that has text, in page order, in time proportional to the page."""
    page = _Page()
    endless: set[str] = set()  # raw elements known to have no end tag from here on
    last = html.rfind(">")
    at = 0
    while (start := html.find("<", at)) >= 0:
        if start > at:
            page.text(html[at:start])
        at = start
        if found := _COMMENT.match(html, at):
            at = found.end()
        elif html.startswith(("<!", "</", "<?"), at) and not html[at + 2 : at + 3].isalpha() or html.startswith(("<!", "<?"), at):
            if at < last:  # a declaration, or a comment of the older form
                at = html.index(">", at) + 1
            else:
                page.text("<")
                at += 1
        elif found := _TAG.match(html, at):
            closing, tag, attributes = bool(found[1]), found[2].lower(), found[3]
            at = found.end()
            if not html.startswith(">", at):
                if at < len(html) or not (closing or tag in _INLINE or tag in _KINDS or tag in _PLAIN_TAGS or tag in _SIDE_TAGS):
                    page.text(found[0])  # a sign in the text, no tag
                continue  # else a tag that the end of the page cuts off
            at += 1
            if tag in _RAW:
                if not closing and tag not in endless:
                    end = re.compile(f"</{tag}(?![a-zA-Z0-9:-])", re.I).search(html, at)
                    if end:
                        at = end.start()
                        page.text(" ")
                    elif tag in _RAW_TO_END:
                        at = len(html)
                    else:
                        endless.add(tag)
                continue
            values = _attributes(attributes) if attributes and not closing else {}
            (page.inline if tag in _INLINE else page.block)(tag, closing, values)
        else:
            page.text("<")
            at += 1
    page.text(html[at:])
    return page.result()


def page_blocks(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, blocks``: the blocks of each page with their features; no shuffle."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("text"))
    struct = pa.list_(pa.struct([("text", pa.string()), *((f, pa.float32()) for f in FEATURES)]))
    names = ("text", *FEATURES)

    def work(batch: pa.RecordBatch) -> dict:
        found = [[dict(zip(names, b)) for b in text_blocks(h)] for h in batch.column("text").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "blocks": pa.array(found, struct)}

    kinds = dict(rows.dtypes)
    return map_slices(rows, work, f"page_id {kinds['page_id']}, url {kinds['url']}, blocks array<{BLOCK}>")


# -- the small labelled table ------------------------------------------------------
_LONG, _SHORT = (18, 31, 44, 60, 85, 120, 170), (1, 2, 3, 4, 6, 9, 13)


class _Words:
    """Texts of changing lengths whose words say what they are, in a fixed order of lengths."""

    def __init__(self, start: int):
        self.at = start

    def _text(self, word: str, lengths: tuple[int, ...]) -> str:
        self.at += 1
        return " ".join([word] * lengths[self.at * self.at % 49 % len(lengths) if self.at % 3 else self.at % len(lengths)])

    def fill(self, layout: str, word: str) -> str:
        """``layout`` with L and S in braces as long and short texts, A as a link and U as a list of links."""

        def piece(found: re.Match) -> str:
            if found[1] == "U":
                return "<ul>" + "".join(f"<li><a href='/{k}'>{self._text(word, _SHORT[:4])}</a></li>" for k in range(3 + self.at % 6)) + "</ul>"
            text = self._text(word, _LONG if found[1] == "L" else _SHORT)
            return f"<a href='/q'>{text}</a>" if found[1] == "A" else text

        return re.sub(r"\{([LSAU])\}", piece, layout)


#: What stands around a whole page; none of it says anything about the article.
_AROUND = ("<body>", "<body class='has-sidebar'>", "<body><form action='/'>", "<body><div id='page' class='with-sidebar'>", "<html><head><title>T</title><body>")
#: Parts before the article.
_BEFORE = (
    "<nav>{U}</nav><div class='ad'>{S}</div>",
    "<div>{U}</div><div>{A} | {A}</div>",
    "<header><h1>{S}</h1>{U}</header><aside><p>{L}</p></aside>",
    "<div class='cookie-notice'><p>{L}</p></div><div>{U}</div>",
    "<table><tr><td>{A}</td><td>{A}</td><td>{A}</td></tr></table>",
    "",
    "<div>{A}</div><div>Menu</div><div>{A}</div><div>Log in</div>",
    "<div class='sidebar'><h3>{S}</h3><p>{L}</p></div><div class='menu'>{U}</div>",
    "<nav>{U}</nav><div class='ad'>{L}</div>",
    "<div>{A} | {A}</div>",
    "<h3>{S}</h3>{U}<p>{A} | {A}</p>",
    "<p>{S}</p><p>{A} {A}</p><h2>{S}</h2>{U}",
)
#: Articles in parts; the flag says whether a part is main text.
_MAIN = (
    (("<article><h1>{S}</h1><p>{L}</p><p>{S}</p><p>{L}</p><p>{S}</p></article>", True),),
    (("<main><h1>{S}</h1><p>{L}</p><ul><li>{S}</li><li>{S}</li></ul><p>{L}</p><table><tr><td>{S}</td><td>{S}</td></tr></table></main>", True),),
    (("<div><h1>{S}</h1><p>{L}</p><p>{L} {A}</p><p>{S}</p><p>{L}</p></div>", True),),
    (("<h1>{S}</h1><p>{L}</p><blockquote>{L}</blockquote><p>{L}</p><h2>{S}</h2><p>{L}</p>", True),),
    (("<article class='post tags'><h1>{S}</h1><p>{L}</p><p>{L}</p>{U}<p>{S}</p></article>", True),),
    (("<article><header><h1>{S}</h1>", True), ("<p>{S}</p></header>", False), ("<p>{L}</p><p>{S}</p>", True), ("<aside><h3>{S}</h3><p>{L}</p></aside>", False), ("<p>{L}</p>", True), ("<div class='share'>{U}</div></article>", False)),
    (("<div class='content'><h1>{S}</h1>{L}<h3>{S}</h3><div>{L}</div><ul><li>{S}</li><li>{L}</li></ul><div>{L} {A}</div></div>", True),),
    (("<article><h1>{S}</h1><p>{L}</p>{U}<p>{L}</p><h2>{S}</h2><p>{A}</p><p>{S} {A}</p></article>", True),),
    (("<article><h1>{S}</h1><p>{S}</p></article>", True),),
    (("<article><div>{S}</div><div>{L}</div>{L}<div>{S}</div><h2>{S}</h2><pre>{L}</pre></article>", True),),
    (("<section><h2>{S}</h2><p>{L}</p><p>{L}</p></section>", True), ("<div class='newsletter'><p>{L}</p><form><label>{S}</label></form></div>", False), ("<section><h2>{S}</h2><p>{L}</p><p>{L}</p></section>", True)),
    (("<div><div>{S}</div><div>{L}</div><div>{S}</div><div>{L}</div><div>{L}</div></div>", True),),
    (("<div><h2>{S}</h2><div>{L}</div><p>{S}</p><div>{L}</div><div>{S} {A}</div><p>{L}</p></div>", True),),
    (("{S}<div>{S}</div>", False),),  # no article at all
)
#: Parts behind it.
_AFTER = (
    "<footer>{S}</footer>",
    "<div>&copy; {S}</div><div>{A} | {A}</div>",
    "<div class='comments'><h3>{S}</h3><p>{L}</p><p>{S}</p><p>{L}</p></div><footer>{U}</footer>",
    "<section class='related'><h3>{S}</h3>{U}</section><div id='footer'>{S}</div>",
    "",
    "<section id='comments'><article class='comment'><p>{L}</p></article><article class='comment'><p>{S}</p></article></section>",
    "<div>{U}</div><div>{A} {A}</div>",
    "<div>&copy; {S}</div>",
    "<div>{S}</div>",
    "<h3>{S}</h3>{U}",
    "<p>{A} | {A}</p><p>{S}</p><p>{A}</p>",
)


def _pages() -> tuple[tuple[tuple[str, bool], ...], ...]:
    pages = []
    for m, main in enumerate(_MAIN):
        for b, before in enumerate(_BEFORE):
            for turn in (0, 3):
                words = _Words(7 * m + 5 * b + 11 * turn)
                around, after = _AROUND[(m + 2 * b + turn) % len(_AROUND)], _AFTER[(3 * m + b + turn) % len(_AFTER)]
                parts = ((around + before, False), *main, (after, False))
                pages.append(tuple((words.fill(part, "main" if flag else "other"), flag) for part, flag in parts))
    return tuple(pages)


#: Pages in parts; the flag says whether the part's blocks are main text. Blocks are cut from the joined page.
LABELLED_PAGES = _pages()


def labelled_blocks() -> list[tuple]:
    """(*FEATURES, main) of the blocks of ``LABELLED_PAGES``."""
    blocks = (block for parts in LABELLED_PAGES for block in text_blocks("".join(part for part, _ in parts)))
    return [(*map(float, block[1:]), float(block[0].startswith("main"))) for block in blocks]


def train_tree(spark: SparkSession, max_depth: int = 10):
    """A Spark ML decision tree over ``FEATURES``, from the labelled table."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = spark.createDataFrame(labelled_blocks(), ", ".join(f"{f} double" for f in (*FEATURES, "main"))).coalesce(1)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return DecisionTreeClassifier(labelCol="main", maxDepth=max_depth, maxBins=64, seed=7).fit(vectors)


def tree_column(model, block: Column) -> Column:
    """The tree's answer about a block as nested conditions, so that no vectors are built."""
    lines = [line.strip() for line in model.toDebugString.splitlines()[1:] if line.strip()]
    feature = re.compile(r"(?:If|Else) \(feature (\d+) (<=|>|in|not in) ([^)]*)\)")

    def read(at: int) -> tuple[Column, int]:
        if lines[at].startswith("Predict"):
            return F.lit(float(lines[at].split(":")[1]) > 0.5), at + 1
        name, sign, bound = feature.match(lines[at]).groups()
        value = block[FEATURES[int(name)]].cast("double")
        if sign not in ("<=", ">"):
            raise ValueError(f"unexpected split: {lines[at]}")
        test = value <= float(bound) if sign == "<=" else value > float(bound)
        yes, at = read(at + 1)
        no, at = read(at + 1)  # the line of the Else itself
        return F.when(test, yes).otherwise(no), at

    return read(0)[0]


def main_text(blocks: DataFrame, model) -> DataFrame:
    """``page_id, url, text`` from ``page_blocks``."""
    kept = F.filter("blocks", lambda b: tree_column(model, b))
    return blocks.select("page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"))


def op9_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_text(page_blocks(table(spark, sf_dir, "pages")), train_tree(spark))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
