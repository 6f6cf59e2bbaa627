from hypothesis import given, settings
from hypothesis import strategies as st

from pricelane.sources.html_tree import HtmlTree

PIECES = [
    "<div>", "</div>", '<p class="a b">', "</p>", "<br>", "<br/>", "<div/>", "text &amp; x", "&copy=1",
    '<a href="?a=1&copy=2">', "</a>", "<!-- c -->", "<!---->", "<!-->", "<script>if(a<b){}</script>",
    "<style>", "</style>", "<title>x</title>", "<title>a<b>c</title>", "<textarea>", "<s>", "</s>",
    " \n ", "<", ">", "a < b", "<a b=c d>", "<i x='1'y=2>", "<img src=/p/1>", "&amp", "</ p>",
    "<?php ?>", "<![CDATA[x]]>", '<p\n id = "z">', "<SPAN Class=X>", "</SPAN >", "<x-y z>", '"',
    "<!DOCTYPE html>", "<noscript>", "</noscript>", '<a href="a&amp;b" title="&quot;">', " ",
    '<b c="1" c="2">', "<script/>", "<script src=x></script >", "<!-- a --!> b -->", "</br>",
    "<template>", "</template>", "<pre>  </pre>", "<script><!-- x --></script>",
]


class Standard(HtmlTree):
    """Always read by the standard parser."""

    def _read_clean(self, html):
        self._restart()
        return False


def shape(tree):
    return [
        item if isinstance(item, str) else (item.tag, item.attrs, item.start, item.end, item.end_no)
        for item in tree.items
    ]


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_both_readers_agree(pieces):
    html = "".join(pieces)
    assert shape(HtmlTree(html)) == shape(Standard(html))


def test_tags_that_were_read_before_read_the_same():
    from pricelane.sources import html_tree

    html = '<div class="a b"><p x="1>2">t</p><br/><i/><title>x</title><b c=\'d\'></div>e<p hidden>'
    html_tree._KNOWN_TAGS.clear()
    first = shape(HtmlTree(html))
    assert '<div class="a b">' in html_tree._KNOWN_TAGS and '<p x="1>' not in html_tree._KNOWN_TAGS
    assert shape(HtmlTree(html)) == first == shape(Standard(html))


def test_known_tags_are_bounded():
    from pricelane.sources import html_tree

    HtmlTree("".join(f"<i x={n}></i>" for n in range(html_tree._KNOWN_COUNT + 10)) + f'<b y="{"z" * 400}">')
    assert len(html_tree._KNOWN_TAGS) <= html_tree._KNOWN_COUNT
    assert all(len(raw) <= html_tree._KNOWN_LENGTH for raw in html_tree._KNOWN_TAGS)


def test_texts_skip_scripts_and_split_at_comments():
    tree = HtmlTree("<body>a<!-- x -->b<script>c</script><style>d</style> <p> e </p></body>")
    assert tree.stripped(tree.root) == ["a", "b", "e"]
    assert tree.text(tree.root) == "ab  e "


def test_unclosed_tags_nest_without_recursion():
    depth = 20000
    tree = HtmlTree("<div>" * depth + "deep" + "<p>" * 10)
    assert tree.text(tree.root) == "deep"
    assert len(tree.find_all(lambda e: e.tag == "div")) == depth


def test_lines_follow_blocks_and_breaks():
    tree = HtmlTree(
        "<body><div>one <b>two</b></div>three<br>four<p hidden>no</p>"
        "<p style='display: none'>no</p><table><tr><td>a</td><td>b</td></tr></table>"
        "<pre>x\ny</pre></body>"
    )
    assert tree.lines(tree.root) == ["one two", "three", "four", "a\tb", "x", "y"]


def test_text_without_parts():
    tree = HtmlTree("<div>1<p>2</p><span>3</span>4</div>")
    box = tree.find(lambda e: e.tag == "div")
    inner = tree.find(lambda e: e.tag == "p")
    assert tree.text(box, skip=(inner, None)) == "134"
    assert tree.own_texts(box) == ["1", "4"]
