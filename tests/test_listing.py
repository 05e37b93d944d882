"""Listings on the element tree (R1, F20) against a parser with a stack."""

import html as entities
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from lakefold.functions.markup import trim_node, unescape
from lakefold.operators import listing
from lakefold.operators.listing import listing_tree, parse_selector

SPACE = "\t\n\x0b\x0c\r \x85\xa0 　"


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []


class Tree(HTMLParser):
    """An end tag closes the nearest open element of its name."""

    def __init__(self, text):
        super().__init__(convert_charrefs=False)
        self.root = self.at = Node("", {}, None)
        self.feed(text)
        self.close()

    def add(self, node):
        self.at.children.append(node)

    def handle_starttag(self, tag, attrs):
        first = {}
        for k, v in attrs:
            first.setdefault(k, v)
        node = Node(tag, first, self.at)
        self.add(node)
        if tag not in listing.VOID + listing.RAW and not self.get_starttag_text().endswith("/>"):
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.add(Node(tag, dict(attrs), self.at))

    def handle_comment(self, data):
        self.add(None)  # what follows is another text node

    def handle_endtag(self, tag):
        self.add(None)
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.cdata_elem is None:
            self.add(data)

    def handle_entityref(self, name):
        self.add(f"&{name};")

    def handle_charref(self, name):
        self.add(f"&#{name};")


def elements(node):
    for c in node.children:
        if isinstance(c, Node):
            yield c
            yield from elements(c)


def fits(node, part):
    return ((part.tag is None or node.tag == part.tag) and set(part.names) <= set((node.attrs.get("class") or "").split())
            and (part.ident is None or node.attrs.get("id") == part.ident))


def matches(node, parts, top):
    """Whether the chain of parts ends at ``node``, all below ``top``."""
    if not parts:
        return False
    if not fits(node, parts[-1]):
        return False
    up = node.parent
    if len(parts) == 1:
        return not parts[0].child or up is top
    while up is not None and up is not top:
        if matches(up, parts[:-1], top):
            return True
        if parts[-1].child:
            return False
        up = up.parent
    return False


def texts(node):
    """Runs of text between tags."""
    run = ""
    for c in node.children:
        if c is None or isinstance(c, Node):
            yield run
            run = ""
            yield from texts(c) if c else ()
        else:
            run += c
    yield run


def brute(page, item, fields):
    tree = Tree(page)
    chain = parse_selector(item)
    items = [e for e in elements(tree.root) if matches(e, chain, None)]

    def nearest(e):
        up = e.parent
        while up is not None and up not in items:
            up = up.parent
        return up

    rows = []
    for no, it in enumerate(items, 1):
        row = [no, items.index(nearest(it)) + 1 if nearest(it) else None]
        for selector, take in fields.values():
            parts = parse_selector(selector)
            own = [it] if not parts else [e for e in elements(it) if nearest(e) is it and e not in items and matches(e, parts, it)]
            if not own:
                row.append(None)
            elif take.startswith("@"):
                row.append(entities.unescape(own[0].attrs[take[1:]] or "") if take[1:] in own[0].attrs else None)
            elif take == "strip":
                row.append("".join(entities.unescape(t).strip(SPACE) for t in texts(own[0])))
            else:
                row.append("".join(entities.unescape(t) for t in texts(own[0])))
        rows.append(tuple(row))
    return rows


def parsed(spark, pages, item, fields):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    out = {i: [] for i in range(len(pages))}
    for r in sorted(map(tuple, listing_tree(df, "html", item, fields, keep=["id"]).collect())):
        out[r[0]].append(r[1:])
    return out


NESTED = """<!DOCTYPE html><div class="group"><ul class="list news"><li id=a><div class='area'><a class="t" href="/1?a=1&amp;b=2" title='x > y'>
 One <b> &lt;bold&gt; </b>&#233;&#x6f22; &nbsp;</a><p>text &copy; </p><ul><li><div class=area><a href=/1.1>inner &unknown; &amp;lt;</a></div></li>
</ul><p>after</div></li><li><!-- <li><a>no</a></li> --><script>var x = "<li><a>no</a></li>";</script><div class="area"><br/><a>no href</a><i></div>
</i></li></ul></div><li><a href="out">outside</a>"""
FIELDS = {"title": ("div.area > a", "strip"), "raw": ("div.area > a", "text"), "url": ("a", "@href"), "hint": ("a.t", "@title"),
          "text": ("", "strip"), "first": ("> div p", "strip")}


def test_nested_items_unclosed_tags_and_entities(spark):
    got = parsed(spark, [NESTED, None, "", "no tags < at all"], "div.group > ul.list li", FIELDS)
    assert got[0] == brute(NESTED, "div.group > ul.list li", FIELDS)
    assert got[1] == got[2] == got[3] == []
    assert got[0][0][:6] == (1, None, "One<bold>é漢", "\n One  <bold> é漢 \xa0", "/1?a=1&b=2", "x > y")
    assert got[0][1][:5] == (2, 1, "inner &unknown; &lt;", "inner &unknown; &lt;", "/1.1")


def random_page(rng):
    tags = ["li", "ul", "div", "a", "b", "p", "br"]
    out = []
    for _ in range(rng.randint(0, 120)):
        kind = rng.random()
        tag = rng.choice(tags)
        if kind < .4:
            cls = rng.choice(["", ' class="x"', " class='x y'", " id=k", ' href="/é&amp;1"', " CLASS=y"])
            out.append(f"<{rng.choice([tag, tag.upper()])}{cls}>")
        elif kind < .7:
            out.append(f"</{tag}>")
        else:
            out.append(rng.choice([" a ", "é\n", "&amp;", "&lt;b&gt; ", "　", "1 > 0 ", "1 < 2 <3 <", "<!-- <li> -->", "&#65;", "&", "&nope;", "&#0;x"]))
    return "".join(out)


@pytest.mark.parametrize("item,block", [("li", 1), ("ul li", 7), ("div > li.x", 128), ("ul > li b", 30), (".x .y", 128)])
def test_random_pages_equal_the_parser(spark, monkeypatch, item, block):
    monkeypatch.setattr(listing, "BLOCK", block)
    rng = random.Random(block)
    pages = [random_page(rng) for _ in range(60)]
    fields = {"all": ("", "strip"), "link": ("a", "@href"), "inner": ("> a b", "text"), "x": (".x", "strip"), "deep": ("div > a p", "strip"), "k": ("#k", "text")}
    got = parsed(spark, pages, item, fields)
    for i, page in enumerate(pages):
        assert got[i] == brute(page, item, fields), page


def test_unescape_and_trim(spark):
    cases = ["&amp;amp; &apos;&quot;&eacute;&hellip;", "&#8364;&#X1F600;&#xD800;&#99999999;&#0;", "& &; &a &amp", "plain", "", None, "&lt" * 3]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    want = ["&amp; '\"é…", "€😀\ufffd&#99999999;\ufffd", "& &; &a &amp", "plain", "", None, "&lt" * 3]
    assert [r[0] for r in df.select(unescape(F.col("t"))).collect()] == want
    spaced = spark.createDataFrame([(f"{SPACE}a b{SPACE}",)], "t string")
    assert spaced.select(trim_node(F.col("t"))).first()[0] == "a b"


def test_selectors():
    assert [(p.child, p.tag, p.names, p.ident) for p in parse_selector("div.a.b>ul  li#x")] == [
        (False, "div", ("a", "b"), None), (True, "ul", (), None), (False, "li", (), "x")]
    for bad in ("a:first-child", "a[href]", "a + b"):
        with pytest.raises(ValueError):
            parse_selector(bad)


def test_long_page_is_linear(spark):
    page = "<ul>" + "".join(f"<li><a href='/{i}'>t{i}</a></li>" for i in range(8000)) + "</ul>"
    got = parsed(spark, [page], "ul > li", {"t": ("a", "strip"), "u": ("a", "@href")})[0]
    assert got == [(i + 1, None, f"t{i}", f"/{i}") for i in range(8000)]


def test_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, NESTED)], "id int, html string")
    plan = listing_tree(df, "html", "li", FIELDS, keep=["id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Exchange|Arrow", plan)
