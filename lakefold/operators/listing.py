"""Items of HTML listings by selectors on the element tree.

A page is cut into tokens by one regular expression.  A fold over the tokens
keeps the stack of open elements: an end tag closes the nearest open element
of its name and all inside it, or nothing where none is open, so unclosed
and crossed tags do no harm.  Selectors are compiled to bits, one for each
of their parts; an element's bits follow from its own tag and its parent's
bits, so descendant and child selectors are matched as the stack grows,
without looking at a path again.

An item may lie inside another.  A field belongs to the nearest item around
it, and the first element that matches it there counts.  Text is taken node
by node: character references are decoded, and each node is trimmed (unless
the field is taken raw).

Everything is column functions inside one row: no shuffle, no Python.  The
fold works on blocks of ``BLOCK`` tokens, so what it has found is copied once
per block and not once per token.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.functions.markup import trim_node, unescape

BLOCK = 128
# Fixed values of HTML: elements without end tag, and elements whose content is no markup.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
RAW = ("script", "style")
#: One token: raw element, comment, declaration, end tag, start tag, text (with
#: a "<" that begins no tag), or the "<" of a tag that never ends.
TOKEN = ("(?is)" + "|".join(rf"<{n}\b[^>]*+>.*?(?:</{n}\s*>|\z)" for n in RAW)
         + r"|<!--.*?(?:-->|\z)|<[!?][^>]*+>|</[a-z][^>]*+>|<[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|(?:[^<]++|<(?![a-z/!?]))++|<")

_STACK = "array<struct<no:int,name:string,self:bigint,seen_by:bigint,item:int,found:bigint,own:bigint>>"
_FOUND = "array<struct<item:int,field:int,no:int,value:string>>"


@dataclass(frozen=True)
class Part:
    """One part of a selector: ``tag.class#id`` after ``>`` or a space."""

    child: bool
    tag: str | None
    names: tuple[str, ...]
    ident: str | None


def parse_selector(selector: str) -> list[Part]:
    """Parts of ``div.group > ul.list > li a.title#x``; a leading ``>`` asks
    for a child of the element that the selector is relative to."""
    parts, child = [], False
    for word in selector.replace(">", " > ").split():
        if word == ">":
            child = True
            continue
        if not re.fullmatch(r"(\*|[A-Za-z][\w-]*)?([.#][\w-]+)*", word):
            raise ValueError(f"selector {selector!r}: {word!r} is not understood")
        tag = re.match(r"[A-Za-z][\w-]*", word)
        parts.append(Part(child, tag.group().lower() if tag else None, tuple(re.findall(r"\.([\w-]+)", word)),
                          next(iter(re.findall(r"#([\w-]+)", word)), None)))
        child = False
    return parts


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in a start tag's text, decoded; null without."""
    pattern = rf"(?is)[\s\"'/]{re.escape(name)}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    value = F.coalesce(*[F.nullif(F.regexp_extract(tag, pattern, g), F.lit("")) for g in (1, 2, 3)], F.lit(""))
    return F.when(tag.rlike(pattern), unescape(value))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _given(acc: Column, value: Column, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the fold's state and a value that is computed once.  Unlike
    ``_let`` this does not copy what ``body`` returns, so it is for states."""
    return F.aggregate(F.array(value), acc, body)


class _Bits:
    """Selectors of an item and its fields as bits."""

    def __init__(self, item: str, fields: dict[str, tuple[str, str]]):
        self.parts: list[Part] = []
        self.roots = self.child = self.below = self.field_roots = self.field_children = self.in_fields = 0
        self.takes = [take for _, take in fields.values()]
        self.finals: list[int] = []  # per field; 0: the item itself
        chain = parse_selector(item)
        if not chain:
            raise ValueError("an item needs a selector")
        self.item = self._add(chain, False)
        for selector, _ in fields.values():
            chain = parse_selector(selector)
            self.finals.append(self._add(chain, True) if chain else 0)
        if len(self.parts) > 62 or len(fields) > 62:
            raise ValueError("too many selector parts or fields")

    def _add(self, chain: list[Part], field: bool) -> int:
        for n, part in enumerate(chain):
            bit = 1 << len(self.parts)
            self.parts.append(part)
            if field:
                self.in_fields |= bit
            if n:
                self.child, self.below = self.child | bit * part.child, self.below | bit * (not part.child)
            elif field and part.child:
                self.field_children |= bit
            elif field:
                self.field_roots |= bit
            else:
                self.roots |= bit
        return bit

    def hits(self, name: Column, tag: Column) -> Column:
        """Bits of the parts that a start tag fits by itself."""
        out = F.lit(0).cast("long")
        for n, part in enumerate(self.parts):
            fits = (name == part.tag) if part.tag else F.lit(True)
            for cls in part.names:
                own = F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+")
                fits = fits & F.array_contains(own, cls)
            if part.ident:
                fits = fits & F.coalesce(attribute(tag, "id") == part.ident, F.lit(False))
            out = out + F.when(fits, F.lit(1 << n).cast("long")).otherwise(0)
        return out


def _has(bits: Column, mask: int | Column) -> Column:
    return bits.bitwiseAND(mask if isinstance(mask, Column) else F.lit(mask).cast("long")) != 0


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _tokens(html: Column, bits: _Bits) -> Column:
    """Array of ``struct(no, kind, name, hits, raw)``; kinds are open, void,
    close, text and skip."""
    raw = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))

    def one(t: Column, no: Column) -> Column:
        name = F.lower(F.regexp_extract(t, "^</?([a-zA-Z][^\\s/>]*)", 1))
        kind = (F.when(~t.startswith("<") | (t == "<"), "text").when(name == "", "skip").when(t.startswith("</"), "close")
                .when(name.isin(*VOID, *RAW) | t.endswith("/>"), "void").otherwise("open"))
        return _let(F.struct(name.alias("name"), kind.alias("kind")), lambda k: F.struct(
            (no + 1).alias("no"), k["kind"].alias("kind"), k["name"].alias("name"),
            F.when(k["kind"].isin("open", "void"), bits.hits(k["name"], t)).otherwise(_long(0)).alias("hits"), t.alias("raw")))

    return F.transform(raw, one)


def _step(acc: Column, t: Column, bits: _Bits) -> Column:
    """The stack and what has been found after one more token."""
    stack, found = acc["stack"], acc["found"]
    top = F.try_element_at(stack, F.lit(-1))
    text_fields = sum(1 << k for k, take in enumerate(bits.takes) if not take.startswith("@"))
    tag_fields = [k for k, take in enumerate(bits.takes) if take.startswith("@")]

    def opened() -> Column:
        parent = _let(F.struct(
            F.coalesce(top["self"], _long(0)).alias("self"), F.coalesce(top["seen_by"], _long(0)).alias("any"),
            F.coalesce(top["item"], F.lit(0)).alias("item"), F.coalesce(top["no"], F.lit(0)).alias("no")), lambda p: F.struct(
            p["item"].alias("item"), p["any"].alias("any"),
            t["hits"].bitwiseAND(
                _long(bits.roots)
                .bitwiseOR(F.shiftleft(p["self"], 1).bitwiseAND(_long(bits.child)))
                .bitwiseOR(F.shiftleft(p["any"], 1).bitwiseAND(_long(bits.below)))
                .bitwiseOR(F.when(p["item"] > 0, _long(bits.field_roots)).otherwise(_long(0)))
                .bitwiseOR(F.when((p["item"] > 0) & (p["item"] == p["no"]), _long(bits.field_children)).otherwise(_long(0)))
            ).alias("self")))

        def placed(e: Column) -> Column:
            is_item = _has(e["self"], bits.item)
            own = _long(~bits.in_fields & (2**62 - 1))
            self_bits = F.when(is_item, e["self"].bitwiseAND(own)).otherwise(e["self"])
            fields = F.lit(0).cast("long")
            for k, final in enumerate(bits.finals):
                match = _has(e["self"], final) & ~is_item if final else is_item
                fields = fields + F.when(match, _long(1 << k)).otherwise(_long(0))
            before = F.coalesce(F.try_element_at(F.filter(stack, lambda x: x["no"] == e["item"]), F.lit(1))["found"], _long(0))
            return F.struct(
                is_item.alias("is_item"), self_bits.alias("self"),
                F.when(is_item, e["any"].bitwiseOR(e["self"]).bitwiseAND(own)).otherwise(e["any"].bitwiseOR(e["self"])).alias("any"),
                F.when(is_item, t["no"]).otherwise(e["item"]).alias("item"), e["item"].alias("outer"),
                F.when(is_item, fields).otherwise(fields.bitwiseAND(F.bitwise_not(before))).alias("fresh"))

        def grown(acc: Column, e: Column) -> Column:
            stack, found = acc["stack"], acc["found"]
            marked = F.when((e["fresh"] != 0) & ~e["is_item"], F.transform(stack, lambda x: F.when(
                x["no"] == e["item"], x.withField("found", x["found"].bitwiseOR(e["fresh"]))).otherwise(x))).otherwise(stack)
            entry = F.struct(t["no"].alias("no"), t["name"].alias("name"), e["self"].alias("self"), e["any"].alias("seen_by"),
                             e["item"].alias("item"), F.when(e["is_item"], e["fresh"]).otherwise(_long(0)).alias("found"),
                             e["fresh"].bitwiseAND(_long(text_fields)).alias("own"))
            new = [F.when(e["is_item"], _found(e["item"], -1, t["no"], e["outer"].cast("string")))]
            new += [F.when(_has(e["fresh"], 1 << k), _found(e["item"], k, t["no"], t["raw"])) for k in tag_fields]
            # an element with text fields says so, also where it holds no text
            new += [F.when(_has(e["fresh"], 1 << k), _found(e["item"], k, t["no"], F.lit("")))
                    for k in range(len(bits.takes)) if k not in tag_fields]
            quiet = (e["fresh"] == 0) & ~e["is_item"]
            return F.struct(
                F.when(t["kind"] == "open", F.concat(marked, F.array(entry))).otherwise(marked).cast(_STACK).alias("stack"),
                F.when(quiet, found).otherwise(F.concat(found, F.array_compact(F.array(*new)).cast(_FOUND))).alias("found"))

        return _given(acc, _let(parent, placed), grown)

    def closed() -> Column:
        back = F.array_position(F.reverse(F.transform(stack, lambda x: x["name"])), t["name"]).cast("int")
        return _given(acc, back, lambda a, b: F.struct(
            F.when(b > 0, F.slice(a["stack"], F.lit(1), F.size(a["stack"]) - b)).otherwise(a["stack"]).cast(_STACK).alias("stack"),
            a["found"].alias("found")))

    powers = F.array(*[_long(1 << k) for k in range(len(bits.takes))])

    def written() -> Column:
        owners = F.filter(stack, lambda x: x["own"] != 0)
        rows = F.flatten(F.transform(owners, lambda x: F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(len(bits.takes) - 1)), lambda k: _has(x["own"], F.element_at(powers, k + 1))),
            lambda k: F.struct(x["item"].alias("item"), k.alias("field"), t["no"].alias("no"), t["raw"].alias("value")))))
        return F.struct(stack.alias("stack"), F.concat(found, rows.cast(_FOUND)).alias("found"))

    same = F.struct(stack.alias("stack"), found.alias("found"))
    return (F.when(t["kind"].isin("open", "void"), opened()).when(t["kind"] == "close", closed())
            .when((t["kind"] == "text") & F.exists(stack, lambda x: x["own"] != 0), written()).otherwise(same))


def _found(item: Column, field: int, no: Column, value: Column) -> Column:
    return F.struct(item.alias("item"), F.lit(field).alias("field"), no.alias("no"), value.alias("value"))


def listing_tree(df: DataFrame, html_col: str, item: str, fields: dict[str, tuple[str, str]],
                 keep: Iterable[str] = ()) -> DataFrame:
    """One row per item of each page: ``keep``, ``item_no`` (1-based, in
    document order), ``parent_no`` (of the item around it, else null) and the
    fields.

    ``item`` is a selector (tags, classes, ids, descendants, children).  A
    field is (selector relative to the item, what to take): ``"strip"`` the
    text, each node trimmed, ``"text"`` the text as it is, ``"@name"`` an
    attribute; the selector ``""`` is the item itself.  A field without a
    matching element, or attribute, is null.  A null page has no items.
    """
    keep, names = list(keep), list(fields)
    bits = _Bits(item, fields)
    empty = F.struct(F.array().cast(_STACK).alias("stack"), F.array().cast(_FOUND).alias("found"))

    def block(acc: Column, tokens: Column) -> Column:
        return F.aggregate(tokens, F.struct(acc["stack"].alias("stack"), F.array().cast(_FOUND).alias("found")),
                           lambda a, t: _step(a, t, bits),
                           lambda r: F.struct(r["stack"].alias("stack"), F.concat(acc["found"], r["found"]).alias("found")))

    # every intermediate array is bound once: an expression inside a lambda is evaluated again for each element
    def blocks(t: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(t, i + 1, F.lit(BLOCK)))

    def items(found: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(found)), lambda i: F.element_at(found, i)["field"] == -1)
        return _let(starts, lambda s: _let(F.transform(s, lambda i: F.element_at(found, i)["item"]), lambda numbers: F.transform(
            s, lambda at, j: one(found, s, numbers, at, j))))

    def one(found: Column, starts: Column, numbers: Column, at: Column, j: Column) -> Column:
        outer = F.element_at(found, at)["value"].cast("int")
        end = F.coalesce(F.try_element_at(starts, j + 2), F.size(found) + 1)
        return F.struct(F.when(outer > 0, F.array_position(numbers, outer).cast("int")).alias("parent_no"),
                        F.transform(F.sequence(at, end - 1), lambda i: F.element_at(found, i)).alias("own"))

    folded = F.aggregate(_let(_tokens(F.col(html_col), bits), blocks), empty, block, lambda r: F.array_sort(r["found"]))  # by item, field, place
    every = _let(folded, lambda found: F.when(F.size(found) > 0, items(found)))
    rows = df.select(*keep, F.posexplode(F.when(F.col(html_col).isNotNull(), every)).alias("__no", "__i")).select(
        *keep, (F.col("__no") + 1).alias("item_no"), "__i.parent_no", F.col("__i.own").alias("__i"))

    def field(k: int, name: str) -> Column:
        take = list(fields.values())[k][1]
        own = F.transform(F.filter("__i", lambda x: x["field"] == k), lambda x: x["value"])
        if take.startswith("@"):
            value = attribute(F.element_at(own, 1), take[1:])
        else:
            value = F.array_join(F.transform(own, lambda v: trim_node(unescape(v)) if take == "strip" else unescape(v)), "")
        return F.when(F.size(own) > 0, value).alias(name)

    return rows.select(*keep, "item_no", "parent_no", *[field(k, c) for k, c in enumerate(names)])
