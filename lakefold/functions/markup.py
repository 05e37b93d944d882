"""Text of HTML nodes (F20): character references and trimming."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, which a node's text is trimmed of.
SPACE = r"[\t\n\x0b\f\r \x{85}\p{Z}]"
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"


#: Numbers that HTML reads as Windows-1252 bytes (the five unused ones as they are).
_WINDOWS = {n: c for n in range(0x80, 0xA0) if (c := bytes([n]).decode("cp1252", "ignore"))}


def _character(code: Column) -> Column:
    """The character of a number: U+FFFD where there is none."""
    windows = F.create_map(*[F.lit(x) for n, c in _WINDOWS.items() for x in (n, c)])
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    found = F.coalesce(F.try_element_at(windows, code.cast("int")), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.when(code.isNull(), None).when(valid, found).otherwise("\ufffd")


def unescape(text: Column, names: dict[str, int] | None = None) -> Column:
    """Decode character references: decimal, hexadecimal and named ones
    (``names``: to code points; default the HTML 4 set, and ``apos``).  What
    is no reference, or names no character, stays as it is."""
    points = {**name2codepoint, "apos": ord("'")} if names is None else names
    table = F.create_map(*[F.lit(x) for name, code in sorted(points.items()) for x in (name, chr(code))])
    # each piece is a reference or a run of anything else
    pieces = F.regexp_extract_all(text, F.lit(f"{_REFERENCE}|[^&]+|&"), F.lit(0))

    def decoded(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        number = F.when(inner.rlike("^#[xX]"), F.conv(F.substring(inner, F.lit(3), F.length(inner)), 16, 10)).when(
            inner.startswith("#"), F.substring(inner, F.lit(2), F.length(inner)))
        found = F.coalesce(_character(number.cast("long")), F.try_element_at(table, inner))
        return F.when(piece.startswith("&") & (F.length(piece) > 1), F.coalesce(found, piece)).otherwise(piece)

    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def trim_node(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")
