"""Label/value pages: a line that is a known label is followed by its value.

All of it is array functions on the page's own row: no shuffle, no Python.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keypanel.functions.text import trimmed
from keypanel.operators.columns import safe_name


def filled_lines(text: Column) -> Column:
    """Non-empty lines of a text, stripped."""
    return F.filter(F.transform(F.split(text, "\n"), trimmed), lambda line: line != "")


def next_pairs(lines: Column) -> Column:
    """Each line with the one after it: ``array<struct<line, next>>``, last line left out."""
    follows = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.zip_with(F.slice(lines, F.lit(1), F.size(follows)), follows,
                      lambda line, after: F.struct(line.alias("line"), after.alias("next")))


def with_line_pairs(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the pairs of consecutive non-empty lines of a text column."""
    lines = df.withColumn(name, filled_lines(F.col(text)))
    return lines.withColumn(name, next_pairs(F.col(name)))


def label_values(df: DataFrame, text: str, labels: list[str]) -> DataFrame:
    """One column per label with the line after it; the last occurrence wins."""
    pairs = with_line_pairs(df, text, "_pairs")

    def value(label: str) -> Column:
        hits = F.filter("_pairs", lambda pair: pair["line"] == label)
        return F.try_element_at(hits, F.lit(-1))["next"].alias(safe_name(label))

    return pairs.select(*df.columns, *[value(label) for label in labels])


# Named character references, from the standard library's table of HTML names.
NAMED = {name[:-1]: sign for name, sign in html.entities.html5.items() if name.endswith(";")}


def decoded(text: Column) -> Column:
    """Text with its character references (named, decimal, hexadecimal) resolved.

    The text is cut at every ``&``; a piece that starts with a known reference
    loses it to its character, any other piece gets its ``&`` back.
    """
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def resolved(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        digits = F.regexp_extract(name, r"^#0*(\d{1,7})$", 1)
        decimal = F.when(digits != "", digits.try_cast("bigint"))
        digits = F.regexp_extract(name, r"^#[xX]0*([0-9a-fA-F]{1,6})$", 1)
        hexadecimal = F.when(digits != "", F.conv(digits, 16, 10).try_cast("bigint"))
        code = F.coalesce(decimal, hexadecimal)
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        sign = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        sign = F.when(name.startswith("#"), sign).otherwise(F.try_element_at(names, name))
        rest = F.substring(piece, F.length(name) + F.lit(2), F.length(piece))
        return F.when(piece.contains(";") & sign.isNotNull(), F.concat(sign, rest)).otherwise(
            F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolved)
    return F.concat(pieces[0], F.array_join(tail, ""))


def plain_text(page: Column) -> Column:
    """Text of a page: tags become line breaks, character references are resolved."""
    no_code = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "\n")
    return decoded(F.regexp_replace(no_code, r"(?s)<[^>]*>", "\n"))
