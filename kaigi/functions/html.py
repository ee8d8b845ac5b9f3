"""Start tags of web pages as Column expressions, as an HTML parser sees them.

Comments, declarations, instructions and the insides of scripts and styles hold no tags; attribute values are quoted, bare or
missing; character references in them are decoded.  A comment that is never closed reaches to the page's end; a tag that is
never closed, or breaks off in a quoted value, is text.  Tags with over ATTRIBUTES attributes are text too, so that no page can
make a pattern deep.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTRIBUTES = 300
_NAME = r"[a-zA-Z][^\t\n\r\f />\x00]*+"
_GAP = r"(?:\s++|/(?!>)){0,100}+"
_VALUE = r"""'[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+"""
_ATTRIBUTE = rf"""(?<=['"\s/])([^\s/>][^\s/=>]*+)(?:\s*+=++\s*+({_VALUE})\s*+)?+{_GAP}"""
_ATTRIBUTES = rf"[\s/]*+(?:{_ATTRIBUTE.replace('([^', '(?:[^').replace(f'({_VALUE})', f'(?:{_VALUE})')}){{0,{ATTRIBUTES}}}+\s*+"
_TAG = rf"<({_NAME})({_ATTRIBUTES})/?>"
_MARKUP = rf"(?s)<!--.*?(?:--\s*+>|\z)|<![^>]*+>?|<\?[^>]*+>?|</[^>]*+>?|<(?i:(script|style))(?=[\t\n\r\f >]){_ATTRIBUTES}>.*?(?=</(?i:\1)\s*+>|\z)|<{_NAME}{_ATTRIBUTES}/?>|<[a-zA-Z][^>]*+>?"
_REFERENCE = r"&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)"


def _named() -> Column:
    """Names of character references, those that need a semicolon with it, and what they stand for: the standard library's table."""
    from html.entities import html5

    return F.from_json(F.lit(json.dumps(html5)), "map<string,string>")


def _numbered(number: Column) -> Column:
    """The character of a number; numbers of the C1 controls stand for what Windows put there, others that are no characters for
    the replacement character or nothing."""
    windows = {n: bytes([n]).decode("cp1252") for n in range(0x80, 0xA0) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
    given = F.create_map(*(F.lit(x) for pair in windows.items() for x in pair))
    low = F.pmod(number, F.lit(0x10000))
    nothing = number.between(1, 8) | (number == 11) | number.between(14, 31) | number.between(127, 159) | number.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE)
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "�")
        .when(number == 13, "\r")
        .when(number.isin(list(windows)), F.try_element_at(given, number.cast("int")))
        .when(number.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        .when(nothing, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def unescape(text: Column) -> Column:
    """Character references decoded; names that need no semicolon also at the beginning of a longer run."""
    found = F.regexp_extract_all(text, F.lit(f"({_REFERENCE})"), 1)
    named = _named()

    def decoded(ref):
        name = F.substring(ref, 2, 40)
        digits = F.regexp_extract(ref, r"^&#(?:[xX])?0*+([0-9a-fA-F]*+)", 1)
        # Beyond eight digits every number is no character.
        number = F.when(F.length(digits) > 8, F.lit(0x110000)).when(digits == "", F.lit(0)).otherwise(F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long"))
        shorter = [F.concat(F.try_element_at(named, F.substring(name, 1, n)), F.substring(name, n + 1, 40)) for n in range(6, 1, -1)]
        return F.when(ref.startswith("&#"), _numbered(number)).otherwise(F.coalesce(F.try_element_at(named, name), *[F.when(F.length(name) > n, s) for n, s in zip(range(6, 1, -1), shorter, strict=True)], ref))

    gaps = F.split(text, _REFERENCE, -1)
    whole = F.array_join(F.zip_with(gaps, F.transform(found, decoded), lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")
    return F.when(text.contains("&"), whole).otherwise(text)


def start_tags(page: Column) -> Column:
    """array<struct<tag, attributes: array<struct<name, value>>>> of a page's start tags in order; names in lower case, the value of an
    attribute without one is null."""

    def tag(m):
        region = F.regexp_extract(m, f"(?s)^{_TAG}", 2)
        pairs = F.arrays_zip(F.regexp_extract_all(region, F.lit(_ATTRIBUTE), 1).alias("n"), F.regexp_extract_all(region, F.lit(_ATTRIBUTE), 2).alias("v"), F.regexp_extract_all(region, F.lit(f"({_ATTRIBUTE})"), 1).alias("whole"))

        def attribute(p):
            bare = F.when(p["v"].rlike("""^(?s)(?:'.*'|".*")$""") & (F.length(p["v"]) > 1), F.substring(p["v"], F.lit(2), F.length(p["v"]) - 2)).otherwise(p["v"])
            given = F.substring(p["whole"], F.length(p["n"]) + 1, F.lit(1 << 30)).rlike(r"^\s*+=")
            return F.struct(F.lower(p["n"]).alias("name"), F.when(given, unescape(bare)).alias("value"))

        return F.struct(F.lower(F.regexp_extract(m, f"(?s)^{_TAG}", 1)).alias("tag"), F.transform(pairs, attribute).alias("attributes"))

    matches = F.regexp_extract_all(page, F.lit(f"({_MARKUP.replace(chr(92) + '1', chr(92) + '2')})"), 1)
    return F.filter(F.transform(F.filter(matches, lambda m: m.rlike("^<[a-zA-Z]")), tag), lambda t: t["tag"] != "")


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute; of several the last."""
    found = F.filter(tag["attributes"], lambda a: a["name"] == name)
    return F.try_element_at(found, F.lit(-1))["value"]
