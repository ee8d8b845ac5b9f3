"""Text functions as Column expressions; null in, null out unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Line ends of splitlines().
LINE_ENDS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
#: Older forms of characters in names and the forms they are folded to.
VARIANTS = ("德榮惠穗廣燁滿壽", "徳栄恵穂広耀満寿")
FULL_WIDTH_DIGITS = "０１２３４５６７８９"


def strip(c: Column) -> Column:
    """Without white space, in the sense of Unicode, at both ends."""
    # the look-behind keeps long runs inside a text from being tried again at each of their characters
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|(?<![\s\x1c-\x1f])[\s\x1c-\x1f]+$", "")


def strip_label(c: Column) -> Column:
    return F.btrim(c, F.lit("= \n"))


def half_width_digits(c: Column) -> Column:
    return F.translate(c, FULL_WIDTH_DIGITS, "0123456789")


@F.pandas_udf(T.StringType())
def nfkc(names: pd.Series) -> pd.Series:
    """Compatibility normalisation, which no built-in function offers; use it on distinct names only."""
    return names.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def folded_name(normalised: Column, fold_variants: bool) -> Column:
    """A name after nfkc: white space out, older forms folded where the profile asks for it."""
    bare = F.regexp_replace(normalised, r"(?U)\s+", "")
    return F.translate(bare, *VARIANTS) if fold_variants else bare


def safe_filename(c: Column) -> Column:
    return strip(F.regexp_replace(c, r'[\\/:*?"<>|]', "_"))


def split_lines(c: Column, every_kind: bool = False) -> Column:
    return F.split(c, LINE_ENDS if every_kind else "\n")


def unix_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def or_empty(c: Column) -> Column:
    """Null and the empty string alike."""
    return F.coalesce(c, F.lit(""))


def printable_ratio(c: Column) -> Column:
    """Share of printable characters; 0 for an empty text."""
    return F.length(F.regexp_replace(c, r"[\p{C}\p{Zs}\p{Zl}\p{Zp}&&[^ ]]", "")) / F.greatest(F.length(c), F.lit(1))


def chunks(c: Column, size: int = 2000) -> Column:
    """Slices of `size` code points; an empty text is one empty slice."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(c), F.lit(1)) - 1, F.lit(size))
    return F.transform(starts, lambda i: F.substring(c, i + 1, F.lit(size)))


def parse_marker(c: Column) -> Column:
    """struct(role, name) of what follows the marker sign: ROLE（NAME君）, NAME君, or the bare text as a name."""
    bare = strip(c)
    # the role ends at the first bracket after its first character and gives nothing back, so long markers take linear time
    with_role, with_title = r"^(.[^（\n\r]*+)（(.+)君）\s*$", r"^(.+)君\s*$"
    role = F.when(bare.rlike(with_role), strip(F.regexp_extract(bare, with_role, 1)))
    name = F.when(bare.rlike(with_role), strip(F.regexp_extract(bare, with_role, 2))).when(bare.rlike(with_title), strip(F.regexp_extract(bare, with_title, 1))).otherwise(bare)
    return F.struct(role.alias("role"), name.alias("name"))


def words(c: Column) -> Column:
    """The default tokens: runs of two letters or more, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}]{2,}"), 0)


def japanese_words(c: Column) -> Column:
    """Runs of kanji or katakana, for text that no morphological tokenizer has split."""
    return F.regexp_extract_all(F.lower(c), F.lit("[一-龥々]{2,}|[ァ-ヴー]{2,}"), 0)


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, without its parts . and .. (.. at the top is left out)."""
    parts = F.split(path, "/")
    n = F.size(parts)
    numbered = F.transform(parts, lambda x, i: F.struct(x.alias("x"), (i == n - 1).alias("last")))

    def step(kept, p):
        up = F.when(F.size(kept) > 1, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
        end = F.when(p["last"], F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.when(p["x"] == "..", F.concat(up, end)).when(p["x"] == ".", F.concat(kept, end)).otherwise(F.concat(kept, F.array(p["x"])))

    joined = F.array_join(F.aggregate(numbered, F.array().cast("array<string>"), step), "/")
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), joined).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """href against the page's address: absolute, scheme-relative, root-relative and relative references, also those that are a
    query or a fragment only; repeated slashes of a relative one are one."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(F.substring(plain, F.length(root) + 1, F.length(plain)), "[^/]*$", "")
    path, rest = F.regexp_extract(href, "^[^?#]*", 0), F.regexp_extract(href, "[?#].*$", 0)
    rooted = F.when(href.startswith("/"), path).otherwise(F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), path), "/{2,}", "/"))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1), href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(plain, href))
        .otherwise(F.concat(root, without_dots(rooted), rest))
    )


def last_part(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def json_int(c: Column, field: str) -> Column:
    """A whole number in a JSON object, null where there is none."""
    return F.from_json(c, f"`{field}` string")[field].try_cast("int")
