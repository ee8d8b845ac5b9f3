"""Tokenizers and token filters.

A tokenizer turns a text column into array<struct<surface, lemma, pos1, pos2, pos3>>.  The default one is an expression over
runs of letters; a morphological one is used where fugashi can be imported.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import LINE_ENDS, words
from ..profiles import TokenRules

MORPHEMES = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("surface", "lemma", "pos1", "pos2", "pos3")]))
NOUN, PROPER, PERSON = "名詞", "固有名詞", "人名"
ERAS = ("明治", "大正", "昭和", "平成", "令和")
Tokenizer = Callable[[Column], Column]


def letter_runs(text: Column) -> Column:
    """Runs of two letters or more as common nouns."""
    return F.transform(words(text), lambda w: F.struct(w.alias("surface"), w.alias("lemma"), F.lit(NOUN).alias("pos1"), F.lit("普通名詞").alias("pos2"), F.lit("一般").alias("pos3")))


def morphological(tagger: Callable[[], Callable] | None = None) -> Tokenizer:
    """A tokenizer from a function that makes a tagger once per Python worker; by default fugashi's."""

    def default():
        from fugashi import Tagger

        return Tagger()

    make = tagger or default

    def tagged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tag = make()
        for texts in batches:
            yield texts.map(lambda t: [(w.surface, w.feature.lemma, w.feature.pos1, w.feature.pos2, w.feature.pos3) for w in tag(t or "")])

    tagged.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(tagged, MORPHEMES)


def base_form(m: Column) -> Column:
    return F.coalesce(F.nullif(m["lemma"], F.lit("")), m["surface"])


def is_katakana(w: Column) -> Column:
    return w.rlike("^[ァ-ヴー]+$")


def is_hiragana(w: Column) -> Column:
    return w.rlike("^[ぁ-ん]+$")


def is_number(w: Column) -> Column:
    return w.rlike(r"^[0-9０-９\s\-・]+$")


def has_ascii(w: Column) -> Column:
    return w.rlike("[a-zA-Z]")


def keeps(m: Column, rules: TokenRules) -> Column:
    """Does a morpheme stay?  Everything but the tokenizer is plain column logic."""
    base = base_form(m)
    skip = ["非自立可能", "接尾辞", "数詞"] + (["助数詞相当語"] if rules.drop_counters else [])
    ok = (m["pos1"] == NOUN) & ~F.coalesce(m["pos2"], F.lit("")).isin(skip) & (F.length(base) >= 2) & ~base.isin(list(rules.stop or ()) or [""])
    if rules.drop_persons:
        ok &= F.coalesce(m["pos3"], F.lit("")) != PERSON
    if rules.max_length:
        ok &= F.length(base) <= rules.max_length
    ok &= ~(is_katakana(base) & (F.coalesce(m["pos2"], F.lit("")) == PROPER)) if rules.katakana == "proper" else ~is_katakana(base)
    ok &= ~is_number(base) & ~is_hiragana(base) & ~has_ascii(base)
    if rules.drop_hyphen:
        ok &= ~base.contains("-")
    if rules.drop_eras:
        ok &= ~base.isin(*ERAS)
    if rules.drop_title:
        ok &= ~base.endswith("君")
    return F.coalesce(ok, F.lit(False))


def token_table(texts: DataFrame, entity: str, text: str, rules: TokenRules, tokenizer: Tokenizer = letter_runs) -> DataFrame:
    """entity, term, exact: the lower-cased tokens that stay, one row each; exact: the token has no capitals.  Counts that are
    shown take exact ones only, weights take all."""
    if rules.stop is None:
        raise ValueError("these rules need their stop words: see profiles.stop_words_from")
    found = texts.select(entity, F.explode(tokenizer(F.col(text))).alias("m")).where(keeps(F.col("m"), rules))
    base = base_form(F.col("m"))
    return found.select(entity, F.lower(base).alias("term"), (base == F.lower(base)).alias("exact"))


def without_front_matter(body: Column) -> Column:
    """Without the block of attendance and without marker lines, as sessions of the parliament are tokenised."""
    bare = F.regexp_replace(body, r"(?s)◎会議録情報[^\n]*\n.*?(?=\n◎|\z)", "")
    return F.array_join(F.filter(F.split(bare, LINE_ENDS), lambda x: ~x.startswith("◎")), "\n")


def drop_stop_words(tokens: DataFrame, stops: DataFrame, term: str = "term") -> DataFrame:
    return tokens.join(stops, term, "left_anti")
