r"""Filter interaction audit (13): what each of five filters removes in every order, and its Shapley share, by part.

One pass over the texts gives each document a mask of the filters it fails; no text leaves its task.  Filter E (a copy of a
text with a smaller doc_id) needs the whole table: digests are grouped for their smallest doc_id, and rows meet it by digest
and doc_id, so that a text held by a third of all rows is one row of the join.  What is left is a count for each part, mask
and label.

A part's counts are its removal polynomial, multilinear in five variables that are 1 where a filter is on: a document with
mask M adds 1 - prod(1 - x_i for i in M).  Its values at corners are what sets of filters remove; the integral of a partial
derivative along the diagonal is a filter's Shapley value, an exact rational whose 120-fold is the sum over all orders.

A null text is empty, a null lang the part ''.  Rows with equal doc_ids don't copy each other; a null doc_id is no smaller
than any and has none smaller.  Repeated rows count each.  Of several labels of a document the largest of each kind counts.
Other columns play no part, whatever their names.  Without documents there are no rows.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import settled

FILTERS = "ABCDE"
#: Filter E's bit; the others' are found where a text is.
COPY = 1 << 4
_UPPER, _ODD, _CONTINUED = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
_MEASURED = "doc_id long, part string, mask int, digest binary"
AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: bytes) -> int:
    """The bits of filters A to D that a text (UTF-8) fails."""
    words = text.split()
    n = len(words)
    capitals = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    odd = len(text.translate(None, _ODD)) < len(text)
    return (n < 100) | (100 * len(set(words)) < 80 * n) << 1 | (100 * capitals > 10 * points) << 2 | odd << 3


def _measured(batches):
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        digests = [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(map(failures, texts), pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic, n: the documents that fail exactly the filters of a mask."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    rows = settled(rows.mapInArrow(_measured, _MEASURED))
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), COPY).otherwise(0)
    told = rows.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return told.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), flag("good"), flag("toxic")).groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def removal_polynomial(counts: dict[int, int]) -> dict[int, int]:
    """The coefficient of each product of variables (a mask) of sum n * (1 - prod(1 - x_i))."""
    out: dict[int, int] = {}
    for mask, n in counts.items():
        bits = [1 << i for i in range(len(FILTERS)) if mask >> i & 1]
        for k in range(1, len(bits) + 1):
            for some in combinations(bits, k):
                out[sum(some)] = out.get(sum(some), 0) + (n if k % 2 else -n)
    return out


def corner(polynomial: dict[int, int], on: int) -> int:
    """The value where exactly the variables of a mask are 1."""
    return sum(c for term, c in polynomial.items() if term & on == term)


def shapley(polynomial: dict[int, int], bit: int) -> Fraction:
    """The integral over t from 0 to 1 of the derivative by one variable where all variables are t."""
    return sum((Fraction(c, term.bit_count()) for term, c in polynomial.items() if term & bit), Fraction(0))


def audited(part: str, counts: list[tuple[int, bool, bool, int]]) -> list[tuple]:
    """The rows of a part from its (mask, good, toxic, n)."""

    def polynomial(chosen):
        sums: dict[int, int] = {}
        for mask, good, toxic, n in counts:
            if chosen(good, toxic):
                sums[mask] = sums.get(mask, 0) + n
        return removal_polynomial(sums)

    size, everything = sum(n for *_, n in counts), (1 << len(FILTERS)) - 1
    polynomials = [polynomial(lambda g, t: True), polynomial(lambda g, t: g), polynomial(lambda g, t: t)]
    gone = [[corner(p, on) for on in range(everything + 1)] for p in polynomials]
    share = [shapley(polynomials[0], 1 << i) * factorial(len(FILTERS)) for i in range(len(FILTERS))]
    out = []
    for order in permutations(range(len(FILTERS))):
        on = 0
        for step, i in enumerate(order, 1):
            before, on = on, on | 1 << i
            removed, good, toxic = (g[on] - g[before] for g in gone)
            alone = gone[0][everything] - gone[0][everything ^ 1 << i]
            out.append((part, "".join(FILTERS[j] for j in order), step, size - gone[0][on], removed, gone[0][1 << i] - removed, alone, good, toxic, int(share[i])))
    return out


def _audit(part: pd.DataFrame) -> pd.DataFrame:
    rows = audited(part["part"].iloc[0], [(int(m), bool(g), bool(t), int(n)) for m, g, t, n in zip(part["mask"], part["good"], part["toxic"], part["n"], strict=True)])
    return pd.DataFrame(rows, columns=[c.split()[0] for c in AUDIT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step of it.  A part's group has 128 rows at most."""
    return mask_counts(docs, labels).groupBy("part").applyInPandas(_audit, AUDIT)
