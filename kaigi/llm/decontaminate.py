"""Benchmark decontamination (4): spaced seeds over tokens, joined, then verification that tolerates substitutions.

A mask of fixed positions ignores the words at its gaps: hashes of the other words of a benchmark item and of a document
agree although words in the gaps were replaced.  Both sides are hashed at every place under every mask and joined on the
hash; around each hit, item and document are laid side by side, and the longest stretch is kept in which the given share of
the words agrees and which begins and ends with a word that agrees or at an end of the item.  A stretch of LEAST_OVERLAP
words, or of all words of a shorter item, makes a leak.

* A Bloom filter of at most FILTER_BITS bits, made of the items' hashes, is all that is broadcast: document hashes that can't be an
  item's are left out where they arise.  A larger benchmark fills the filter, which lets more hashes through to the join, but
  neither side is collected and the documents are read once whatever its size.
* Documents and items are cut at every STEP words into pieces that overlap by MARGIN words on both sides, so no row holds a
  whole long text, and a stretch is looked for within MARGIN words of a hit.
* Hits are first joined with one place of each hash only (the smallest).  Documents that this proves to be leaks are done;
  only the others' hits are joined with the further places of hashes that have several.  A template that many documents and
  many items share thus makes as many rows as it has documents.

Words are runs of letters and digits, A-Z in lower case; every byte beyond ASCII counts as a letter, typographic quotes and
dashes too.  Items of fewer than `least_words` words, null or empty items have no hits, nor have null and empty texts.  Equal rows
are treated alike; ties go to the smallest item_id and text.  Columns besides doc_id and text are left alone.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exchange import settled, sized
from .line_dedup import free_name
from .textbytes import NOT_ALNUM, U64, Texts, batch_slices, mix

#: Fixed masks: 1 is a word that must agree.  Any two replaced words in 13 leave one whole, and of the ways to replace a fifth
#: of 14 to 60 words, 97 % or more do.
MASKS = ("11110111", "11101001011", "1101000101011", "1100110011001")
SHARE = 0.8
LEAST_OVERLAP = 13
LEAST_WORDS = 5
STEP, MARGIN = 256, 64
#: Bits of the broadcast filter, at most (32 MB), and for each hash of the benchmark; odd numbers that choose a hash's bits.
FILTER_BITS, BITS_FOR_EACH = 1 << 28, 64
_CHOICES = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_ITEMS = "item_id long, item_row long, piece int, first int, n_words int, words binary, keys array<long>, places array<int>"
_ITEMS_PA = pa.schema(
    [("item_id", pa.int64()), ("item_row", pa.int64()), ("piece", pa.int32()), ("first", pa.int32()), ("n_words", pa.int32()), ("words", pa.binary()), ("keys", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
)
_HITS = "doc_id long, row long, piece int, first int, words binary, keys array<long>, places array<int>"
_HITS_PA = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("piece", pa.int32()), ("first", pa.int32()), ("words", pa.binary()), ("keys", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
)


def whole_masks(n: int, share: float = SHARE) -> list[str]:
    """Masks over all n words of a short item: of k + 3 pieces (n at most) every choice of k is ignored, where k words of it
    may be replaced, so some mask is whole wherever they are."""
    gone = int(n * (1 - share) + 1e-9)
    bounds = [round(i * n / min(n, gone + 3)) for i in range(min(n, gone + 3) + 1)] if n > 6 else list(range(n + 1))
    pieces = list(zip(bounds, bounds[1:], strict=False))
    return ["".join("0" if any(a <= i < b for a, b in left) else "1" for i in range(n)) for left in combinations(pieces, gone)]


def spaced(words: np.ndarray, mask: str) -> np.ndarray:
    """A hash for each place where the mask fits; different masks give different hashes of the same words."""
    places = np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1"))
    n = max(0, len(words) - len(mask) + 1)
    out = np.full(n, int(mask, 2) + (len(mask) << 32), U64)
    with np.errstate(over="ignore"):
        for j in places:
            out = out * U64(0x2545F4914F6CDD1D) + words[j : j + n]
        return mix(out)


def _seeds(texts: Texts, words: np.ndarray, masks: list[str]):
    """(keys, places) of each mask, at every place where it lies within one text."""
    for mask in masks:
        keys = spaced(words, mask)
        at = np.flatnonzero(texts.doc[: len(keys)] == texts.doc[len(mask) - 1 : len(mask) - 1 + len(keys)])
        yield keys[at], at


def _pieces(texts: Texts, words: np.ndarray, keys: np.ndarray, places: np.ndarray):
    """(text, piece, first word, words, keys, places in the text) of every piece of STEP words that a place lies in."""
    low = words.astype("<u4")
    doc = texts.doc[places]
    within = places - texts.first[doc]
    order = np.lexsort((keys, within, doc))
    doc, within, keys = doc[order], within[order], keys[order]
    piece = within // STEP
    cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)], strict=True):
        if s == e:
            continue
        d, p = int(doc[s]), int(piece[s])
        a, b = int(texts.first[d]), int(texts.first[d + 1])
        first = max(0, p * STEP - MARGIN)
        yield d, p, first, low[a + first : min(b, a + (p + 1) * STEP + 16 + MARGIN)].tobytes(), keys[s:e].view(np.int64), within[s:e].astype(np.int32)


def _table(schema: pa.Schema, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _item_rows(masks: list[str], share: float, least_words: int, least_overlap: int):
    def rows(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                texts = Texts(batch.column(1), NOT_ALNUM, lower=True)
                words, sizes = texts.hashes(), np.diff(texts.first)
                found = [(np.zeros(0, U64), np.zeros(0, np.int64))]
                for keys, at in _seeds(texts, words, masks):
                    ok = sizes[texts.doc[at]] >= least_overlap
                    found.append((keys[ok], at[ok]))
                for n in sorted({int(n) for n in sizes if least_words <= n < least_overlap}):
                    for keys, at in _seeds(texts, words, whole_masks(n, share)):
                        ok = sizes[texts.doc[at]] == n
                        found.append((keys[ok], at[ok]))
                keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
                ids, row = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                yield _table(_ITEMS_PA, [(ids[d], row[d], p, first, int(sizes[d]), blob, k, places) for d, p, first, blob, k, places in _pieces(texts, words, keys, at)])

    return rows


def _slots(keys: np.ndarray, choice: np.uint64, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (keys * choice >> U64(64 - bits)).astype(np.int64)


def _probe(masks: list[str], filled: np.ndarray, bits: int):
    def rows(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                texts = Texts(batch.column(1), NOT_ALNUM, lower=True)
                words, found = texts.hashes(), [(np.zeros(0, U64), np.zeros(0, np.int64))]
                for keys, at in _seeds(texts, words, masks):
                    for choice in _CHOICES:
                        slot = _slots(keys, choice, bits)
                        some = (filled[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                        keys, at = keys[some], at[some]
                    found.append((keys, at))
                keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
                ids, row = batch.column(0), batch.column(2)
                yield _table(_HITS_PA, [(ids[d].as_py(), row[d].as_py(), p, first, blob, k, places) for d, p, first, blob, k, places in _pieces(texts, words, keys, at)])

    return rows


def _filter(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A Bloom filter of the items' hashes, 8 bits to a byte, and the number of bits that choose one of its bits."""
    bits = max(10, min(FILTER_BITS, seeds.count() * BITS_FOR_EACH).bit_length() - 1)

    def chosen(batches):
        for batch in batches:
            keys = np.asarray(batch.column(0)).view(U64)
            slot = np.unique(np.concatenate([_slots(keys, choice, bits) for choice in _CHOICES]))
            at, starts = np.unique(slot >> 6, return_index=True)
            bit = np.bitwise_or.reduceat(U64(1) << (slot & 63).astype(U64), starts) if len(at) else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], names=["at", "bit"])

    # at most FILTER_BITS / 64 rows of two numbers
    rows = seeds.select("key").mapInArrow(chosen, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    filled = np.zeros((1 << bits) // 64, "<i8")
    filled[np.asarray(rows["at"])] = np.asarray(rows["bit"])
    return filled.view(np.uint8), bits


def longest(same: np.ndarray, share: float, from_start: bool, to_end: bool) -> tuple[int, int]:
    """Bounds of the longest stretch that agrees in at least `share` of its words and begins and ends with one that agrees,
    or at an end of `same` if from_start or to_end; of equally long ones the first."""
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1.0 - share, -share))])
    begins, ends = np.append(same, False), np.insert(same, 0, False)
    begins[0] |= from_start
    ends[-1] |= to_end
    least = np.minimum.accumulate(np.where(begins, score, np.inf))
    stops = np.flatnonzero(ends)
    # the first place whose score is no higher; sums of shares are not exact
    starts = np.searchsorted(-least, -(score[stops] + 1e-7))
    if not len(stops) or (stops - starts).max() <= 0:
        return 0, 0
    i = int(np.argmax(stops - starts))
    return int(starts[i]), int(stops[i])


_OVERLAP = T.StructType([T.StructField(c, T.IntegerType()) for c in ("n_overlap", "n_match", "doc_start", "item_start")])


def _verified(share: float, least_overlap: int):
    @F.arrow_udf(_OVERLAP)
    def overlap(doc: pa.Array, doc_first: pa.Array, item: pa.Array, item_first: pa.Array, n_words: pa.Array, shift: pa.Array) -> pa.Array:
        """shift: the place in the document where the item's first word lies."""
        out = []
        for d, f, i, g, n, x in zip(*(c.to_pylist() for c in (doc, doc_first, item, item_first, n_words, shift)), strict=True):
            left, right = np.frombuffer(d, "<u4"), np.frombuffer(i, "<u4")
            # the words of the item that both pieces hold, as places in the item
            a, b = max(g, f - x), min(g + len(right), f - x + len(left))
            if a >= b:
                out.append(None)
                continue
            s, t = longest(right[a - g : b - g] == left[a + x - f : b + x - f], share, a == 0, b == n)
            same = int((right[a + s - g : a + t - g] == left[a + s + x - f : a + t + x - f]).sum())
            out.append({"n_overlap": t - s, "n_match": same, "doc_start": a + s + x, "item_start": a + s} if t - s >= min(least_overlap, n) else None)
        return pa.array(out, pa.struct([(c, pa.int32()) for c in ("n_overlap", "n_match", "doc_start", "item_start")]))

    return overlap


def _leaks(hits: DataFrame, seeds: DataFrame, regions: DataFrame, items: DataFrame, share: float, least_overlap: int) -> DataFrame:
    """doc_id, row and the best verified overlap of the hits with the seeds."""
    place = F.col("at") - F.col("place")
    pairs = hits.join(seeds, "key").select("doc_id", "row", "piece", "item_id", "item_row", "item_piece", place.cast("int").alias("shift")).distinct()
    d, i = regions.alias("d"), items.alias("i")
    both = pairs.alias("p").join(d, F.col("p.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("p.row") == F.col("d.row")) & (F.col("p.piece") == F.col("d.piece")))
    both = both.join(i, (F.col("p.item_id") == F.col("i.item_id")) & (F.col("p.item_row") == F.col("i.item_row")) & (F.col("p.item_piece") == F.col("i.piece")))
    o = _verified(share, least_overlap)("d.words", "d.first", "i.words", "i.first", "i.n_words", "p.shift")
    found = both.select("p.doc_id", "p.row", "p.item_id", "p.item_row", o.alias("o")).where("o is not null")
    best = F.struct("o.n_match", "o.n_overlap", (-F.col("item_id")).alias("i"), (-F.col("o.doc_start")).alias("d"), (-F.col("o.item_start")).alias("s"))
    found = found.groupBy("doc_id", "row").agg(F.max(best).alias("b"))
    return found.select("doc_id", "row", (-F.col("b.i")).alias("item_id"), "b.n_match", "b.n_overlap", (-F.col("b.d")).alias("doc_start"), (-F.col("b.s")).alias("item_start"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, share: float = SHARE, least_overlap: int = LEAST_OVERLAP, least_words: int = LEAST_WORDS
) -> DataFrame:
    """doc_id, row (xxhash64 of the text, which tells rows of one doc_id apart), item_id, n_match, n_overlap, doc_start,
    item_start: one row for each document that overlaps an item, with the overlap that has the most words that agree among
    those that prove it (see above); n_overlap is at most the length of a piece."""
    asked = benchmark.where("item_id is not null and text is not null").select("item_id", "text", F.xxhash64("text").alias("item_row")).distinct()
    items = settled(asked.mapInArrow(_item_rows(list(masks), share, least_words, least_overlap), _ITEMS))
    seeds = items.select("item_id", "item_row", F.col("piece").alias("item_piece"), F.explode(F.arrays_zip("keys", "places")).alias("s"))
    seeds = seeds.select("item_id", "item_row", "item_piece", F.col("s.keys").alias("key"), F.col("s.places").alias("place"))
    filled, bits = _filter(seeds)
    short = [r.n_words for r in items.where(F.col("n_words") < least_overlap).select("n_words").distinct().orderBy("n_words").collect()]
    every = [*masks, *(m for n in short for m in whole_masks(n, share))]
    regions = settled(docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(_probe(every, filled, bits), _HITS))
    hits = regions.select("doc_id", "row", "piece", F.explode(F.arrays_zip("keys", "places")).alias("s")).select("doc_id", "row", "piece", F.col("s.keys").alias("key"), F.col("s.places").alias("at"))
    regions, items = regions.drop("keys", "places"), items.drop("keys", "places")
    member = F.struct("item_id", "item_row", "item_piece", "place")
    firsts = settled(seeds.groupBy("key").agg(F.min(member).alias("m"), F.count(F.lit(1)).alias("held")).select("key", "m.*", "held"))
    first = settled(_leaks(hits, firsts.drop("held"), regions, items, share, least_overlap))
    rest = hits.alias("h").join(first.alias("f"), F.col("h.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("h.row") == F.col("f.row")), "left_anti")
    further = seeds.join(firsts.where("held > 1").select("key", F.struct("item_id", "item_row", "item_piece", "place").alias("m")), "key").where(member != F.col("m")).drop("m")
    return first.unionByName(_leaks(rest, further, regions, items, share, least_overlap))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that overlap an item; all their columns stay as they are."""
    name = free_name(docs, "leak")
    leaks = settled(overlaps(docs, benchmark, **options).select(F.col("doc_id").alias(f"{name}_id"), F.col("row").alias(f"{name}_row")).distinct())
    return docs.join(sized(leaks), docs["doc_id"].eqNullSafe(leaks[f"{name}_id"]) & (F.xxhash64(docs["text"]) == leaks[f"{name}_row"]), "left_anti")
