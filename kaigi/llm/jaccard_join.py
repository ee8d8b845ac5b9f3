"""N-gram Jaccard join (8): a size-aware heavy-light similarity join on sets of word shingles.

Texts with equal sets form a class; only classes are compared.  Two classes link when 100 * |A & B| >= 100 t * |A | B|.

* Light sets (up to a boundary size) enumerate subsets of fixed size: for each size of a partner that the threshold allows,
  all subsets of the overlap which that partner would need.  Two light sets link only if they share such a subset.
* Heavy sets scan inverted lists: each set is ordered from its rarest shingle on, and only the shingles of its prefix, of
  which two linked sets must share one, have lists.  Bounds on size and on the position of the common shingle prune a list.
* The boundary is the size below which the subsets of all sets cost less than scanning their lists, by counts of the corpus.

Lists are not expanded into pairs, and none has to fit in a task.  Postings are sorted over ranges of (list, document), so a
long list spans many partitions.  First every member is held against its list's first member in the partition and, if the
list spans partitions, against its very first member; verified links are closed into components.  Then only lists that hold
several components are dealt, long ones as pairs of blocks of LIST_BLOCK members, and members of different components are
held against each other, which leaves no work in a group of mutual copies.  Verification compares whole sets, and each of
its tasks returns the links that span its components.  Shingle frequencies come from the packed exchange; links, components
and sets stay distributed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .exchange import Chunked, bucket_of, bucket_ranges, chunk_of, chunked, from_low, groups, low_bytes, settled, table
from .textbytes import SPACES, U64, Texts, batch_slices, mix, ngrams

#: No set above this size enumerates subsets, whatever the costs.
MOST_LIGHT = 40
#: Members of a block of a long list, and postings that a task holds against each other.
LIST_BLOCK, PART_ROWS = 4096, 200_000
#: Members of a list that are held against each other at once.
_SQUARE = 1024
_SETS = "doc_id long, n_shingles long, fp1 long, fp2 long"
_KEYS = "chunk int, bucket int, keys binary, extra binary"
_KEYS_PA = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary())])
_RARITY = "chunk int, bucket int, extra binary, held long, lists long"
_RARITY_PA = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("extra", pa.binary()), ("held", pa.int64()), ("lists", pa.int64())])
_POSTS = "kind int, key long, doc_id long, n int, at int, chunk int, shingles binary"
_POSTS_PA = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("chunk", pa.int32()), ("shingles", pa.binary())]
)
_HEADS = "pairs binary, kind int, key long, doc_id long, n int, at int"
_HEADS_PA = pa.schema([("pairs", pa.binary()), ("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])
_PAIRS = "a long, b long"
_PAIRS_PA = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SENT = "chunk int, a long, shingles binary, others array<long>"
_SENT_PA = pa.schema([("chunk", pa.int32()), ("a", pa.int64()), ("shingles", pa.binary()), ("others", pa.list_(pa.int64()))])


class Threshold:
    """t as a fraction of integers, so that no comparison rounds."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be over 0 and at most 100")
        self.p = percent

    def overlap(self, n, m):
        """Shingles that sets of n and m must share: the least o with 100 o >= p (n + m - o)."""
        return -(-(self.p * (n + m)) // (100 + self.p))

    def least_size(self, n):
        return -(-(self.p * n) // 100)

    def most_size(self, n):
        return (100 * n) // self.p

    def prefix(self, n):
        return n - self.least_size(n) + 1


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's distinct shingles, ascending, one text after the other, and their offsets.  A text of fewer than k
    words has its whole sequence as its one shingle; a text without words has none."""
    words = texts.hashes()
    keys = ngrams(words, k)
    counts = np.diff(texts.first)
    sets, sizes = [], []
    for i, n in enumerate(counts.tolist()):
        a = int(texts.first[i])
        if n >= k:
            own = np.unique(keys[a : a + n - k + 1])
        else:
            own = ngrams(words[a : a + n], n) if n else np.zeros(0, U64)
        sets.append(own)
        sizes.append(len(own))
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _set_rows(k: int, separators: np.ndarray):
    def sums(values, bounds):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
        return (total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)

    def rows(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                keys, bounds = shingle_sets(Texts(batch.column(1), separators, lower=True), k)
                with np.errstate(over="ignore"):
                    prints = sums(mix(keys + U64(1)), bounds), sums(mix(keys ^ U64(0xA0761D6478BD642F)), bounds)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), *map(pa.array, prints)], names=["doc_id", "n_shingles", "fp1", "fp2"])

    return rows


def document_sets(docs: DataFrame, k: int, separators: np.ndarray = SPACES) -> DataFrame:
    """doc_id, n_shingles and a 128-bit fingerprint of the set."""
    return docs.select("doc_id", "text").mapInArrow(_set_rows(k, separators), _SETS)


def _of_classes(chunk: pa.Table, reps: list[int], k: int, separators: np.ndarray):
    """doc_ids and sets of the chunk's rows that stand for a class; of rows with one doc_id, the one with the least text."""
    wanted, at, text = set(reps), {}, chunk.column("text")
    for i, d in enumerate(chunk.column("doc_id").to_pylist()):
        if d in wanted and (d not in at or (text[i].as_py() or "") < (text[at[d]].as_py() or "")):
            at[d] = i
    rows = chunk.take(pa.array(sorted(at.values()), pa.int64()))
    keys, bounds = shingle_sets(Texts(rows.column("text"), separators, lower=True), k)
    return np.asarray(rows.column("doc_id"), np.int64), keys, bounds


def _frequency_rows(k: int, separators: np.ndarray, buckets: int):
    def rows(chunk: pa.Table, reps: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if chunk.num_rows and reps.num_rows:
            _, keys, _ = _of_classes(chunk, reps.column("rep").to_pylist(), k, separators)
            keys, held = np.unique(keys, return_counts=True)
            low, held, at = low_bytes(keys, 5), held.astype("<u4"), chunk.column("chunk")[0].as_py()
            for bucket, a, b in bucket_ranges(bucket_of(keys, buckets), buckets):
                many = np.flatnonzero(held[a:b] > 1).astype("<u4")
                extra = many.tobytes() + held[a:b][many].tobytes()
                for column, x in zip(out, (at, bucket, low[a:b].tobytes(), extra), strict=True):
                    column.append(x)
        return table(_KEYS_PA, out)

    return rows


def _rarity(df: np.ndarray) -> np.ndarray:
    """One byte that never falls as the frequency grows, and is 1 for 1 alone."""
    return np.where(df < 128, df, np.minimum(255, 100 + 4 * np.log2(np.maximum(df, 1)))).astype(np.uint8)


def _frequencies(bucket: pa.Table) -> pa.Table:
    blobs = bucket.column("keys").to_pylist()
    keys, bounds = from_low(b"".join(blobs), 5), np.cumsum([0, *(len(x) // 5 for x in blobs)])
    held = np.ones(len(keys), np.int64)
    for extra, start in zip(bucket.column("extra").to_pylist(), bounds[:-1], strict=True):
        many, n = np.frombuffer(extra, "<u4").reshape(2, -1)
        held[start + many.astype(np.int64)] = n
    order, starts, run = groups(keys)
    df = np.add.reduceat(held[order], starts)
    byte, shared = _rarity(df)[run], df[df > 1]
    rest = [0] * (len(blobs) - 1)
    blobs = [byte[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return table(_RARITY_PA, [bucket.column("chunk").to_pylist(), bucket.column("bucket").to_pylist(), blobs, [int(shared.sum()), *rest], [len(shared), *rest]])


def subset_sizes(n: int, most: int, limit: Threshold) -> list[int]:
    """The overlaps that light partners of a set of n need."""
    return sorted({int(limit.overlap(n, m)) for m in range(int(limit.least_size(n)), min(most, int(limit.most_size(n))) + 1)})


def _subsets(keys: np.ndarray, size: int) -> np.ndarray:
    """A hash of every subset of the given size: the sum of mixed members, less the left-out ones."""
    with np.errstate(over="ignore"):
        values = mix(keys)
        sums, last = np.array([values.sum(dtype=U64)]), np.array([-1])
        for _ in range(len(keys) - size):
            reach = len(keys) - 1 - last
            nxt = np.repeat(last + 1, reach) + (np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach))
            sums, last = np.repeat(sums, reach) - values[nxt], nxt
        return mix(sums + U64(size) * U64(0x9E3779B97F4A7C15))


def _posting_rows(k: int, separators: np.ndarray, buckets: int, light: int, limit: Threshold):
    def rows(chunk: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(6)]
        blobs: list = []
        if not chunk.num_rows or not right.num_rows:
            return table(_POSTS_PA, [[]] * 7)
        reps = [x for x in right.column("rep").to_pylist() if x is not None]
        ids, keys, bounds = _of_classes(chunk, reps, k, separators)
        distinct, where = np.unique(keys, return_inverse=True)
        byte, answers = np.ones(len(distinct), np.uint8), {b: x for b, x in zip(right.column("bucket").to_pylist(), right.column("extra").to_pylist(), strict=True) if b is not None}
        for b, s, e in bucket_ranges(bucket_of(distinct, buckets), buckets):
            byte[s:e] = np.frombuffer(answers[b], np.uint8)
        byte, at = byte[where], chunk.column("chunk")[0].as_py()

        def put(kind, values, doc, n, places):
            size = len(values)
            values = np.asarray(values, U64)
            fields = ([kind] * size, values.view(np.int64).tolist(), [doc] * size, [n] * size, places, [at] * size)
            for column, x in zip(out, fields, strict=True):
                column.extend(x)
            blobs.extend([None] * size)

        for i, doc in enumerate(ids.tolist()):
            own, rare = keys[bounds[i] : bounds[i + 1]], byte[bounds[i] : bounds[i + 1]]
            n = len(own)
            if not n:
                continue
            posted = False
            if n <= light:
                # a shingle that no other set holds is in no common subset
                common = own[rare > 1]
                for size in subset_sizes(n, light, limit):
                    if len(common) >= size:
                        found = _subsets(common, size)
                        put(1, found, doc, n, [0] * len(found))
                        posted = True
            if limit.most_size(n) > light:
                prefix = np.lexsort((own, rare))[: int(limit.prefix(n))]
                place = np.flatnonzero(rare[prefix] > 1)
                if len(place):
                    put(2, own[prefix[place]], doc, n, place.tolist())
                    posted = True
            if posted:
                for column, x in zip(out, (0, 0, doc, n, 0, at), strict=True):
                    column.append(x)
                blobs.append(own.astype("<u8").tobytes())
        return table(_POSTS_PA, [*out, blobs])

    return rows


def _fits(limit: Threshold, light: int, kind, n, at, m, to):
    """May members (n, at) and (m, to) of one list link?  Of kind 2, what stands before both places is not common."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    ok = small >= limit.least_size(large)
    return ok & ((kind == 1) | ((large > light) & (np.minimum(n - at, m - to) >= limit.overlap(n, m))))


def _pairs_table(a: np.ndarray, b: np.ndarray) -> pa.Table:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return table(_PAIRS_PA, [pairs[:, 0], pairs[:, 1]])


def _near_heads(limit: Threshold, light: int):
    """Over one sorted partition: each member with its list's first member here, packed, and the first members of the
    partition's first and last list, which may go on beyond it."""

    def edges(heads):
        return table(_HEADS_PA, [[None] * len(heads), *map(list, zip(*heads, strict=True))]).to_batches()

    def rows(batches):
        first = head = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(batch.column(c), np.int64) for c in ("kind", "key", "doc_id", "n", "at")]
            kind, key, doc, n, at = columns
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])
            new[0] = head is None or head[:2] != (int(kind[0]), int(key[0]))
            starts, run = np.flatnonzero(new), np.cumsum(new)
            # entry 0 is the list that goes on from the batch before; without one, no run refers to it
            of_doc, of_n, of_at = (np.concatenate([[0 if head is None else head[i]], columns[i][starts]])[run] for i in (2, 3, 4))
            ok = (doc != of_doc) & _fits(limit, light, kind, n, at, of_n, of_at)
            if ok.any():
                pairs = np.unique(np.stack([of_doc[ok], doc[ok]], axis=1), axis=0).astype("<i8")
                yield from table(_HEADS_PA, [[pairs.tobytes()], *[[None]] * 5]).to_batches()
            if len(starts):
                head = tuple(int(c[starts[-1]]) for c in columns)
            if first is None:
                first = tuple(int(c[0]) for c in columns)
        if first is not None:
            yield from edges(sorted({first, head}))

    return rows


def _unpacked(batches):
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            pairs = np.frombuffer(blob, "<i8").reshape(-1, 2)
            yield from _pairs_table(pairs[:, 0], pairs[:, 1]).to_batches()


def _other_pairs(limit: Threshold, light: int):
    """Members of different components, of one block or of two; apart from `head`, the first member of a list that all
    others were held against before.  Pairs leave as they are found, _SQUARE * _SQUARE at most at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(list(batches))
        columns = [np.asarray(part.column(c), np.int64) for c in ("x", "y", "kind", "key", "doc_id", "n", "at", "component", "own", "head")]
        order = np.lexsort((columns[4], columns[3], columns[2], columns[1], columns[0]))
        x, y, kind, key, doc, n, at, component, own, head = (c[order] for c in columns)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        starts, found, held = np.flatnonzero(new), [], 0
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(doc)], strict=True):
            if (component[s:e] == component[s]).all():
                continue
            for p in range(s, e, _SQUARE):
                for q in range(p, e, _SQUARE):
                    i, j = np.arange(p, min(e, p + _SQUARE))[:, None], np.arange(q, min(e, q + _SQUARE))[None, :]
                    ok = (i < j) & (component[i] != component[j]) & (doc[i] != head[s]) & (doc[j] != head[s])
                    if x[s] != y[s]:
                        ok &= own[i] != own[j]
                    ok &= _fits(limit, light, kind[s], n[i], at[i], n[j], at[j])
                    i, j = (v[ok] for v in np.broadcast_arrays(i, j))
                    found.append(np.stack([doc[i], doc[j]], axis=1))
                    held += len(i)
                    if held >= _SQUARE * _SQUARE // 2 or len(found) > 4096:
                        pairs = np.concatenate(found)
                        yield from _pairs_table(pairs[:, 0], pairs[:, 1]).to_batches(max_chunksize=100_000)
                        found, held = [], 0
        if held:
            pairs = np.concatenate(found)
            yield from _pairs_table(pairs[:, 0], pairs[:, 1]).to_batches(max_chunksize=100_000)

    return rows


def _with_firsts(posts: DataFrame, edges: DataFrame, limit: Threshold, light: int) -> DataFrame:
    """The members of lists that span partitions with the list's very first member.  A partition's first and last list alone
    may span, so `edges` and what is broadcast have two rows for each partition at most, whatever the lists hold."""
    first = edges.groupBy("kind", "key").agg(F.min(F.struct("doc_id", "n", "at")).alias("first"), F.count(F.lit(1)).alias("held")).where("held > 1").drop("held")
    n, m, large = F.col("n"), F.col("first.n"), F.greatest("n", "first.n")
    # as _fits, in whole numbers
    sized = F.least(n, m) * 100 >= large * limit.p
    shared = F.least(n - F.col("at"), m - F.col("first.at")) * (100 + limit.p) >= (n + m) * limit.p
    fits = sized & ((F.col("kind") == 1) | ((large > light) & shared))
    return posts.join(F.broadcast(first), ["kind", "key"]).where((F.col("doc_id") != F.col("first.doc_id")) & fits).select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b"))


def _near_pairs(posts: DataFrame, limit: Threshold, light: int) -> DataFrame:
    """Pairs (a, b) of members with first members: their partition's and, of lists that span partitions, the very first."""
    order = ("kind", "key", "doc_id")
    near = settled(posts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_near_heads(limit, light), _HEADS))
    across = _with_firsts(posts, near.where("pairs is null").drop("pairs"), limit, light)
    return near.where("pairs is not null").select("pairs").mapInArrow(_unpacked, _PAIRS).union(across)


def _far_pairs(labelled: DataFrame, limit: Threshold, light: int) -> DataFrame:
    """Pairs (a, b) of members of one list and different components."""
    lists = labelled.groupBy("kind", "key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("held"), F.min("doc_id").alias("least"))
    lists = lists.where("held > 2 and low < high")
    lists = settled(lists.select("kind", "key", F.col("least").alias("head"), "held", F.ceil(F.col("held") / LIST_BLOCK).cast("int").alias("blocks")))
    parts = -(-(lists.agg(F.sum(F.col("held") * F.col("blocks"))).first()[0] or 0) // PART_ROWS) or 1
    own, other = F.col("own"), F.col("other")
    dealt = labelled.join(lists.drop("held"), ["kind", "key"]).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("x", F.least(own, other)).withColumn("y", F.greatest(own, other))
    dealt = dealt.select("x", "y", "kind", "key", "doc_id", "n", "at", "component", "own", "head", F.pmod(F.xxhash64("kind", "key", "x", "y"), F.lit(parts)).cast("int").alias("part"))
    return dealt.groupBy("part").applyInArrow(_other_pairs(limit, light), _PAIRS)


def _sent(chunks: int):
    """Each first set once for every chunk that holds partners of it."""

    def rows(sets: pa.Table, pairs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if sets.num_rows and pairs.num_rows:
            blob = dict(zip(sets.column("doc_id").to_pylist(), sets.column("shingles").to_pylist(), strict=True))
            a, to, b = (np.asarray(pairs.column(c), np.int64) for c in ("a", "chunk_b", "b"))
            order = np.lexsort((b, to, a))
            a, to, b = a[order], to[order], b[order]
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (to[1:] != to[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)], strict=True):
                for column, x in zip(out, (int(to[s]), int(a[s]), blob[int(a[s])], b[s:e].tolist()), strict=True):
                    column.append(x)
        return table(_SENT_PA, out)

    return rows


def _verified(limit: Threshold):
    """Links that span the task's components.  A pair whose ends earlier links connect already adds nothing to a component, so a
    member that shares lists with many first members yields one link and not one for each."""

    def rows(sets: pa.Table, sent: pa.Table) -> pa.Table:
        out: list[list] = [[], []]
        if sets.num_rows and sent.num_rows:
            above: dict[int, int] = {}

            def root(x):
                while (up := above.get(x, x)) != x:
                    above[x] = above.get(up, up)
                    x = up
                return x

            blob = dict(zip(sets.column("doc_id").to_pylist(), sets.column("shingles").to_pylist(), strict=True))
            for a, shingles, others in zip(sent.column("a").to_pylist(), sent.column("shingles").to_pylist(), sent.column("others").to_pylist(), strict=True):
                left = np.frombuffer(shingles, "<u8")
                for b in others:
                    if root(a) == root(b):
                        continue
                    right = np.frombuffer(blob[b], "<u8")
                    place = np.minimum(np.searchsorted(left, right), len(left) - 1)
                    if (left[place] == right).sum() >= limit.overlap(len(left), len(right)):
                        above[root(b)] = root(a)
                        out[0].append(a)
                        out[1].append(b)
        return table(_PAIRS_PA, out)

    return rows


def _links(pairs: DataFrame, sets: DataFrame, chunks: int, limit: Threshold) -> DataFrame:
    pairs = pairs.distinct().select("a", "b", chunk_of("a", chunks).alias("chunk"), chunk_of("b", chunks).alias("chunk_b"))
    sent = sets.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(_sent(chunks), _SENT)
    return settled(sets.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(_verified(limit), _PAIRS))


def _boundary(sizes: list, list_length: float, limit: Threshold) -> int:
    """The light size with the least cost: subsets of all sets up to it, lists of all others.

    sizes: (n, sets) for n up to MOST_LIGHT.  A set's lists cost its prefix times a list's mean length.
    """
    best, cost, least = 0, 0.0, 0.0
    for n, held in sorted(sizes):
        subsets = sum(math.comb(n, size) for size in subset_sizes(n, n, limit))
        cost += held * (subsets - float(limit.prefix(n)) * list_length)
        if cost < least:
            best, least = n, cost
    return best


def similar_components(docs: DataFrame, k: int = 3, percent: int = 90, separators: np.ndarray = SPACES) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the smallest doc_id reachable by links, itself included.

    Texts are lower-cased (A-Z).  Null, empty and wordless texts have an empty set and link with nothing.  Rows whose doc_id
    is null link with nothing and have a null component_id.  Rows with one doc_id and different texts are one node: each is
    compared for equal sets, the least text for similar ones too.
    """
    limit = Threshold(percent)
    own = settled(document_sets(docs, k, separators))
    # by the set's fingerprint: one class for each set, under its smallest document
    classes = own.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"))
    classes = settled(classes)
    dealt: Chunked = chunked(docs.where("doc_id is not null"))
    reps = classes.select(chunk_of("rep", dealt.chunks).alias("chunk"), "rep").distinct()
    counted = settled(
        dealt.grouped().cogroup(reps.groupBy("chunk")).applyInArrow(_frequency_rows(k, separators, dealt.buckets), _KEYS).groupBy("bucket").applyInArrow(_frequencies, _RARITY)
    )
    right = reps.select("chunk", "rep", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("extra"))
    right = right.unionByName(counted.select("chunk", F.lit(None).cast("long").alias("rep"), "bucket", "extra"))
    sizes = [tuple(r) for r in classes.where(F.col("n_shingles") <= MOST_LIGHT).groupBy("n_shingles").count().collect()]
    held, lists = counted.agg(F.sum("held"), F.sum("lists")).first()
    light = _boundary(sizes, (held or 0) / max(1, lists or 0), limit)
    posts = settled(
        dealt.grouped().cogroup(right.groupBy("chunk")).applyInArrow(_posting_rows(k, separators, dealt.buckets, light, limit), _POSTS)
    )
    sets, posts = posts.where("kind = 0").select("chunk", "doc_id", "shingles"), posts.where("kind > 0").select("kind", "key", "doc_id", "n", "at")
    first = _links(_near_pairs(posts, limit, light), sets, dealt.chunks, limit)
    known = components(first).select(F.col("id").alias("doc_id"), "component")
    labelled = posts.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    second = _links(_far_pairs(labelled, limit, light), sets, dealt.chunks, limit)
    # a document under several sets (a repeated doc_id) ties their classes together
    held = own.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "fp1", "fp2").distinct().join(classes, ["n_shingles", "fp1", "fp2"])
    ties = held.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    final = components(first.union(second).union(ties)).select(F.col("id").alias("rep"), "component")
    of_class = classes.join(final, "rep", "left").select("n_shingles", "fp1", "fp2", F.coalesce("component", "rep").alias("class_component"))
    out = own.join(of_class, ["n_shingles", "fp1", "fp2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("class_component", "doc_id").alias("component_id"))
