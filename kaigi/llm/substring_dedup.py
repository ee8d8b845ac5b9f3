"""Substring dedup (9): fixed-block anchors, probed by every rolling window, extended to maximal exact repeats.

1. Anchors: the non-overlapping blocks of b = (window + 1) // 2 words of every document are the index; every rolling
   window of b words of every document probes it.  Keys travel packed (exchange.py).  A repeat of `window` words always
   holds one whole block of the document it repeats, so no repeat is missed.
2. Extension: only words around hits are looked at again.  Their windows of `window` words are compared over the corpus by
   two hashes, 64 bits of the first and the bucket (about log2 of the corpus over BUCKET_BYTES) of the second, keeping the smallest doc_id of each; neighbouring repeated windows merge into maximal repeats.
3. Every word covered by a window that a smaller doc_id holds too goes.

Windows are judged on the input.  Null and empty texts have no words.  A null doc_id comes after all others; rows with the
same doc_id don't remove each other's words.  Columns besides doc_id and text are left out of the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exchange import Chunked, bucket_of, bucket_ranges, chunked, from_low, groups, ids_of, low_bytes, settled, table
from .textbytes import U64, Texts, ngrams

WINDOW = 13
_KEYS = "chunk int, bucket int, keys binary, extra binary"
_KEYS_PA = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary())])
_BITS = "chunk int, kind int, bucket int, bits binary"
_BITS_PA = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])
_SPANS = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
_SPANS_PA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())]
)


class _Anchors:
    """Rolling block-size windows of a chunk and their distinct keys."""

    def __init__(self, texts: Texts, size: int):
        self.words = texts.hashes()
        keys = ngrams(self.words, size)
        n = len(keys)
        self.at = np.flatnonzero(texts.doc[:n] == texts.doc[size - 1 :]) if n else np.zeros(0, np.int64)
        keys = keys[self.at]
        order, starts, self.run = groups(keys)
        self.keys = keys[order[starts]] if len(keys) else keys
        self.order, self.starts = order, starts

    def flags(self, texts: Texts, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Per key: is it a block of some document here; do two documents here hold it."""
        block, several = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        if len(self.keys):
            inside = self.at - texts.first[texts.doc[self.at]]
            block[self.run[inside % size == 0]] = True
            holder = ids[texts.doc[self.at[self.order]]]
            several = np.minimum.reduceat(holder, self.starts) != np.maximum.reduceat(holder, self.starts)
        return block, several


def _anchor_rows(size: int, buckets: int):
    def rows(chunk: pa.Table) -> pa.Table:
        texts = Texts(chunk.column("text"))
        anchors = _Anchors(texts, size)
        block, several = anchors.flags(texts, ids_of(chunk), size)
        low, out, at = low_bytes(anchors.keys, 5), [[], [], [], []], chunk.column("chunk")[0].as_py()
        for bucket, a, b in bucket_ranges(bucket_of(anchors.keys, buckets), buckets):
            for column, x in zip(out, (at, bucket, low[a:b].tobytes(), np.packbits(np.stack([block[a:b], several[a:b]])).tobytes()), strict=True):
                column.append(x)
        return table(_KEYS_PA, out)

    return rows


def _gathered(bucket: pa.Table, width: int):
    blobs = bucket.column("keys").to_pylist()
    keys = from_low(b"".join(blobs), width) if width < 8 else np.frombuffer(b"".join(blobs), "<u8").astype(U64)
    return keys, np.cumsum([0, *(len(x) // width for x in blobs)])


def _bits(bucket: pa.Table, kind: int, bounds: np.ndarray, hit: np.ndarray) -> pa.Table:
    out: list[list] = [[], [], [], []]
    for chunk, b, start, end in zip(bucket.column("chunk").to_pylist(), bucket.column("bucket").to_pylist(), bounds[:-1], bounds[1:], strict=True):
        if hit[start:end].any():
            for column, x in zip(out, (chunk, kind, b, np.packbits(hit[start:end]).tobytes()), strict=True):
                column.append(x)
    return table(_BITS_PA, out)


def _anchor_hits(bucket: pa.Table) -> pa.Table:
    """A key is hit if it is a block somewhere and occurs in another document too."""
    keys, bounds = _gathered(bucket, 5)
    flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=2 * int(n)).reshape(2, -1) for x, n in zip(bucket.column("extra").to_pylist(), np.diff(bounds), strict=True)]
    block, several = np.concatenate(flags, axis=1)
    order, starts, run = groups(keys)
    held = np.diff([*starts, len(keys)])
    hit = np.logical_or.reduceat(block[order], starts) & ((held > 1) | np.logical_or.reduceat(several[order], starts).astype(bool))
    return _bits(bucket, 1, bounds, hit[run])


def _answers(rows: pa.Table, kind: int, keys: np.ndarray, bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that came back, in the order of this chunk's keys."""
    found = {b: x for k, b, x in zip(rows.column("kind").to_pylist(), rows.column("bucket").to_pylist(), rows.column("bits").to_pylist(), strict=True) if k == kind}
    out = np.zeros(len(keys), bool)
    for b, start, end in bucket_ranges(bucket, buckets):
        if b in found:
            out[start:end] = np.unpackbits(np.frombuffer(found[b], np.uint8), count=end - start).astype(bool)
    return out


class _Windows:
    """The windows around hits, their distinct keys and each key's smallest doc_id in the chunk."""

    def __init__(self, chunk: pa.Table, answers: pa.Table, window: int, size: int, buckets: int):
        self.texts, self.ids = Texts(chunk.column("text")), ids_of(chunk)
        anchors = _Anchors(self.texts, size)
        hit = _answers(answers, 1, anchors.keys, bucket_of(anchors.keys, buckets), buckets)
        n = len(anchors.words)
        near = np.zeros(n + 1, np.int64)
        near[anchors.at[hit[anchors.run]]] = 1
        near = np.concatenate([[0], np.cumsum(near)])
        last = max(0, n - window + 1)
        at = np.arange(last)
        self.at = at[(self.texts.doc[:last] == self.texts.doc[window - 1 : window - 1 + last]) & (near[at + window - size + 1] > near[at])]
        first, second = (ngrams(anchors.words, window, m)[self.at] for m in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25))
        bucket = bucket_of(second, buckets)
        order = np.lexsort((first, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        self.run = np.empty(len(order), np.int64)
        self.run[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        self.keys, self.bucket = first[order[starts]], bucket[order[starts]]
        holder = self.ids[self.texts.doc[self.at[order]]]
        self.least = np.minimum.reduceat(holder, starts) if len(starts) else holder


def _window_rows(window: int, size: int, buckets: int):
    def rows(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if chunk.num_rows and answers.num_rows:
            w, at = _Windows(chunk, answers, window, size, buckets), chunk.column("chunk")[0].as_py()
            for bucket, a, b in bucket_ranges(w.bucket, buckets):
                for column, x in zip(out, (at, bucket, w.keys[a:b].astype("<u8").tobytes(), w.least[a:b].astype("<i8").tobytes()), strict=True):
                    column.append(x)
        return table(_KEYS_PA, out)

    return rows


def _window_hits(bucket: pa.Table) -> pa.Table:
    """A chunk's key is hit if another chunk holds it under a smaller doc_id."""
    keys, bounds = _gathered(bucket, 8)
    least = np.frombuffer(b"".join(bucket.column("extra").to_pylist()), "<i8")
    order, starts, run = groups(keys)
    return _bits(bucket, 2, bounds, np.minimum.reduceat(least[order], starts)[run] < least)


def _removed(window: int, size: int, buckets: int):
    def rows(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if not chunk.num_rows:
            return table(_SPANS_PA, out)
        if answers.num_rows:
            w = _Windows(chunk, answers, window, size, buckets)
            texts, known = w.texts, _answers(answers, 2, w.keys, w.bucket, buckets)
            gone = w.at[known[w.run] | (w.least[w.run] < w.ids[texts.doc[w.at]])]
        else:
            texts, gone = Texts(chunk.column("text")), np.zeros(0, np.int64)
        steps = np.zeros(len(texts.starts) + 1, np.int64)
        np.add.at(steps, gone, 1)
        np.add.at(steps, gone + window, -1)
        cover = np.cumsum(steps)[:-1] > 0
        for i, doc_id in enumerate(chunk.column("doc_id").to_pylist()):
            a, b = texts.first[i], texts.first[i + 1]
            words, here = texts.raw(i).split(), cover[a:b]
            spans, kept = [], words
            if here.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], here.astype(np.int8), [0]])))
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2], strict=True)]
                kept = [x for x, drop in zip(words, here.tolist(), strict=True) if not drop]
            for column, x in zip(out, (doc_id, b - a, int(here.sum()), spans, b" ".join(kept).decode("utf-8", "replace")), strict=True):
                column.append(x)
        return table(_SPANS_PA, out)

    return rows


def _digest_batches(batches):
    for batch in batches:
        kept = batch.column("kept_text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), batch.column("n_removed"), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, spans (the maximal repeats that go, as word ranges), kept_text (the other words, joined
    by one space), one row per row of `docs`; see the module's text for nulls and repeated ids."""
    if window < 2:
        raise ValueError("window must be 2 words or more")
    size = (window + 1) // 2
    dealt: Chunked = chunked(docs)
    anchor_hits = settled(dealt.grouped().applyInArrow(_anchor_rows(size, dealt.buckets), _KEYS).groupBy("bucket").applyInArrow(_anchor_hits, _BITS))
    window_keys = dealt.grouped().cogroup(anchor_hits.groupBy("chunk")).applyInArrow(_window_rows(window, size, dealt.buckets), _KEYS)
    window_hits = settled(window_keys.groupBy("bucket").applyInArrow(_window_hits, _BITS))
    answers = anchor_hits.unionByName(window_hits)
    return dealt.grouped().cogroup(answers.groupBy("chunk")).applyInArrow(_removed(window, size, dealt.buckets), _SPANS)


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return removed.select("doc_id", "n_words", "n_removed", "kept_text").mapInArrow(_digest_batches, "doc_id long, n_words long, n_removed long, kept_sha256 string")
