r"""Line dedup (10): range-partitioned line hashes, streamed in order of hash, document and position.

Lines are hashed where their document is; only hashes travel.  They are dealt by ranges of (hash, document), so that one
line's run may span many partitions, and sorted by hash, document and position.  A stream over each partition counts the
documents of every run and holds back no more rows than decide it; runs that touch a partition's edge are decided by a join
with the edges' counts, of which there are two per partition.  What comes back is one compressed bitmap of the lines to keep for
each document that loses any.

A line's key is the line without [\x20\x09-\x0D] at both ends and with A-Z lower-cased.  Null and empty texts are one empty
line; keys under `min_chars` code points always stay.  Rows with the same doc_id count as one document but keep their own
bitmaps; a null doc_id is a document of its own.  Other columns are carried along unchanged, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exchange import NO_ID, settled, sized
from .textbytes import LOWER, SPACES, batch_slices, run_hashes

MIN_DOCS = 10
MIN_CHARS = 1
_LINES = "hash long, check long, doc_id long, row long, line int, lines int"
_RUNS = "kind int, hash long, check long, docs long, doc_id long, row long, line int, lines int, first boolean"
_RUNS_PA = pa.schema(
    [("kind", pa.int32()), ("hash", pa.int64()), ("check", pa.int64()), ("docs", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("line", pa.int32()), ("lines", pa.int32()), ("first", pa.bool_())]
)


def line_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts and ends of the lines of every text, and offsets of each text's lines; an empty text is one empty line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    first = np.searchsorted(breaks, bounds[:-1]) + np.arange(len(bounds) - 1)
    return starts, ends, np.concatenate([first, [len(starts)]])


def stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bounds without white space at both ends; start = end where nothing is left."""
    inside = np.flatnonzero(~SPACES[data])
    after, before = np.searchsorted(inside, starts), np.searchsorted(inside, ends)
    some = after < before
    inside = np.append(inside, 0)
    return np.where(some, inside[np.minimum(after, len(inside) - 1)], starts), np.where(some, inside[before - 1] + 1, starts)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _line_rows(min_chars: int):
    def rows(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text"):
                data, bounds = _bytes_of(batch.column(1))
                starts, ends, first = line_bounds(data, bounds)
                starts, ends = stripped(data, starts, ends)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                some = (points[ends] - points[starts] >= min_chars) & (ends > starts)
                starts, ends, data = starts[some], ends[some], LOWER[data]
                at = np.repeat(np.arange(batch.num_rows), np.diff(first))
                line = (np.arange(len(at)) - first[at])[some]
                hashes = run_hashes(data, starts, ends)
                check = run_hashes(data, starts, ends, seed=1)
                take = pa.array(at[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(check.view(np.int64)), batch.column(0).take(take), batch.column(2).take(take), pa.array(line.astype(np.int32)), pa.array(np.diff(first)[at[some]].astype(np.int32))],
                    names=["hash", "check", "doc_id", "row", "line", "lines"],
                )

    return rows


def _decided(min_docs: int):
    """Over one sorted partition.  kind 0: a line of a run that is decided here (first: the run's first occurrence, in every row that is equal there);
    1: a run at an edge of the partition, with the documents and the first occurrence it has here; 2: its undecided lines."""

    def out(kind, key, docs, columns, first=None):
        n = len(columns[0])
        values = [[kind] * n, [key[0]] * n, [key[1]] * n, [docs] * n, *columns, [False] * n if first is None else first]
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, _RUNS_PA, strict=True)], schema=_RUNS_PA)

    def rows(batches):
        key, docs, last, edge, held, first = None, 0, None, True, [], None

        def place(columns):
            return [np.asarray(columns[0].fill_null(int(NO_ID))), *map(np.asarray, columns[1:])]

        def dropped(parts):
            for part in parts:
                yield out(0, key, 0, part, np.logical_and.reduce([x == y[0] for x, y in zip(place(part), place(first), strict=True)]))

        for batch in batches:
            if not batch.num_rows:
                continue
            h, c, columns = np.asarray(batch.column(0)), np.asarray(batch.column(1)), [batch.column(i) for i in (2, 3, 4, 5)]
            d = np.asarray(columns[0].fill_null(int(NO_ID)))
            cuts = np.flatnonzero((h[1:] != h[:-1]) | (c[1:] != c[:-1])) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(h)]])
            fresh = np.ones(len(d), np.int64)
            fresh[1:] = d[1:] != d[:-1]
            fresh[cuts] = 1
            upto = np.concatenate([[0], np.cumsum(fresh)])
            count = upto[stops] - upto[starts]
            # runs that lie inside the batch are decided at once; its first and last run may go on outside
            inner = np.flatnonzero(count >= min_docs)
            inner = inner[(inner > 0) & (inner < len(starts) - 1)]
            if len(inner):
                at = np.concatenate([np.arange(starts[i], stops[i]) for i in inner])
                least = np.repeat(starts[inner], stops[inner] - starts[inner])
                take, marks = pa.array(at), np.logical_and.reduce([x[at] == x[least] for x in place(columns)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(at), np.int32)), batch.column(0).take(take), batch.column(1).take(take), pa.array(np.zeros(len(at), np.int64)), *(x.take(take) for x in columns), pa.array(marks)],
                    schema=_RUNS_PA,
                )
            for i in sorted({0, len(starts) - 1}):
                a, b = int(starts[i]), int(stops[i])
                if (int(h[a]), int(c[a])) != key:
                    if key is not None and edge:
                        yield out(1, key, docs, first)
                    edge, key = key is None, (int(h[a]), int(c[a]))
                    docs, last, held, first = 0, None, [], [x.slice(a, 1) for x in columns]
                part = [x.slice(a, b - a) for x in columns]
                decided = docs >= min_docs
                docs += int(count[i]) - (last == int(d[a]))
                last = int(d[b - 1])
                if edge:
                    yield out(2, key, 0, part)
                elif decided:
                    yield from dropped([part])
                else:
                    held.append(part)
                    if docs >= min_docs:
                        yield from dropped(held)
                        held = []
        if key is not None:
            yield out(1, key, docs, first)
            for part in held:
                yield out(2, key, 0, part)

    return rows


def _bitmap(gone: F.Column, lines: F.Column) -> F.Column:
    @F.arrow_udf(T.BinaryType())
    def packed(gone: pa.Array, lines: pa.Array) -> pa.Array:
        blobs = []
        for x, n in zip(gone.to_pylist(), lines.to_pylist(), strict=True):
            keep = np.ones(n, bool)
            keep[x] = False
            blobs.append(zlib.compress(np.packbits(keep).tobytes()))
        return pa.array(blobs, pa.binary())

    return packed(gone, lines)


def row_key(docs: DataFrame) -> F.Column:
    """Tells rows of one doc_id apart; the same wherever and whenever it is computed."""
    return F.xxhash64(docs["text"])


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """doc_id, row, keep: for each document that loses lines, a zlib-compressed bitmap with a bit for each of its lines, set
    where it stays; documents that keep all lines have no row.  keep_first: the line's first occurrence, by document and
    position, stays."""
    # written once, as the ranges are found from a sample of it before it is dealt
    lines = settled(docs.select("doc_id", "text", row_key(docs).alias("row")).mapInArrow(_line_rows(min_chars), _LINES))
    order = ["hash", "check", F.col("doc_id").asc_nulls_last(), "row", "line"]
    runs = settled(lines.repartitionByRange(*order[:3]).sortWithinPartitions(*order).mapInArrow(_decided(min_docs), _RUNS))
    place = F.struct(F.coalesce("doc_id", F.lit(int(NO_ID))).alias("d"), F.col("row").alias("r"), F.col("line").alias("l"))
    # of each partition the first and last run, so two rows for each at most
    edges = settled(runs.where("kind = 1").groupBy("hash", "check").agg(F.sum("docs").alias("total"), F.min(place).alias("least")).where(F.col("total") >= min_docs))
    open_runs = runs.where("kind = 2").drop("docs", "first").join(sized(edges), ["hash", "check"])
    open_runs = open_runs.withColumn("first", place == F.col("least"))
    dropped = runs.where("kind = 0").select("doc_id", "row", "line", "lines", "first").unionByName(open_runs.select("doc_id", "row", "line", "lines", "first"))
    # kind 0 rows of a run that goes on beyond an edge still have their first occurrence here
    if keep_first:
        dropped = dropped.where(~F.col("first"))
    bitmaps = dropped.groupBy("doc_id", "row").agg(F.collect_list("line").alias("gone"), F.max("lines").alias("lines"))
    return bitmaps.select("doc_id", "row", _bitmap(F.col("gone"), F.col("lines")).alias("keep"))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, name: str) -> DataFrame:
    """docs with each row's bitmap (null: nothing goes) in a column of the given name."""
    right = bitmaps.select(F.col("doc_id").alias(f"{name}_id"), F.col("row").alias(f"{name}_row"), F.col("keep").alias(name))
    on = docs["doc_id"].eqNullSafe(right[f"{name}_id"]) & (row_key(docs) == right[f"{name}_row"])
    return docs.join(right, on, "left").drop(f"{name}_id", f"{name}_row")


def _parts(text: str | None, keep: bytes | None) -> tuple[list[str], int]:
    lines = (text or "").split("\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines)).tolist()
    return [x for x, stays in zip(lines, bits, strict=True) if stays], len(lines)


@F.arrow_udf(T.StringType())
def kept_text(text: pa.Array, keep: pa.Array) -> pa.Array:
    """The lines that stay, joined by \\n; a text that loses none comes back as it is, null too."""
    return pa.array([t if x is None else "\n".join(_parts(t, x)[0]) for t, x in zip(text.to_pylist(), keep.to_pylist(), strict=True)], pa.string())


@F.arrow_udf(T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]))
def kept_digest(text: pa.Array, keep: pa.Array) -> pa.Array:
    out = []
    for t, x in zip(text.to_pylist(), keep.to_pylist(), strict=True):
        kept, n = _parts(t, x)
        out.append({"n_lines": n, "n_dropped": n - len(kept), "kept_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest()})
    return pa.array(out, pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]))


def free_name(docs: DataFrame, wanted: str) -> str:
    taken = {x.lower() for x in docs.columns}
    while any(x.startswith(wanted) for x in taken):
        wanted += "_"
    return wanted


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """docs with the repeated lines taken out of text; every other column as it was."""
    name = free_name(docs, "keep_bits")
    joined = with_bitmaps(docs, keep_bitmaps(docs, min_docs, min_chars, keep_first), name)
    return joined.select(*(kept_text("text", name).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))


def digest(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    docs = docs.select("doc_id", "text")
    return with_bitmaps(docs, bitmaps, "keep_bits").select("doc_id", kept_digest("text", "keep_bits").alias("x")).select("doc_id", "x.*")
