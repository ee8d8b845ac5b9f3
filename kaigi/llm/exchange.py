"""Packed exchange of hash keys: what holds for a key in the whole corpus, told back to every chunk of documents.

Documents are dealt into chunks by a hash of doc_id.  A chunk names each of its keys once, packed into one binary row per
key bucket; a bucket's task sorts the keys of all chunks and answers each chunk with one packed row.  A key that a third of
all documents hold is thus one entry per chunk, never one per document, and no key or link reaches the driver.  Chunk and
bucket counts follow the bytes of text, so a task's memory stays the same at any size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import settled
from .textbytes import U64

CHUNK_BYTES = 2_000_000
BUCKET_BYTES = 6_000_000
#: Stands for a null doc_id wherever ids are compared: it comes last.
NO_ID = np.iinfo(np.int64).max


#: A key with more rows than this, and than the DEAL-th part of all rows, is dealt over as many tasks as it has such parts.
MANY, DEAL = 1000, 1000


def salted(left: DataFrame, right: DataFrame, key: str, by: Column) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on key with a column `salt` to join on too.  left's rows of a frequent key are dealt by the hash
    `by`, and right's rows of such keys are copied to each of its salts; all others have salt 0.  A null key is never
    frequent.  Counting is one aggregation; at most DEAL keys are broadcast."""
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = max(MANY, total // DEAL)
    often = F.broadcast(settled(counts.where(F.col("n") > many).select(key, F.ceil(F.col("n") / many).cast("int").alias("salts"))))
    salts = F.coalesce("salts", F.lit(1))
    return (
        left.join(often, key, "left").withColumn("salt", F.pmod(by, salts).cast("int")).drop("salts"),
        right.join(often, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts"),
    )


#: Rows of a few numbers or names that may be broadcast: some 50 MB as a hash table.
FEW = 250_000


def sized(keys: DataFrame) -> DataFrame:
    """keys (rows of a few numbers or names, settled), broadcast if they are FEW or fewer; a join shuffles them otherwise."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


@dataclass(frozen=True)
class Chunked:
    """docs: chunk, doc_id, text and what else was asked for; the exchange by chunk is planned alike wherever it is used."""

    docs: DataFrame
    chunks: int
    buckets: int

    def grouped(self):
        return self.docs.groupBy("chunk")


def chunk_of(column: str, chunks: int):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(chunks)).cast("int")


def chunked(docs: DataFrame, text: str = "text") -> Chunked:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks, buckets = -(-size // CHUNK_BYTES) or 1, -(-size // BUCKET_BYTES) or 1
    return Chunked(docs.select(chunk_of("doc_id", chunks).alias("chunk"), "doc_id", F.col(text).alias("text")), chunks, buckets)


def ids_of(table: pa.Table, name: str = "doc_id") -> np.ndarray:
    """The column as int64, null as NO_ID."""
    return np.asarray(table.column(name).cast(pa.int64()).fill_null(int(NO_ID)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """From the upper 32 bits, so that sorted keys have sorted buckets."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def low_bytes(keys: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bytes of each key, as a matrix."""
    return np.ascontiguousarray(keys, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def from_low(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel().astype(U64)


def bucket_ranges(bucket: np.ndarray, buckets: int):
    """(bucket, from, to) of the buckets that occur; bucket ascends."""
    if not len(bucket):
        return
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(bucket)], strict=True):
        yield int(bucket[a]), int(a), int(b)


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """order that sorts the keys, starts of the runs of equal keys in that order, and each entry's run."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    run = np.empty(len(keys), np.int64)
    run[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), run


def table(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
