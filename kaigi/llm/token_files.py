r"""Token files (12): ids of whole texts in Huffman-coded blocks, in the order of doc_id.

Documents are dealt by ranges of (doc_id, hash of the text), so that no task holds all rows of one id, and encoded once by the
tokenizer; a task's ids wait in the checkpoint folder, packed into blocks of whole documents.  Counts of ids over the whole
corpus (one number for each id of the vocabulary, all that reaches the driver) give length-limited canonical codes.  Each
range becomes one file, written as a stream by the task that holds it under a name of its own and then renamed, so that a task
that runs again does no harm.

A file holds the lengths of all codes, from which the codes follow; then blocks; then where each block lies.  A block holds
its documents' ids and numbers of tokens, the bit at which every 256th token begins, and the codes; its checksum is verified.
With the code lengths any block can be read alone, and its stretches between checkpoints are decoded side by side.

Files are reached through pyarrow, so the folder is one that it can open (a shared mount, or hdfs://, s3://, gs://).

Null texts are empty: only the end id.  Rows without a doc_id come last and stay without.  Rows of equal doc_id follow by the
hash of their texts.  An empty table makes no file.  Other columns play no part, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.minutes import prefix_sums
from . import huffman
from .exchange import settled, sized
from .textbytes import U64, run_hashes

END = 0
#: A block ends with the document that takes it to so many tokens.
BLOCK_TOKENS = 1 << 20
#: Places of pieces whose ids a worker remembers, and how long the pieces may be that other texts keep.
PLACES, PIECE_CHARS = 1 << 21, 64
#: Bytes of text, about, that are encoded at once.
AT_ONCE = 1 << 20
#: How a byte-level vocabulary writes a blank.
BLANK = "Ġ"
#: Tasks that count ids: each returns up to one row for each id of the vocabulary.
COUNTERS = 512
SUFFIX = ".tokens"
_MAGIC, _VERSION = b"KTOK", 1
_PACKED = "part int, n_docs long, n_tokens long, heads binary, ids binary"
_BLOCKS = "file string, offset long, size long, at long, n_docs long, n_tokens long"
_DOCS = "file string, doc_id long, at long, ids binary"
_HEAD = np.dtype([("doc_id", "<i8"), ("known", "<u1"), ("n", "<i8")])
_FILE, _BLOCK, _ENTRY = "<4sIII", "<IQQQQII", "<QQQQQ"


def _classes() -> np.ndarray:
    """Of the first 256 characters: white space, letter, number or other, as byte-level tokenizers tell them apart."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(256)], np.uint8)
    out[[*range(9, 14), 0x20, 0x85, 0xA0]] = WHITE
    return out


WHITE, LETTER, NUMBER, OTHER = range(4)
_CLASSES = _classes()


def piece_starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that a byte-level tokenizer merges each alone.  data: Latin-1 characters of texts one after
    the other; first: where each begins (none is empty).

    A piece is a run of one class with the blank before it, white space up to the last character before something else, or an
    apostrophe with the letters of a short ending."""
    kind = _CLASSES[data]
    opens, closes = np.zeros(len(data) + 1, bool), np.zeros(len(data), bool)
    opens[first] = opens[-1] = True
    closes[:] = opens[1:]
    opens = opens[:-1]
    white = kind == WHITE
    changes = opens.copy()
    changes[1:] |= kind[1:] != kind[:-1]
    after_blank = np.zeros(len(data), bool)
    after_blank[1:] = (data[:-1] == 32) & ~opens[1:]
    last_white = np.zeros(len(data), bool)
    last_white[:-1] = white[:-1] & ~white[1:] & ~closes[:-1]
    starts = np.where(white, changes | last_white, changes & ~after_blank)
    marks = np.flatnonzero((data == 39) & changes & ~after_blank & ~closes)
    marks = marks[kind[marks + 1] == LETTER]
    if len(marks):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        a, b = padded[marks + 1], padded[marks + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ~closes[marks + 1] & (((b == 101) & ((a == 114) | (a == 118))) | ((a == 108) & (b == 108)))
        ends = marks + np.where(one, 2, 3)
        some = one | two
        starts[marks[some] + 1] = False
        ends = ends[some]
        ends = ends[~closes[ends - 1]]
        starts[ends[kind[ends] == LETTER]] = True
    return np.flatnonzero(starts)


class Encoder:
    """ids of texts, as the tokenizers library gives them without special tokens.

    A byte-level tokenizer splits texts before it merges, and merges each piece alone.  So each distinct piece goes through the
    library once in a while and is remembered: in texts of Latin-1 by a 64-bit hash, in a table where the newest piece of a place
    stays; in other texts by itself, of those cut at the white space alone.  Texts that name one of the tokenizer's added tokens,
    and other kinds of tokenizers, are encoded whole."""

    _WHITE = "\\t-\\r \\x85\\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    _COARSE = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?=[{_WHITE}][^{_WHITE}])|[{_WHITE}]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        before = made.get("pre_tokenizer") or {}
        self.by_pieces = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True) and not any(made.get(k) for k in ("normalizer", "truncation", "padding"))
        self.added = [a["content"] for a in made.get("added_tokens", ())]
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.blank[[i for t, i in vocabulary.items() if t.startswith(BLANK)]] = True
        self.known: dict[str, np.ndarray] = {}
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.at, self.long = np.zeros(PLACES, U64), np.zeros(PLACES, np.int32), np.zeros(PLACES, np.int32)
        self.held, self.used = np.zeros(3 * PLACES, np.uint32), 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of texts that together are as long as a worker can hold in pieces."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        latin, places = [], []
        for i, t in enumerate(texts):
            if not self.by_pieces or any(a in t for a in self.added):
                out[i] = self.whole([t])[0]
            elif t:
                try:
                    latin.append(t.encode("latin-1"))
                    places.append(i)
                except UnicodeEncodeError:
                    out[i] = self._by_dictionary(self._COARSE.findall(t))
        if latin:
            for i, ids in zip(places, self._by_hashes(latin), strict=True):
                out[i] = ids
        return out

    def _by_dictionary(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > PLACES // 16:
            self.known = {}
        new = list(set(pieces).difference(self.known))
        self.known.update(zip(new, self._learned(new), strict=True))
        out = np.concatenate([self.known[p] for p in pieces])
        for p in new:
            if len(p) > PIECE_CHARS:
                del self.known[p]
        return out

    def _by_hashes(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        starts = piece_starts(data, bounds[:-1])
        ends = np.append(starts[1:], len(data))
        hashes = run_hashes(data, starts, ends)
        if self.used > 2 * PLACES:
            self._forget()
        place = (hashes & U64(PLACES - 1)).astype(np.int64)
        at, long = self.at[place].astype(np.int64), self.long[place].astype(np.int64)
        missed = np.flatnonzero(self.hashes[place] != hashes)
        if len(missed):
            new, one, of = np.unique(hashes[missed], return_index=True, return_inverse=True)
            one = missed[one]
            ids = self._learned([data[a:b].tobytes().decode("latin-1") for a, b in zip(starts[one], ends[one], strict=True)])
            sizes = np.array([len(x) for x in ids])
            if self.used + sizes.sum() > len(self.held):  # one text of long pieces; the next call forgets them
                self.held = np.concatenate([self.held, np.zeros(int(sizes.sum()), np.uint32)])
            begins = self.used + np.cumsum(sizes) - sizes
            self.held[self.used : self.used + sizes.sum()] = np.concatenate(ids)
            self.used += int(sizes.sum())
            slot = (new & U64(PLACES - 1)).astype(np.int64)
            self.hashes[slot] = new
            # Of several for one place the last stays, in all three arrays alike.
            self.at[slot], self.long[slot] = begins, sizes
            at[missed], long[missed] = begins[of], sizes[of]
        ends_of = np.cumsum(long)
        ids = self.held[np.repeat(at - ends_of + long, long) + np.arange(ends_of[-1])]
        cuts = np.concatenate([[0], ends_of])[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learned(self, pieces: list[str]) -> list[np.ndarray]:
        """ids of pieces from the library; those of a blank and no more white space go through it joined."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        joined = [i for i, p in enumerate(pieces) if p[0] == " " and len(p) <= PIECE_CHARS and p[-1] != " " and len(p.split()) == 1]
        for a in range(0, len(joined), 200):
            # Each of these begins with the only id of its own that begins with a blank.
            some = joined[a : a + 200]
            ids = self.whole(["".join([pieces[i] for i in some])])[0]
            cuts = np.flatnonzero(self.blank[ids])
            if len(cuts) == len(some):
                bounds = np.append(cuts, len(ids)).tolist()
                for i, b, c in zip(some, bounds, bounds[1:], strict=False):
                    out[i] = ids[b:c]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.whole([pieces[i] for i in rest]), strict=True):
            out[i] = x
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """One for each worker process, with what it remembers from its earlier tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenised(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Blocks of documents in order: part (of the order), n_docs, n_tokens, heads, ids, written to the checkpoint folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = (F.asc_nulls_last("doc_id"), F.col("tie"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def packed(batches):
        encoder, squeeze, part = encoder_of(path), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId()
        last, heads, ids, held = np.array([end], np.uint32), [], [], 0

        def block():
            found = np.array(heads, _HEAD)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(heads)], pa.int64()), pa.array([held]), pa.array([found.tobytes()]), pa.array([squeeze.compress(np.concatenate(ids).astype("<u4").tobytes())])], ["part", "n_docs", "n_tokens", "heads", "ids"])

        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // AT_ONCE
            bounds = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:], strict=False):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                for doc_id, own in zip(batch.column(0).slice(a, b - a).to_pylist(), encoder.encode(texts), strict=True):
                    n = len(own) + 1
                    heads.append((doc_id or 0, doc_id is not None, n))
                    ids += (own, last)
                    held += n
                    if held >= BLOCK_TOKENS:
                        yield block()
                        heads, ids, held = [], [], 0
        if heads:
            yield block()

    return settled(ordered.mapInArrow(packed, _PACKED))


def _ids(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), "<u4")


def id_counts(blocks: DataFrame) -> np.ndarray:
    """How often each id occurs; as long as the largest id asks."""

    def counted(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                n = np.bincount(_ids(blob.as_py()))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    found = blocks.select("ids").coalesce(COUNTERS).mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(max(found.column("id").to_pylist(), default=-1) + 1, np.int64)
    out[found.column("id").to_numpy()] = found.column("n").to_numpy()
    return out


def located(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system that pyarrow opens an address in, and the path within it."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(uri) if "://" in uri else (pa.fs.LocalFileSystem(), uri)


def block_bytes(at: int, heads: np.ndarray, ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """A block as it lies in a file; at: the tokens before it in the file."""
    payload, checkpoints = huffman.pack(ids, codes, lengths)
    body = heads.tobytes() + checkpoints.astype("<u8").tobytes() + payload
    return struct.pack(_BLOCK, zlib.crc32(body), at, len(heads), len(ids), len(payload), len(checkpoints), huffman.SPACING) + body


def from_block(block: bytes, table) -> tuple[int, np.ndarray, np.ndarray]:
    """at, heads and ids of a block; ValueError where it is damaged."""
    crc, at, n_docs, n_tokens, n_payload, n_checkpoints, spacing = struct.unpack_from(_BLOCK, block)
    body = memoryview(block)[struct.calcsize(_BLOCK) :]
    if zlib.crc32(body) != crc:
        raise ValueError("a block of tokens is damaged")
    cut = n_docs * _HEAD.itemsize
    heads, checkpoints = np.frombuffer(body[:cut], _HEAD), np.frombuffer(body[cut : cut + 8 * n_checkpoints], "<u8")
    return at, heads, huffman.unpack(bytes(body[cut + 8 * n_checkpoints :][:n_payload]), n_tokens, checkpoints, table, spacing)


def write_files(blocks: DataFrame, lengths: np.ndarray, folder: str) -> int:
    """One file for each part of the blocks; the number of files."""
    codes, squeezed = huffman.canonical_codes(lengths), zlib.compress(lengths.tobytes())
    header = struct.pack(_FILE, _MAGIC, _VERSION, len(lengths), len(squeezed)) + squeezed

    def written(batches):
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    store, root = located(folder)
                    name = f"part-{row['part']:08d}{SUFFIX}"
                    own = f"{root}/.{name}-{uuid.uuid4().hex}"
                    out, entries, offset, at = store.open_output_stream(own), [], len(header), 0
                    out.write(header)
                block = block_bytes(at, np.frombuffer(row["heads"], _HEAD), _ids(row["ids"]), codes, lengths)
                out.write(block)
                entries.append(struct.pack(_ENTRY, offset, len(block), at, row["n_docs"], row["n_tokens"]))
                offset, at = offset + len(block), at + row["n_tokens"]
        if out is not None:
            out.write(b"".join(entries) + struct.pack("<Q4s", len(entries), _MAGIC))
            out.close()
            store.move(own, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], ["n"])

    return blocks.mapInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def encode_corpus(docs: DataFrame, path: str, folder: str, end: int = END) -> int:
    """Writes the token files of documents (doc_id, text) to a folder; the number of files.  path: of the tokenizer."""
    blocks = tokenised(docs, path, end)
    return write_files(blocks, huffman.code_lengths(id_counts(blocks)), folder)


def scan_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """file, offset, size, at (tokens before it in its file), n_docs, n_tokens of the blocks of a folder's files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path")

    def listed(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = located(path)
                with store.open_input_file(place) as f:
                    end = f.size()
                    n, magic = struct.unpack("<Q4s", f.read_at(12, end - 12))
                    if magic != _MAGIC:
                        raise ValueError(f"{path} holds no tokens")
                    found = np.frombuffer(f.read_at(n * struct.calcsize(_ENTRY), end - 12 - n * struct.calcsize(_ENTRY)), "<i8").reshape(n, 5)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n), *(pa.array(found[:, k]) for k in range(5))], [c.split()[0] for c in _BLOCKS.split(", ")])

    return files.mapInArrow(listed, _BLOCKS)


def read_documents(blocks: DataFrame) -> DataFrame:
    """file, doc_id, at (tokens before it in the file), ids (little-endian 32-bit integers) of the documents in blocks."""

    def read(batches):
        opened, f, table = None, None, None
        for batch in batches:
            for path, offset, size in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")), strict=True):
                if path != opened:
                    store, place = located(path)
                    opened, f = path, store.open_input_file(place)
                    magic, version, _, squeezed = struct.unpack(_FILE, f.read_at(struct.calcsize(_FILE), 0))
                    if (magic, version) != (_MAGIC, _VERSION):
                        raise ValueError(f"{path} holds no tokens of version {_VERSION}")
                    table = huffman.decoding_table(np.frombuffer(zlib.decompress(f.read_at(squeezed, struct.calcsize(_FILE))), np.uint8))
                at, heads, ids = from_block(f.read_at(size, offset), table)
                ends = np.cumsum(heads["n"])
                bounds = pa.py_buffer((4 * np.concatenate([[0], ends])).astype("<i8").tobytes())
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(heads), [None, bounds, pa.py_buffer(ids.astype("<u4").tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(heads)), pa.array(heads["doc_id"], mask=heads["known"] == 0), pa.array(at + ends - heads["n"]), blobs], ["file", "doc_id", "at", "ids"])

    return blocks.select("file", "offset", "size").mapInArrow(read, _DOCS)


def decode_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian 32-bit integers) of the files of a folder."""
    blocks = settled(scan_blocks(spark, folder))
    starts = settled(prefix_sums(blocks.groupBy("file").agg(F.sum("n_tokens").alias("n")), "file", "n").select("file", "before"))
    return read_documents(blocks).join(sized(starts), "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "ids")


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of decode_corpus' documents."""
    return documents.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
