"""Word and line hashing over the UTF-8 bytes of Arrow string columns, in numpy.

Everything works on whole texts.  A word is a maximal run of bytes outside the separator table; hashes are 64-bit and do
not depend on the process, the batch or the machine.  Null texts count as texts without words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of [\x20\x09-\x0D].
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(9, 14)]] = True
#: Every ASCII byte that is neither letter nor digit.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Texts are hashed in runs of about so many bytes, so that temporaries stay small beside one long text.
BLOCK = 1 << 20

_STEP = U64(0x9E3779B97F4A7C15)
_PLACES: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits of the result."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _places(n: int, seed: int) -> np.ndarray:
    """A random-looking key for each of the first n blocks of a run."""
    if len(_PLACES.get(seed, ())) < n:
        with np.errstate(over="ignore"):
            _PLACES[seed] = mix(np.arange(1, max(2 * n, 64) + 1, dtype=U64) * _STEP + U64(seed))
    return _PLACES[seed]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each run; the runs ascend and don't overlap, empty runs hash alike.

    Runs are read in blocks of 8 bytes, each mixed with a key of its place before the sum, so no pattern of bytes is hidden
    by arithmetic as with a polynomial; runs of one length up to 8 bytes never collide.  Other seeds give independent hashes.
    """
    out = np.empty(len(starts), U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
            s, sizes = starts[at:to], ends[at:to] - starts[at:to]
            blocks = (sizes + 7) >> 3
            total = np.concatenate([[0], np.cumsum(blocks)])
            place = np.arange(total[-1]) - np.repeat(total[:-1], blocks)
            values = eight[np.repeat(s, blocks) + 8 * place]
            left = np.minimum(np.repeat(sizes, blocks) - 8 * place, 8).astype(U64)
            values &= ~U64(0) >> (U64(64) - U64(8) * left)
            values = mix(values ^ _places(int(blocks.max(initial=0)), seed)[place])
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
            out[at:to] = mix(sums[total[1:]] - sums[total[:-1]] + sizes.astype(U64) * U64(0xD6E8FEB86659FD93))
            at = to
    return out


class Texts:
    """Texts of one Arrow column: bytes, bounds and words.

    data: the bytes; bounds: n + 1 offsets into them; starts, ends: of the words; doc: each word's row; first: n + 1
    offsets into the words.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, separators: np.ndarray = SPACES, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        column = column.cast(pa.large_binary())
        self.n = len(column)
        bounds = np.frombuffer(column.buffers()[1], np.int64, self.n + 1, column.offset * 8) if self.n else np.zeros(1, np.int64)
        raw = column.buffers()[2] if self.n else None
        raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.null = np.asarray(column.is_null()) if column.null_count else np.zeros(self.n, bool)
        if lower:
            self.data = LOWER[self.data]
        self._separators = separators
        self._split()

    def _split(self) -> None:
        inside = ~self._separators[self.data]
        begins, finishes = inside.copy(), inside.copy()
        if len(inside):
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            edges = self.bounds[1:-1]
            edges = edges[(edges > 0) & (edges < len(inside))]
            begins[edges] = inside[edges]
            finishes[edges - 1] = inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def ngrams(hashes: np.ndarray, k: int, multiplier: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """A hash for each k consecutive words, over document bounds too: callers leave those out."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, U64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * U64(multiplier) + hashes[j : j + n]
        return mix(out)


def slices(bounds: np.ndarray, size: int = BLOCK):
    """Row ranges of about `size` bytes; one row at least."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = to


def batch_slices(batch: pa.RecordBatch, text: str, size: int = BLOCK):
    """The batch in slices of about `size` bytes of text."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    for a, b in slices(bounds, size):
        yield batch.slice(a, b - a)
