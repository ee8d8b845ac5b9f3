"""Canonical prefix codes of limited length over numpy arrays: lengths, packing, table-driven decoding from checkpoints."""

from __future__ import annotations

import numpy as np

#: Bits of a code at most, as long as there are no more than 2 ** LIMIT ids.
LIMIT = 16
#: Tokens from one checkpoint to the next.
SPACING = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code (0: the id doesn't occur), of least total length with none over limit: package-merge.

    The limit rises to what the number of ids needs."""
    used = np.flatnonzero(counts)
    n = len(used)
    out = np.zeros(len(counts), np.uint8)
    if n < 2:
        out[used] = 1
        return out
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = np.asarray(counts, np.int64)[order]
    merged, leaves = weights, []
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        ranked = np.argsort(np.concatenate([weights, packages]), kind="stable")
        merged = np.concatenate([weights, packages])[ranked]
        leaves.append(ranked < n)
    bits, take = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(leaves):
        own = int(leaf[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    bits[:take] += 1
    out[order] = bits
    return out


def _ranked(lengths: np.ndarray) -> np.ndarray:
    """The ids that have codes, by length and id."""
    used = np.flatnonzero(lengths)
    return used[np.argsort(lengths[used], kind="stable")]


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Each id's code, from its length alone: codes ascend by length and id."""
    ids = _ranked(lengths)
    out = np.zeros(len(lengths), np.uint64)
    if len(ids):
        bits = lengths[ids].astype(np.int64)
        spans = 1 << (int(bits[-1]) - bits)
        out[ids] = (np.cumsum(spans) - spans) >> (int(bits[-1]) - bits)
    return out


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, spacing: int = SPACING) -> tuple[bytes, np.ndarray]:
    """The codes of the ids one after the other in 32-bit words, and the bit at which every spacing-th of them begins."""
    if not len(ids):
        return b"", np.zeros(0, np.uint64)
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    word = starts >> 5
    placed = codes[ids] << (64 - (starts & 31) - bits).astype(np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    sums = np.add.reduceat(placed, first)
    out = np.zeros((int(ends[-1]) + 31 >> 5) + 1, np.uint64)
    out[word[first]] += sums >> np.uint64(32)
    out[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    return out[:-1].astype(">u4").tobytes(), starts[::spacing].astype(np.uint64)


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """id and length of the code that any `width` bits begin with, and width."""
    ids = _ranked(lengths)
    if not len(ids):
        return np.zeros(2, np.uint32), np.zeros(2, np.int64), 1
    bits = lengths[ids].astype(np.int64)
    width = int(bits[-1])
    table, steps = np.zeros(1 << width, np.uint32), np.zeros(1 << width, np.int64)
    spans = 1 << (width - bits)
    table[: spans.sum()] = np.repeat(ids, spans)
    steps[: spans.sum()] = np.repeat(bits, spans)
    return table, steps, width


def unpack(payload: bytes, n: int, checkpoints: np.ndarray, table: tuple[np.ndarray, np.ndarray, int], spacing: int = SPACING) -> np.ndarray:
    """The n ids: all checkpoints' stretches are decoded side by side, one id of each at a time."""
    ids, steps, width = table
    words = np.zeros(len(payload) // 4 + 2, np.uint64)
    words[:-2] = np.frombuffer(payload, ">u4")
    pairs = words[:-1] << np.uint64(32) | words[1:]
    at, last = checkpoints.astype(np.int64), 32 * (len(pairs) - 1)
    out = np.empty((min(spacing, n), len(at)), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(len(out)):
        code = pairs[at >> 5] >> (64 - width - (at & 31)).astype(np.uint64) & mask
        out[k] = ids[code]
        at = np.minimum(at + steps[code], last)
    return out.T.ravel()[:n]
