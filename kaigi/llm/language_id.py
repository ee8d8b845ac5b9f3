"""Language identification (6): a bidirectional gated recurrent network over bytes, trained in numpy.

Bytes are embedded straight into the gates' inputs; one recurrent layer reads forwards, one backwards, and every position
gets a language distribution from both states.  A document's score is the mean of its positions' distributions.  Training is
backpropagation through time on a bounded sample of labelled rows; prediction reads every byte of every text, cut into runs
of RUN bytes whose states start anew and which are put through the network side by side.

Gates use clipped linear units, sigmoid(x) ~ clip(x / 4 + 1 / 2, 0, 1) and tanh(x) ~ clip(x, -1, 1), in training and in use.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import LOWER, batch_slices

#: Labelled rows that training looks at, at most: the SAMPLE_ROWS smallest by a hash of doc_id, and for each of them
#: SAMPLE_BYTES from a place chosen by that hash.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 128
HIDDEN = 6
RUN = 128
_SLICE = 1 << 20
_F = np.float32


@dataclass
class Network:
    """T: byte -> inputs of update, reset and candidate, by direction; U: recurrent weights; V, c: states -> languages."""

    languages: list[str]
    T: list[np.ndarray]
    U: list[np.ndarray]
    V: np.ndarray
    c: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int, seed: int) -> Network:
        r = np.random.RandomState(seed)
        normal = lambda *s: r.normal(0, 1, s).astype(_F)
        T = [normal(3 * hidden, 257) * _F(0.5) for _ in range(2)]
        U = [normal(3 * hidden, hidden) * _F(0.5 / np.sqrt(hidden)) for _ in range(2)]
        return cls(languages, T, U, normal(len(languages), 2 * hidden) * _F(0.3), np.zeros(len(languages), _F))

    def states(self, data: np.ndarray, direction: int, keep: bool = False):
        """data: steps x runs, 256 beyond a run's end.  The states of every step (hidden x runs); keep: what training needs."""
        T, U = self.T[direction], self.U[direction]
        H, (steps, n) = U.shape[1], data.shape
        out, kept = np.empty((steps, H, n), _F), []
        h = np.zeros((H, n), _F)
        for t in range(steps) if direction == 0 else range(steps - 1, -1, -1):
            x = T.take(data[t], axis=1)
            g = x[: 2 * H]
            g += U[: 2 * H] @ h
            if keep:
                raw = g.copy()
            g *= _F(0.25)
            g += _F(0.5)
            np.clip(g, 0, 1, out=g)
            z, r = g[:H], g[H:]
            a = x[2 * H :]
            a += U[2 * H :] @ (r * h)
            cand = np.clip(a, -1, 1)
            new = cand - h
            new *= z
            new += h
            if keep:
                kept.append((t, h, raw, z.copy(), r.copy(), a.copy(), cand))
            out[t] = h = new
        return (out, kept) if keep else out

    def positions(self, data: np.ndarray) -> np.ndarray:
        """The language distribution of every position: steps x languages x runs."""
        H = self.U[0].shape[1]
        logits = np.matmul(self.V[:, :H], self.states(data, 0))
        logits += np.matmul(self.V[:, H:], self.states(data, 1))
        logits += self.c[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, data: np.ndarray, truth: np.ndarray):
        """Cross entropy of every position and its gradients, by backpropagation through time."""
        H, (steps, n) = self.U[0].shape[1], data.shape
        passes = [self.states(data, d, keep=True) for d in (0, 1)]
        both = np.concatenate([p[0] for p in passes], axis=1)
        logits = np.matmul(self.V, both) + self.c[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        live = (data < 256).astype(_F)
        total = max(1.0, float(live.sum()))
        loss = float(-(np.log(np.maximum(p[:, truth, np.arange(n)], 1e-9)) * live).sum() / total)
        d = p
        d[:, truth, np.arange(n)] -= 1
        d *= live[:, None, :] / _F(total)
        dV, dc = np.einsum("tln,thn->lh", d, both, optimize=True), d.sum(axis=(0, 2))
        dh_all = np.matmul(self.V.T, d)
        dT, dU = [], []
        for k, (_, kept) in enumerate(passes):
            U, gT, gU = self.U[k], np.zeros_like(self.T[k]), np.zeros_like(self.U[k])
            back = np.zeros((H, n), _F)
            for t, h, raw, z, r, a, cand in reversed(kept):
                dh = dh_all[t, k * H : (k + 1) * H] + back
                da = dh * z * (np.abs(a) < 1)
                drh = U[2 * H :].T @ da
                dz = dh * (cand - h) * (np.abs(raw[:H]) < 2) * _F(0.25)
                dr = drh * h * (np.abs(raw[H:]) < 2) * _F(0.25)
                dg = np.concatenate([dz, dr])
                back = dh * (1 - z) + drh * r + U[: 2 * H].T @ dg
                gU[: 2 * H] += dg @ h.T
                gU[2 * H :] += da @ (r * h).T
                everything = np.concatenate([dg, da])
                for row in range(3 * H):
                    gT[row] += np.bincount(data[t], everything[row], 257).astype(_F)
            dT.append(gT)
            dU.append(gU)
        return loss, [*dT, *dU, dV.astype(_F), dc.astype(_F)]


def laid_out(blobs: list[np.ndarray], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """All runs of the texts side by side (steps x runs, 256 as filler) and each run's text."""
    counts = np.array([-(-len(b) // run) for b in blobs], np.int64)
    data = np.full((int(counts.sum()), run), 256, np.int16)
    flat, at = data.reshape(-1), 0
    for b, n in zip(blobs, counts.tolist(), strict=True):
        flat[at : at + len(b)] = b
        at += n * run
    return np.ascontiguousarray(data.T), np.repeat(np.arange(len(blobs)), counts)


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, epochs: int = 6, seed: int = 7, rate: float = 0.03) -> Network:
    """A network for the languages that occur; one language or none is allowed."""
    languages = sorted(set(labels))
    net = Network.fresh(languages, hidden, seed)
    if len(languages) < 2:
        return net
    data, owner = laid_out([LOWER[np.frombuffer(t, np.uint8)] for t in texts])
    truth = np.array([languages.index(x) for x in labels])[owner]
    params = [*net.T, *net.U, net.V, net.c]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    order, step = np.random.RandomState(seed), 0
    size = 128
    for _ in range(epochs):
        deal = order.permutation(data.shape[1])
        for a in range(0, len(deal), size):
            step += 1
            _, grads = net.gradients(data[:, deal[a : a + size]], truth[deal[a : a + size]])
            scale = min(1.0, 5.0 / (1e-9 + float(np.sqrt(sum((g**2).sum() for g in grads)))))
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                g = g * _F(scale)
                m += _F(0.1) * (g - m)
                v += _F(0.01) * (g * g - v)
                p -= _F(rate) * (m / _F(1 - 0.9**step)) / (np.sqrt(v / _F(1 - 0.99**step)) + _F(1e-6))
    return net


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> tuple[list[bytes], list[str]]:
    """The bounded training sample: rows with a language and a letter, whose crc32(doc_id as text) mod 3 is not 1.

    Of hashes that are spread evenly, about 2 * rows + 1000 lie under a bound that follows from the number of rows; only those
    are put in order, so what tasks send grows neither with the corpus nor with their number."""
    order = F.xxhash64("doc_id", "text")
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    n = labelled.count()
    # F.lit can't hold numbers of more than 64 bits
    bound = min((1 << 64) * (2 * rows + 1000) // max(n, 1), (1 << 64) - 1) - (1 << 63)
    picked = labelled.select(order.alias("o"), "lang", F.expr(f"substring(text, 1 + pmod(xxhash64(doc_id, text), greatest(length(text) - {size}, 1)), {size})").alias("part"))
    found = picked.where(F.col("o") <= F.lit(bound)).orderBy("o", "lang", "part").limit(rows).collect()
    return [r.part.encode() for r in found], [r.lang for r in found]


def held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id as text, mod 3, is 1; a null id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, n_positions long, position_langs array<long>"


def _predictions(net: Network):
    names = np.array(net.languages, object)

    def rows(batches):
        for whole in batches:
            for batch in batch_slices(whole, "text", _SLICE):
                texts = [b"" if t is None else t.encode() for t in batch.column(1).to_pylist()]
                texts = [t if ok else b"" for t, ok in zip(texts, batch.column(3).to_pylist(), strict=True)]
                total = np.zeros((len(texts), len(names)))
                voted = np.zeros((len(texts), len(names)), np.int64)
                if len(names):
                    data, owner = laid_out([LOWER[np.frombuffer(t, np.uint8)] for t in texts])
                    for a in range(0, data.shape[1], 2048):
                        part, of = data[:, a : a + 2048], owner[a : a + 2048]
                        p = net.positions(part)
                        live = part < 256
                        winner = np.where(live, p.argmax(axis=1), len(names))
                        p *= live[:, None, :]
                        np.add.at(total, of, p.sum(axis=0).T)
                        for k in range(len(names)):
                            voted[:, k] += np.bincount(of, (winner == k).sum(axis=0), len(texts)).astype(np.int64)
                sizes = np.array([len(t) for t in texts])
                known = (sizes > 0) & (len(names) > 0)
                best = total.argmax(axis=1) if len(names) else np.zeros(len(texts), np.int64)
                score = np.where(known, total.max(axis=1, initial=0) / np.maximum(sizes, 1), 0.0)
                pred = [names[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(np.where(known, sizes, 0)), pa.array(voted.tolist(), pa.list_(pa.int64()))],
                    names=["doc_id", "held_out", "lang_pred", "score", "n_positions", "position_langs"],
                )

    return rows


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the pooled probability), n_positions (bytes labelled) and position_langs (how many
    of them went to each of net.languages).  Null texts and texts without a letter are `und` with score 0."""
    right = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return right.mapInArrow(_predictions(net), _PREDICTED)


def learn_and_identify(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    return identify(docs, train(*sample(docs, rows)))
