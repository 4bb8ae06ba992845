"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows.

A word's input is an embedding of the word (hashed) and the sum of embeddings of its character
n-grams (hashed; all of 3 to 5 bytes with marks at both ends), so spellings never seen share what
they have in common with seen ones. Windows of ``steps`` words begin every ``stride`` words, so they overlap. Attention weighs the states of
both directions, and a linear layer gives the window's logit. A document's score comes from its
highest window. Everything is trained in numpy on a bounded sample of labelled documents: labels are on
documents, so the first round learns from the window whose n-grams occur most in toxic documents, and
later rounds from the window that the network itself ranks first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, as_bytes, folded, mix, remainder
from .features import adam, calibration, labelled, sigmoid

MARKS = b".,;:!?\"'()[]{}*#%&$|<>-"


@dataclass(frozen=True)
class Toxicity:
    """rows, longest: the sample holds at most this many documents per label, of at most so many characters.

    rounds, epochs, least_steps: rounds of choosing windows, and passes and steps in each of them.
    fold, held: documents whose crc32 of the id leaves ``held`` modulo ``fold`` lend no label.
    """

    words: int = 1 << 14
    grams: int = 1 << 15
    width: int = 8
    hidden: int = 8
    steps: int = 32
    stride: int = 24
    rows: int = 1_500
    longest: int = 20_000
    rounds: int = 2
    epochs: int = 3
    least_steps: int = 150
    fold: int = 4
    held: int = 2
    threshold: float = 0.3
    seed: int = 11


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        return at


class Vocabulary:
    """The distinct words of a batch: places in the batch, hashed ids, hashed character n-grams by length."""

    def __init__(self, texts: list[bytes], t: Toxicity):
        seen, found = _Places(), _Places()
        raws = [np.fromiter(map(seen.__getitem__, w), np.int32, len(w)) for w in map(folded, texts)]
        bare = (w.strip(MARKS) for w in seen)
        to = np.fromiter((found[w] if w else -1 for w in bare), np.int32, len(seen))
        self.places = [x[x >= 0] for x in (to[r] for r in raws)]
        self.size = len(found)
        raw = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in found), np.uint8).astype(U64)
        size = np.fromiter((len(w) + 2 for w in found), np.int64, len(found))
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(found)), size)
        code = np.zeros(len(raw), U64)
        self.grams, self.owners = [], []
        for k in range(1, 6):
            if len(raw) < k:
                break
            code = code[: len(raw) - k + 1] * U64(257) + raw[k - 1 :]
            if k >= 3:
                same = owner[: len(code)] == owner[k - 1 :]
                self.grams.append((mix(code[same] + U64(k)) % U64(t.grams)).astype(np.int32))
                self.owners.append(owner[: len(code)][same])
        whole = np.zeros(0, U64)
        if len(found):
            place = np.arange(len(raw)) - np.repeat(first, size)
            whole = np.add.reduceat(mix(raw + (place.astype(U64) << U64(8))), first)
        self.ids = (mix(whole) % U64(t.words)).astype(np.int32)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """The sum of the table's rows over each word's n-grams."""
        out = np.zeros((self.size, table.shape[1]), np.float32)
        for grams, owners in zip(self.grams, self.owners, strict=True):
            for at in range(0, len(owners), 1_000_000):  # a word across the cut gets two parts
                some = owners[at : at + 1_000_000]
                starts = np.flatnonzero(np.diff(some, prepend=-1))
                out[some[starts]] += np.add.reduceat(table[grams[at : at + 1_000_000]], starts)
        return out

    def by_word(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams sorted by word, and where each word's begin."""
        owners = np.concatenate(self.owners) if self.owners else np.empty(0, np.int64)
        order = np.argsort(owners, kind="stable")
        grams = np.concatenate(self.grams)[order] if self.grams else np.empty(0, np.int32)
        return grams, np.searchsorted(owners[order], np.arange(self.size + 1))


def windows(places: np.ndarray, steps: int, stride: int) -> np.ndarray:
    """Overlapping windows of words as rows, -1 where the text ends; at least one."""
    count = max(1, -(-(len(places) - steps) // stride) + 1)
    out = np.full(stride * (count - 1) + steps, -1, np.int32)
    out[: len(places)] = places
    return np.lib.stride_tricks.sliding_window_view(out, steps)[::stride]


class Network:
    """Parameters: words, grams, in (2), back (2), bias (2), attention (matrix, vector), out (vector, bias)."""

    def __init__(self, t: Toxicity):
        rng, h, w = np.random.default_rng(t.seed), t.hidden, t.width
        draw = lambda *shape, by=1.0: (rng.normal(0, by, shape)).astype(np.float32)
        self.t = t
        self.params = [
            draw(t.words, w, by=0.1), draw(t.grams, w, by=0.1),
            draw(2, 2 * w, 3 * h, by=(2 * w) ** -0.5), draw(2, h, 3 * h, by=h**-0.5), np.zeros((2, 3 * h), np.float32),
            draw(2 * h, h, by=(2 * h) ** -0.5), draw(h, by=h**-0.5),
            draw(2 * h, by=(2 * h) ** -0.5), np.zeros(1, np.float32),
        ]
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, v: Vocabulary) -> np.ndarray:
        words, grams = self.params[:2]
        return np.concatenate([words[v.ids], v.sums(grams)], axis=1)

    def forward(self, gates: list[np.ndarray], rows: np.ndarray, keep: bool = False):
        """Logits of windows; gates: inputs of the gates by word, one more row of zeros for no word."""
        h, back = self.t.hidden, self.params[3]
        n, steps = rows.shape
        states, memory = np.zeros((steps, n, 2 * h), np.float32), []
        there = (rows >= 0).T
        for side, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
            s = np.zeros((n, h), np.float32)
            for i in order:
                x = gates[side][rows[:, i]]
                y = s @ back[side]
                zr = sigmoid(x[:, : 2 * h] + y[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * y[:, 2 * h :])
                on = there[i][:, None]
                new = np.where(on, z * s + (1 - z) * c, s)
                if keep:
                    memory.append((side, i, s, z, r, c, y[:, 2 * h :], on))
                states[i, :, side * h : side * h + h] = s = new
        mid = np.tanh(states @ self.params[5])
        score = np.where(there, mid @ self.params[6], -1e9)
        score -= score.max(axis=0)
        share = np.exp(score) * there
        share /= np.maximum(share.sum(axis=0), 1e-9)
        pooled = (share[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.params[7] + self.params[8]
        return (logit, states, memory, mid, share, pooled, there) if keep else logit

    def gates(self, inputs: np.ndarray) -> list[np.ndarray]:
        zero = np.zeros((1, 3 * self.t.hidden), np.float32)
        return [np.concatenate([inputs @ self.params[2][s] + self.params[4][s], zero]) for s in (0, 1)]

    def logits(self, gates: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        """As forward, with windows as columns and no masks for those that are full."""
        out = np.empty(len(rows))
        full = rows[:, -1] >= 0
        for at in (np.flatnonzero(full), np.flatnonzero(~full)):
            for i in range(0, len(at), 4096):
                some = at[i : i + 4096]
                if full[some[0]]:
                    out[some] = self._full(gates, rows[some])
                else:
                    out[some] = self.forward(gates, rows[some])
        return out

    def _full(self, gates: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        h, (n, steps) = self.t.hidden, rows.shape
        states = np.empty((steps, 2 * h, n), np.float32)
        rows = np.ascontiguousarray(rows.T)
        for side, order in ((0, range(steps)), (1, range(steps - 1, -1, -1))):
            s, back = np.zeros((h, n), np.float32), np.ascontiguousarray(self.params[3][side].T)
            for i in order:
                x = gates[side][rows[i]].T
                y = back @ s
                zr = y[: 2 * h]
                zr += x[: 2 * h]
                zr *= 0.5
                np.tanh(zr, out=zr)
                zr += 1
                zr *= 0.5
                c = y[2 * h :]
                c *= zr[h:]
                c += x[2 * h :]
                np.tanh(c, out=c)
                s = s - c
                s *= zr[:h]
                s += c
                states[i, side * h : side * h + h] = s
        score = np.tanh(self.params[5].T @ states).transpose(0, 2, 1) @ self.params[6]
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        pooled = (states * score[:, None, :]).sum(axis=0)
        return self.params[7] @ pooled + self.params[8]

    def gradients(self, inputs: np.ndarray, rows: np.ndarray, labels: np.ndarray):
        """Gradients of the mean cross entropy: of the inputs, and of all parameters but the embeddings."""
        h, t = self.t.hidden, self.t
        gates = self.gates(inputs)
        logit, states, memory, mid, share, pooled, there = self.forward(gates, rows, keep=True)
        error = ((sigmoid(logit) - labels) / len(labels)).astype(np.float32)
        grads = [np.zeros_like(p) for p in self.params[2:]]
        grads[5], grads[6] = pooled.T @ error, error.sum(keepdims=True)
        dpool = error[:, None] * self.params[7]
        dstates = share[:, :, None] * dpool
        dshare = (states * dpool).sum(axis=2)
        dscore = share * (dshare - (share * dshare).sum(axis=0))
        grads[4] = (mid * dscore[:, :, None]).sum(axis=(0, 1))
        dmid = dscore[:, :, None] * self.params[6] * (1 - mid * mid)
        grads[3] = np.tensordot(states, dmid, axes=([0, 1], [0, 1]))
        dstates = dstates + dmid @ self.params[5].T
        dgates = [np.zeros_like(g) for g in gates]
        carry = [np.zeros((len(rows), h), np.float32) for _ in (0, 1)]
        for side, i, s, z, r, c, yc, on in reversed(memory):
            d = carry[side] + dstates[i][:, side * h : side * h + h]
            don = d * on
            dz = don * (s - c) * z * (1 - z)
            dc = don * (1 - z) * (1 - c * c)
            dr = dc * yc * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=1)
            dy = np.concatenate([dz, dr, dc * r], axis=1)
            grads[1][side] += s.T @ dy
            carry[side] = d * ~on + don * z + dy @ self.params[3][side].T
            np.add.at(dgates[side], rows[:, i], dx)
        dinputs = np.zeros_like(inputs)
        for side in (0, 1):
            g = dgates[side][:-1]
            grads[0][side] = inputs.T @ g
            grads[2][side] = g.sum(axis=0)
            dinputs += g @ self.params[2][side].T
        return dinputs, grads


def first_choice(v: Vocabulary, labels: np.ndarray, t: Toxicity) -> np.ndarray:
    """A score per word: how much more often its most telling n-gram occurs in toxic documents."""
    counts = np.ones((2, t.grams))
    grams, start = v.by_word()
    for words, label in zip((np.unique(p) for p in v.places), labels, strict=True):
        if len(words):
            counts[int(label)][np.unique(np.concatenate([grams[start[w] : start[w + 1]] for w in words]))] += 1
    odds = np.log(counts[1] / (1 + labels.sum())) - np.log(counts[0] / (1 + (1 - labels).sum()))
    return np.maximum.reduceat(np.append(odds[grams], -9.0), start[:-1]) if v.size else np.empty(0)


def train(texts: list[bytes], labels: np.ndarray, share: float, t: Toxicity) -> Network:
    """Four fifths train the network, the rest the calibration of documents' highest windows."""
    net = Network(t)
    if not len(labels) or labels.min() == labels.max():
        net.params[7][:] = 0
        net.shift = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
        return net
    rng = np.random.default_rng(t.seed)
    v = Vocabulary(texts, t)
    rows = [windows(p, t.steps, t.stride) for p in v.places]
    learn = rng.permutation(len(rows))[: len(rows) * 4 // 5]
    hint = np.append(first_choice(v, np.where(np.isin(np.arange(len(rows)), learn), labels, 0), t), -9.0)
    index = v.by_word()
    step = adam(net.params, 0.01)
    for turn in range(t.rounds):
        if turn:
            gates = net.gates(net.inputs(v))
            rank = [net.logits(gates, r) for r in rows]
        else:
            rank = [hint[r].max(axis=1) for r in rows]
        chosen, target = [], []
        for i in learn:
            top = int(np.argmax(rank[i]))
            chosen.append(rows[i][top])
            target.append(labels[i])
            if not labels[i]:
                chosen += [rows[i][j] for j in rng.integers(0, len(rows[i]), 2)]
                target += [0.0, 0.0]
        chosen, target = np.stack(chosen), np.array(target, np.float32)
        batches = max(1, len(target) // 64)
        for _ in range(max(t.epochs, -(-t.least_steps // batches))):
            for part in np.array_split(rng.permutation(len(target)), batches):
                used, local = np.unique(np.append(chosen[part], -1), return_inverse=True)
                used, local = used[1:], local[:-1].reshape(len(part), -1) - 1
                grams, owner = _grams(index, used)
                inputs = np.zeros((len(used), 2 * t.width), np.float32)
                inputs[:, : t.width] = net.params[0][v.ids[used]]
                if len(owner):
                    starts = np.flatnonzero(np.diff(owner, prepend=-1))
                    inputs[owner[starts], t.width :] = np.add.reduceat(net.params[1][grams], starts)
                dinputs, grads = net.gradients(inputs, local, target[part])
                dwords, dgrams = np.zeros_like(net.params[0]), np.zeros_like(net.params[1])
                np.add.at(dwords, v.ids[used], dinputs[:, : t.width])
                np.add.at(dgrams, grams, dinputs[owner, t.width :])
                step([dwords, dgrams, *grads])
    gates = net.gates(net.inputs(v))
    rest = np.setdiff1d(np.arange(len(rows)), learn)
    best = np.array([net.logits(gates, rows[i]).max() for i in rest], float)
    net.scale, net.shift = calibration(best, labels[rest], share)
    return net


def _grams(index: tuple[np.ndarray, np.ndarray], used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of some words, and the place in ``used`` of the word each belongs to."""
    grams, first = index
    start, size = first[used], first[used + 1] - first[used]
    owner = np.repeat(np.arange(len(used)), size)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    return grams[np.repeat(start, size) + within], owner


def _score(net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = net.value
        t = network.t
        for whole in batches:
            at = 0
            while at < whole.num_rows:
                size, end = 0, at
                while end < whole.num_rows and (end == at or size < 12_000_000):
                    size += len(whole.column(2)[end].as_buffer())
                    end += 1
                batch = whole.slice(at, end - at)
                at = end
                v = Vocabulary([x.as_py() for x in batch.column(2)], t)
                gates = network.gates(network.inputs(v))
                rows = [windows(p, t.steps, t.stride) for p in v.places]
                first = np.cumsum([0] + [len(r) for r in rows])[:-1]
                best = np.maximum.reduceat(network.logits(gates, np.concatenate(rows)), first)
                score = sigmoid(network.scale * best.astype(float) + network.shift)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(score),
                     pa.array((score >= t.threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, t: Toxicity = Toxicity()) -> DataFrame:
    """One row per document: doc_id, held_out, score (label 1 likelier when higher), predicted.

    Labels come from rows that are not held out; of rows that repeat an id in ``labels`` the largest counts, null
    labels and ids are left out. Null and empty texts have one window without words. With no usable labels, or
    one label only, every score is the share of label 1 (one half without labels). Columns other than doc_id,
    text and toxic are ignored.
    """

    def learned(doc_id: Column) -> Column:
        return remainder(doc_id, t.fold) != t.held

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    counts = labels.where(F.col("doc_id").isNotNull() & learned(F.col("doc_id").cast("long"))).agg(
        F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)
    ).first()
    share = counts[0] / sum(counts) if sum(counts) else 0.5
    chosen = labelled(labels, "toxic", t.rows, learned)  # at most 2 x rows
    sample = rows.where(F.length("text") <= t.longest).join(F.broadcast(chosen), "doc_id")
    got = sample.dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    net = train([bytes(r["text"]) for r in got], np.array([r["label"] for r in got], float), share, t)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    held = rows.select("doc_id", (~learned(F.col("doc_id"))).alias("held_out"), "text")
    return held.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int")
