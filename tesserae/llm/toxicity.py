"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters twice: by a hashed word embedding and by the mean of hashed
embeddings of its character n-grams.  A forward and a backward GRU read a
window of words, attention pools their states, and a logistic layer scores
the window.  A document's score is the highest over all its windows of
``WINDOW`` words, one from each word on.  A word of more than ``PART``
characters stands for its parts of that length, each overlapping the next by
``OVERLAP``, so that text without blanks has words and windows too.

The network learns from a bounded sample of labelled rows: the ``MAX_TRAIN``
rows with the smallest hash of their ids, per label.  Labels belong to
documents, but toxic words to places, so training alternates as is usual for
multiple instances: a positive document teaches through the few windows that
now score highest (at first by the log odds of its n-grams) and higher than
nearly all of negative documents, negative ones through
their worst windows and a seeded draw of the rest.  Embeddings decay, so that
what few documents hold weighs little.  Only for the fitting, windows begin
``TRAIN_STRIDE`` words apart.  Of several texts under one labelled id the
least in order is taken.

Defined results: a null, empty or wordless text is one window of padding and
gets that window's score; repeated rows get equal scores; without positive or
negative labels every score is 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesserae.llm.common import give_back, without_cycles

WINDOW, TRAIN_STRIDE = 9, 4
PART, OVERLAP = 24, 12
#: Labelled rows of each label, at most, that the network is fitted on, and the bytes of the longest text among them.
MAX_TRAIN, MAX_BYTES = 1500, 1 << 16
THRESHOLD = 0.7
#: Every which negative document is kept aside, the share of those that may reach the threshold, and that of positive ones that may not.
ASIDE, MAX_FALSE, MISSED = 5, 0.02, 0.1
WORDS, GRAMS, DIM, HIDDEN = 1 << 12, 1 << 14, 12, 8
#: Windows that are scored side by side.
CHUNK = 4096
#: Bytes of the n-grams.
GRAM_SIZES = (4, 6, 8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tokens(text: str | None) -> list[str]:
    words = (text or "").lower().split()
    if not words or max(map(len, words)) <= PART:
        return words
    return [w[k : k + PART] for w in words for k in range(0, max(1, len(w) - OVERLAP), PART - OVERLAP)]


class Network:
    """The weights, the forward pass, its gradient and Adam."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        init = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        h, d = HIDDEN, 2 * DIM
        self.p = {"word": init(WORDS, DIM, scale=0.1), "gram": init(GRAMS + 1, DIM, scale=0.3)}
        self.p["gram"][GRAMS] = 0
        for way in "fb":
            self.p |= {f"W{way}": init(d, 3 * h, scale=d**-0.5), f"U{way}": init(h, 3 * h, scale=h**-0.5), f"c{way}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": init(2 * h, 2 * h, scale=(2 * h) ** -0.5), "v": init(2 * h, scale=0.5), "o": init(2 * h, scale=0.5), "ob": np.full(1, -2, np.float32)}
        self.m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.t = 0

    def gru(self, x: np.ndarray, way: str, keep: bool = False):
        """States (steps, batch, hidden) of projected inputs (steps, batch, 3 hidden); backward if ``way`` is b."""
        h, u = HIDDEN, self.p[f"U{way}"]
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        state, out, saved = np.zeros((x.shape[1], h), np.float32), np.empty((*x.shape[:2], h), np.float32), {}
        for t in steps:
            g = 1 / (1 + np.exp(-(x[t, :, : 2 * h] + state @ u[:, : 2 * h])))
            z, r = g[:, :h], g[:, h:]
            n = np.tanh(x[t, :, 2 * h :] + (r * state) @ u[:, 2 * h :])
            if keep:
                saved[t] = (state, z, r, n)
            state = n + z * (state - n)
            out[t] = state
        return out, saved

    def pooled(self, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits (batch) of projected inputs; mask (steps, batch) is 1 at words."""
        f, sf = self.gru(xf, "f", keep)
        b, sb = self.gru(xb, "b", keep)
        s = np.concatenate((f, b), 2)
        k = np.tanh(s @ self.p["A"])
        e = k @ self.p["v"] + (mask - 1) * 1e4
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pool = np.einsum("tb,tbh->bh", a, s)
        return pool @ self.p["o"] + self.p["ob"][0], (s, k, a, pool, sf, sb)

    def project(self, x: np.ndarray) -> np.ndarray:
        """The input's share of all gates, both ways side by side."""
        return np.concatenate((x @ self.p["Wf"] + self.p["cf"], x @ self.p["Wb"] + self.p["cb"]), -1)

    def step(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Loss gradient by back-propagation through time; returns (gradients, gradient of x)."""
        p, h = self.p, HIDDEN
        xs = self.project(x)
        logit, (s, k, a, pool, sf, sb) = self.pooled(xs[..., : 3 * h], xs[..., 3 * h :], mask, True)
        g: dict[str, np.ndarray] = {}
        d = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g["o"], g["ob"] = d @ pool, d.sum(keepdims=True)
        dpool = d[:, None] * p["o"]
        ds = a[..., None] * dpool
        da = np.einsum("bh,tbh->tb", dpool, s)
        de = a * (da - (a * da).sum(0))
        g["v"] = np.einsum("tb,tbh->h", de, k)
        dk = de[..., None] * p["v"] * (1 - k * k)
        g["A"] = np.einsum("tbi,tbj->ij", s, dk)
        ds += dk @ p["A"].T
        dx = np.zeros_like(x)
        for way, saved, lo in (("f", sf, 0), ("b", sb, h)):
            u, dxs, carry = p[f"U{way}"], np.zeros((*x.shape[:2], 3 * h), np.float32), np.zeros((x.shape[1], h), np.float32)
            g[f"U{way}"] = np.zeros_like(u)
            for t in range(len(x) - 1, -1, -1) if way == "f" else range(len(x)):
                old, z, r, n = saved[t]
                dh = ds[t, :, lo : lo + h] + carry
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (old - n) * z * (1 - z)
                dro = dn @ u[:, 2 * h :].T
                dr = dro * old * r * (1 - r)
                dg = np.concatenate((dz, dr), 1)
                g[f"U{way}"][:, : 2 * h] += old.T @ dg
                g[f"U{way}"][:, 2 * h :] += (r * old).T @ dn
                dxs[t] = np.concatenate((dg, dn), 1)
                carry = dh * z + dro * r + dg @ u[:, : 2 * h].T
            g[f"W{way}"], g[f"c{way}"] = np.einsum("tbi,tbj->ij", x, dxs), dxs.sum((0, 1))
            dx += dxs @ p[f"W{way}"].T
        return g, dx

    def adam(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for k, v in g.items():
            m, s = self.m[k]
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            self.p[k] -= rate * (m / (1 - 0.9**self.t)) / (np.sqrt(s / (1 - 0.999**self.t)) + 1e-8)


class Vocabulary:
    """Hashed features of distinct words: a bucket for each, and buckets of its n-grams of ``GRAM_SIZES`` bytes.

    A word stands between ``<`` and ``>>``.
    """

    def __init__(self, words: list[str]):
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        self.word = np.fromiter(map(zlib.crc32, coded), np.int64, len(coded)) % WORDS
        size = np.fromiter(map(len, coded), np.int64, len(coded)) + 3
        longest = max(GRAM_SIZES)
        b = np.frombuffer((b"<%b>>" % b">><".join(coded) if coded else b"") + bytes(longest), np.uint8).astype(np.uint32)
        total = len(b) - longest
        left = np.repeat(np.cumsum(size), size) - np.arange(total)
        shift, h, index, fits = np.uint32(32 - GRAMS.bit_length() + 1), np.zeros(total, np.uint32), [], []
        for k in range(longest):
            h = (h ^ b[k : k + total]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            if k + 1 in GRAM_SIZES:
                index.append((h * np.uint32(0xC2B2AE35)) >> shift)
                fits.append(left > k)
        self.gram = np.stack(index, 1)[np.stack(fits, 1)].astype(np.int64)  # word by word
        self.size = sum(np.maximum(size - k + 1, 0) for k in GRAM_SIZES)  # one at least, as the shortest gram fits any word
        self.start, self.count = np.cumsum(self.size) - self.size, self.size.astype(np.float32)

    def grams(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-gram buckets of all ``rows`` end to end, and where each row's begin."""
        size = self.size[rows]
        begin = np.cumsum(size) - size
        return self.gram[np.repeat(self.start[rows] - begin, size) + np.arange(size.sum())], begin

    def vectors(self, net: Network, rows: np.ndarray | None = None) -> np.ndarray:
        """Of the ``rows``, or of all words."""
        flat, begin = (self.gram, self.start) if rows is None else self.grams(rows)
        rows = slice(None) if rows is None else rows
        mean = np.add.reduceat(net.p["gram"].take(flat, 0), begin) / self.count[rows][:, None]
        return np.concatenate((net.p["word"][self.word[rows]], mean), 1)

    def gradients(self, rows: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
        """Of the embeddings, from the gradients of the rows' vectors."""
        flat, _ = self.grams(rows)
        share = np.repeat(d[:, DIM:] / self.count[rows][:, None], self.size[rows], 0)
        add = lambda at, x, n: np.stack([np.bincount(at, x[:, k], n) for k in range(DIM)], 1).astype(np.float32)
        out = {"word": add(self.word[rows], d[:, :DIM], WORDS), "gram": add(flat, share, GRAMS + 1)}
        out["gram"][GRAMS] = 0
        return out


class Numbers(dict):
    """Words numbered from 1 on as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        return n


def tanh_of_half(x: np.ndarray) -> np.ndarray:
    """tanh(x / 2), in place; by exp, which numpy has faster."""
    np.exp(x, x)
    x += 1
    np.divide(-2, x, x)
    x += 1
    return x


class Scorer:
    """A network with the gate inputs of the words it has met, and the states that windows have after one word.

    Inputs of gates are kept with their sign turned and those of candidates doubled, as exp takes them.
    """

    def __init__(self, net: Network, cached: int = 200_000):
        self.net, self.cached = net, cached
        p, h = net.p, HIDDEN
        turn = np.repeat(np.float32([-1, 2]), [2 * h, h])
        self.turn = np.tile(turn, 2)
        u = [(p[f"U{way}"] * turn).T for way in "fb"]
        self.gates, self.new = [np.ascontiguousarray(x[: 2 * h]) for x in u], [np.ascontiguousarray(x[2 * h :]) for x in u]
        self.key, self.scratch = np.ascontiguousarray(2 * p["A"].T), np.empty(0, np.float32)
        self.index = Numbers()
        self.table, self.seen = np.zeros((1024, 8 * HIDDEN), np.float32), np.zeros(1, np.int64)
        self.put(0, np.zeros((1, 2 * DIM), np.float32))

    def put(self, at: int, x: np.ndarray) -> None:
        """What follows from the word vectors ``x``, in the table from row ``at`` on."""
        h, rows = HIDDEN, self.rows(at + len(x))[at:]
        rows[:, : 6 * h] = self.net.project(x) * self.turn
        for k in (0, 3):
            new = tanh_of_half(rows[:, h * (k + 2) : h * (k + 3)].copy())
            rows[:, h * (6 + k // 3) :][:, :h] = new - new / (1 + np.exp(rows[:, h * k : h * (k + 1)]))

    def rows(self, n: int) -> np.ndarray:
        if n > len(self.table):
            more = np.empty((max(n, 2 * len(self.table)), self.table.shape[1]), np.float32)  # pages that nobody fills take no memory
            more[: len(self.table)] = self.table
            self.table = more
        return self.table[:n]

    def ids(self, words: list[str]) -> np.ndarray:
        """The rows of the words in the table; new words enter it, and if it is full, only the half of it that was met most often stays."""
        known = len(self.index)
        out = np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))
        if known and len(self.index) > self.cached:
            stay = np.sort(np.argsort(-self.seen[1:], kind="stable")[: self.cached // 2])
            names, known = list(self.index), len(stay)
            self.index = Numbers(zip([names[k] for k in stay], range(1, known + 1), strict=True))
            self.seen = np.append(0, self.seen[stay + 1] // 2)
            for k in range(0, known, 8192):  # rows only move ahead
                self.table[k + 1 : min(k + 8192, known) + 1] = self.table[stay[k : k + 8192] + 1]
            out = np.fromiter(map(self.index.__getitem__, words), np.int32, len(words))
        if len(self.index) > known:
            fresh = list(islice(self.index, known, None))
            self.put(known + 1, Vocabulary(fresh).vectors(self.net))
        seen = np.bincount(out, minlength=len(self.index) + 1)
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        return out

    def highest(self, ids: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The highest logit of each document's windows, one from each of the ``counts`` places from ``first`` on of the word ids, 0 being padding.

        As ``Network.pooled``, with the places side by side: neighbouring windows are slices.
        A window's logit is a mean of the values of its states, so attention is left out
        where none of them is above a logit that the document has already.
        """
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(len(owner)) + np.repeat(first - np.cumsum(counts) + counts, counts)
        best = np.full(len(counts), -np.inf, np.float32)
        for k in range(0, len(at), CHUNK):
            some, of = at[k : k + CHUNK], owner[k : k + CHUNK]
            begin, span = some[0], some[-1] - some[0] + 1
            if span <= 1.25 * len(some):
                s, value = self.states(ids[begin : begin + span + WINDOW - 1], 1, span)
                column = some - begin
            else:
                s, value = self.states(ids[some + np.arange(WINDOW)[:, None]].ravel(), len(some), len(some))
                column = np.arange(len(some))
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            bound, left = value.max(0)[column], np.ones(len(some), bool)
            for order in (value.mean(0)[column], bound, None):
                if order is None:
                    now = np.flatnonzero(left & ~(bound <= best[of]))
                else:  # a first guess, so that the rest has something to be below of
                    now = np.flatnonzero(left & ~(order < np.repeat(np.maximum.reduceat(order, starts), np.diff(starts, append=len(of)))))
                left[now] = False
                for lo in range(0, len(now), 512):
                    rows = now[lo : lo + 512]
                    pad = (ids[some[rows] + np.arange(WINDOW)[:, None]] == 0) * np.float32(-1e4)
                    np.maximum.at(best, of[rows], self.attended(s[..., column[rows]], value[:, column[rows]], pad))
        return best + self.net.p["ob"][0]

    def states(self, ids: np.ndarray, step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """States (steps, 2 hidden, n) of n windows, and their values, whose mean by attention is a logit.

        The t-th words of all windows are n of ``ids`` from the place ``t * step`` on.  The next call overwrites the states.
        """
        h, look, x = HIDDEN, self.net.p["o"], np.ascontiguousarray(self.table.take(ids, 0).T)
        room = WINDOW * 2 * h * n
        if len(self.scratch) < room + 3 * h * n:
            self.scratch = np.empty(room + 3 * h * n, np.float32)
        s = self.scratch[:room].reshape(WINDOW, 2 * h, n)
        g, c = np.split(self.scratch[room : room + 3 * h * n].reshape(3 * h, n), [2 * h])
        value = np.zeros((WINDOW, n), np.float32)
        for k, steps in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            own, gates, new, state = x[3 * h * k : 3 * h * (k + 1)], self.gates[k], self.new[k], None
            for t in steps:
                out, place = s[t, h * k : h * (k + 1)], slice(t * step, t * step + n)
                if state is None:
                    out[:] = x[h * (6 + k) : h * (7 + k), place]
                else:
                    np.matmul(gates, state, g)
                    g += own[: 2 * h, place]
                    np.exp(g, g)
                    g += 1
                    np.divide(state, g[h:], g[h:])
                    np.matmul(new, g[h:], c)
                    c += own[2 * h :, place]
                    tanh_of_half(c)
                    np.subtract(state, c, out)
                    out /= g[:h]
                    out += c
                state = out
                value[t] += look[h * k : h * (k + 1)] @ state
        return s, value

    def attended(self, s: np.ndarray, value: np.ndarray, pad: np.ndarray) -> np.ndarray:
        """The means of the values (steps, n) by attention to the states."""
        e = self.net.p["v"] @ tanh_of_half(self.key @ s) + pad
        e -= e.max(0)
        np.exp(e, e)
        return (e * value).sum(0) / e.sum(0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, todo, held = [], [], 0
        for text in texts:
            words = tokens(text)
            todo.append(words)
            held += len(words)
            if held > 100_000:
                out.append(self.some(todo))
                todo, held = [], 0
        return np.concatenate([*out, self.some(todo)]) if todo else np.concatenate(out) if out else np.empty(0)

    def some(self, docs: list[list[str]]) -> np.ndarray:
        sizes = np.array([len(d) for d in docs])
        room = np.maximum(sizes, WINDOW)
        first = np.cumsum(room) - room
        ids = np.zeros(room.sum(), np.int32)
        ids[np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = self.ids([w for d in docs for w in d])
        counts = room - WINDOW + 1
        return sigmoid(self.highest(ids, first, counts))


def cut(ids: np.ndarray, sizes: list[int], stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The windows (rows of ids, padded with 0), ``stride`` words apart, of texts laid end to end, and each window's text."""
    counts = np.array([1 + max(0, -(-(n - WINDOW) // stride)) for n in sizes])
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))[owner]
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (first + nth * stride)[:, None] + np.arange(WINDOW)
    inside = at < (first + np.array(sizes)[owner])[:, None]
    return np.where(inside, np.append(ids, 0)[np.minimum(at, len(ids))], 0), owner


def fit(texts: list[str], labels: list[int], seed: int = 7, rounds: int = 7, batch: int = 192, steps: int = 70, best: int = 3, common: float = 0.998, decay: float = 0.01) -> Network:
    """A network fitted on whole texts and their 0/1 labels."""
    net, rng, y = Network(seed), np.random.default_rng(seed), np.array(labels)
    docs = [tokens(t) for t in texts]
    names = {w: i for i, w in enumerate(dict.fromkeys(w for d in docs for w in d))}
    words = Vocabulary(list(names))
    windows, owner = cut(np.array([names[w] + 1 for d in docs for w in d], np.int32), [len(d) for d in docs], TRAIN_STRIDE)
    del docs, names
    bounds = np.searchsorted(owner, np.arange(len(y) + 1))
    everything = np.arange(len(words.word))

    def all_logits(chosen: np.ndarray) -> np.ndarray:
        table = np.concatenate([net.project(x) for x in (np.zeros((1, 2 * DIM), np.float32), *(words.vectors(net, everything[k : k + 20_000]) for k in range(0, len(everything), 20_000)))])
        out = []
        for at in range(0, len(chosen), 1024):
            w = windows[chosen[at : at + 1024]].T
            x = table[w]
            out.append(net.pooled(x[..., : 3 * HIDDEN], x[..., 3 * HIDDEN :], (w > 0).astype(np.float32))[0])
        return np.concatenate(out)

    def odds() -> np.ndarray:
        """A first guess of each window: the surest log odds, by texts and over their standard error, of an n-gram of its words."""
        flat, _ = words.grams(everything)
        of = np.repeat(everything, words.size)
        held = np.zeros((2, GRAMS + 1))
        for d in range(len(y)):
            met = np.unique(windows[bounds[d] : bounds[d + 1]])
            buckets = np.unique(words.grams(met[met > 0] - 1)[0]) if met.any() else met[:0]
            held[int(y[d]), buckets] += 1
        n = np.bincount(y, minlength=2)
        value = (np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))) / np.sqrt(1 / (held[1] + 1) + 1 / (held[0] + 1))
        value[GRAMS] = -9
        best = np.full(len(everything), -9.0)
        np.maximum.at(best, of, value[flat])
        return np.append(-9.0, best)[windows].max(1)

    positive = np.flatnonzero(y == 1)
    aside = np.flatnonzero(y == 0)[::ASIDE]  # negative documents that teach nothing
    clean = np.flatnonzero((y[owner] == 0) & ~np.isin(owner, aside))
    score = odds()
    for r in range(rounds):
        if r:
            score = all_logits(np.arange(len(owner)))
        usual = np.quantile(score[clean], common)
        ranked = [bounds[d] + np.argsort(-score[bounds[d] : bounds[d + 1]], kind="stable")[:best] for d in positive]
        top = np.concatenate([w[(score[w] > usual) | (np.arange(len(w)) == 0)] for w in ranked])
        worst = clean[np.argsort(-score[clean], kind="stable")[: 2 * len(top)]]
        rows = np.concatenate((top, np.unique(np.concatenate((worst, rng.choice(clean, min(len(clean), 3 * len(top)), replace=False))))))
        target = np.concatenate((np.ones(len(top)), np.zeros(len(rows) - len(top))))
        for _ in range(max(2 if r else 4, -(-steps * batch // len(rows)))):
            order = rng.permutation(len(rows))
            for at in range(0, len(rows), batch):
                pick = order[at : at + batch]
                w = windows[rows[pick]].T
                met, back = np.unique(np.append(0, w), return_inverse=True)
                back = back[1:].reshape(w.shape)
                x = np.concatenate((np.zeros((1, 2 * DIM), np.float32), words.vectors(net, met[1:] - 1).astype(np.float32)))
                grads, dx = net.step(x[back], (w > 0).astype(np.float32), target[pick], np.ones(len(pick), np.float32))
                d = np.stack([np.bincount(back.ravel(), dx[..., k].ravel(), len(met)) for k in range(2 * DIM)], 1)
                net.adam(grads | words.gradients(met[1:] - 1, d[1:]), 0.01)
                for name in ("word", "gram"):
                    net.p[name] *= 1 - decay
    # the threshold goes between the worst of the negatives kept aside and nearly all positives
    highest = lambda some: np.maximum.reduceat(all_logits(some), np.flatnonzero(np.diff(owner[some], prepend=-1)))
    low = np.quantile(highest(np.flatnonzero(np.isin(owner, aside))), 1 - MAX_FALSE)
    high = np.quantile(highest(np.flatnonzero(y[owner] == 1)), MISSED)
    net.p["ob"] -= np.float32((low + max(low, high)) / 2 - np.log(THRESHOLD / (1 - THRESHOLD)))
    return net


def remainder(doc_id="doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN, seed: int = 7) -> Network | None:
    """Fit on at most ``max_rows`` rows of each label whose crc32(doc_id) mod 3 is not 1, of texts up to ``MAX_BYTES``."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder() != 1)).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    order = F.xxhash64(F.lit(seed), "doc_id")
    picked = known.where("y = 1").orderBy(order, "doc_id").limit(max_rows).unionByName(known.where("y = 0").orderBy(order, "doc_id").limit(max_rows))
    texts = docs.where(F.octet_length("text") <= MAX_BYTES).select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    rows = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).orderBy("doc_id").collect()
    y = [r["y"] for r in rows]
    return fit([r["text"] for r in rows], y, seed) if 0 < sum(y) < len(y) else None


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """All columns of ``docs`` with ``score`` (replaced if there) between 0 and 1.

    Only the text goes to Python, and only the score comes back.
    """
    docs = docs.drop("score")
    if net is None:
        return docs.withColumn("score", F.lit(0.0))
    weights = docs.sparkSession.sparkContext.broadcast(net.p)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Network()
        own.p = weights.value
        scorer = Scorer(own)
        for text in without_cycles(batches):
            got = [scorer.scores([x.as_py() for x in text[at : at + 500]]) for at in range(0, len(text), 500)]
            yield pa.array(np.concatenate([np.empty(0), *got]), pa.float64())
        del own, scorer
        give_back()

    return docs.withColumn("score", run("text"))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, one row for each row of ``docs``."""
    net = train(docs, labels)
    return score(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
