"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own vector (frequent words of the training sample) beside the mean of vectors of its hashed
character n-grams, so that unseen and inflected words are read by their letters. Every window of ``WINDOW`` words is
scored, one from each word on (``STRIDE`` 1), so that no verdict depends on where a passage stands; both directions run
over a window, attention pools their states, and a document's score is its worst window's. Training knows documents'
labels alone: each step takes the worst windows of each document under the present network, of those at every
``TRAINING_STRIDE`` words. The first coordinate of the n-gram
vectors starts at the n-grams' log odds in the sample, which tells the first steps where to look. Gates are hard sigmoids
(x / 4 + 1 / 2 within 0..1) and candidates hard tangents (x within -1..1), in training and scoring alike.

Words are runs of ASCII letters and digits and of characters beyond ASCII, without Unicode's spaces and punctuation. A run of more
than ``MOST_BYTES`` bytes, as of scripts that leave no spaces between words, becomes several overlapping words, so that
each of its bytes and n-grams enters a window.

Null and empty texts have no words; they are scored as one window of padding. Texts of any length are scored whole, equal
texts and repeated rows alike; an empty table gives an empty result; other columns pass through, but those named as a
result column (in any case) are replaced. Equal worst windows are one score. Without labels of both classes every score is
the share of label 1.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import slices, texts, wider, without
from corpusloom.llm.training import class_shares, held_out, labelled_sample

#: Runs of ASCII letters and digits and of any characters beyond ASCII, in ASCII-lowered UTF-8.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Spaces and punctuation beyond ASCII: Latin-1's, the general and supplemental blocks, those of East Asian scripts and full width.
BETWEEN = re.compile(rb"\xc2[\x80-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb-\xbf]|\xe2(?:\x80[\x80-\x8a\x8e-\xbf]|\x81[\x80-\x9f]|[\xb8\xb9][\x80-\xbf])|\xe3\x80[\x80-\x84\x88-\x9f\xb0]|\xe3\x83\xbb|\xef(?:\xb8[\xb0-\xbf]|\xb9[\x80-\xaf]|\xbc[\x81-\x8f\x9a-\xa0\xbb-\xbf]|\xbd[\x80\x9b-\xa5])")
WINDOW, STRIDE = 32, 1
TRAINING_STRIDE = 24  # of the windows that training chooses from
HIDDEN, CHARS, WORDS = 8, 12, 6
GRAM_BITS = 15
VECTOR_RATE, FLOOR = 10.0, 1e-4  # of the vectors' adaptive steps
LANES = 512  # windows that step together: their states stay in the processor's cache
DENSE_LANES = 4096  # the same where windows start at every word
LEARNED = 4096  # words whose inputs are made at once
MOST_BYTES = 80  # of one word; longer runs are pieces of PIECE bytes, one from every PIECE_STEP bytes on
PIECE, PIECE_STEP = 48, 24


def words_of(text: bytes) -> list[bytes]:
    """The words of a text; all bytes of a long run are in its pieces, and any PIECE - PIECE_STEP in a row in one of them."""
    text = text.lower()
    found = WORD.findall(text if text.isascii() else BETWEEN.sub(b" ", text))
    if max(map(len, found), default=0) <= MOST_BYTES:
        return found
    out = []
    for w in found:
        out += [w] if len(w) <= MOST_BYTES else [w[i : i + PIECE] for i in range(0, len(w) - PIECE_STEP, PIECE_STEP)]
    return out


def windows(n: int, stride: int = STRIDE) -> np.ndarray:
    """Starts of the overlapping windows over n words; the last one reaches the end."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    return np.append(np.arange(0, n - WINDOW, stride), n - WINDOW)


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns of the words' 3- to 5-grams of bytes, ends marked, word by word; where each word's begin."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    marked = [b"<%b>" % w for w in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    b = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    columns, of = [], []
    gram = b[:-1] << np.uint64(8) | b[1:]
    for k in (3, 4, 5):
        if len(b) < k:
            break
        gram = gram[:-1] << np.uint64(8) | b[k - 1 :]
        inside = np.flatnonzero(word[: len(word) - k + 1] == word[k - 1 :])
        columns.append((gram[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        of.append(word[inside])
    columns, of = np.concatenate(columns), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(len(words)))
    return columns[order], starts


def sum_rows(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places, and the sum of the rows that share each."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(rows[order], first, axis=0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _inside(gate: np.ndarray) -> np.ndarray:
    """Slope of the hard sigmoid."""
    return np.float32(0.25) * ((gate > 0) & (gate < 1))


class Network:
    """Parameters and both passes. Per direction: input W (D x 3H), state U (H x 3H), bias b (3H): update, reset, candidate."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = 5):
        rng = np.random.default_rng(seed)
        d = CHARS + WORDS
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {"C": (rng.standard_normal((1 << GRAM_BITS, CHARS)) * 0.1).astype(np.float32), "E": (rng.standard_normal((len(vocabulary) + 1, WORDS)) * 0.1).astype(np.float32)}
        self.p["E"][0] = 0
        for s in "fb":
            self.p |= {f"W{s}": scale(d, 3 * HIDDEN), f"U{s}": scale(HIDDEN, 3 * HIDDEN), f"b{s}": np.zeros(3 * HIDDEN, dtype=np.float32)}
        self.p |= {"a": scale(2 * HIDDEN, 1)[:, 0], "u": scale(2 * HIDDEN, 1)[:, 0], "c": np.full(1, -1.0, dtype=np.float32)}

    def vectors(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vectors (n x D) of words, with the rows they are made of: n-gram columns, where each word's begin, word rows."""
        flat, starts = word_grams(words)
        own = np.fromiter((self.vocabulary.get(w, 0) for w in words), dtype=np.int64, count=len(words))
        return self.combine(flat, starts, own), flat, starts, own

    def combine(self, flat: np.ndarray, starts: np.ndarray, own: np.ndarray) -> np.ndarray:
        if not len(own):
            return np.zeros((0, CHARS + WORDS), dtype=np.float32)
        n = np.diff(np.append(starts, len(flat)))[:, None]
        c = np.add.reduceat(self.p["C"][flat], starts, axis=0) / np.sqrt(n).astype(np.float32)
        return np.concatenate([c, self.p["E"][own]], axis=1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions, n x 6H; a first row of zeros stands for padding."""
        out = np.concatenate([x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]], axis=1)
        return np.concatenate([np.zeros((1, 6 * HIDDEN), dtype=np.float32), out.astype(np.float32)])

    def forward(self, inputs: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logit of each window. at: windows x WINDOW rows of ``inputs``, 0 for padding."""
        n, length = at.shape
        full = bool((at > 0).all())
        states = np.empty((length, 2 * HIDDEN, n), dtype=np.float32)
        kept = []
        for s, name in ((0, "f"), (1, "b")):
            u = np.ascontiguousarray(self.p[f"U{name}"].T)
            h = np.zeros((HIDDEN, n), dtype=np.float32)
            cols = slice(3 * HIDDEN * s, 3 * HIDDEN * (s + 1))
            for t in range(length) if not s else range(length - 1, -1, -1):
                g = np.ascontiguousarray(inputs.take(at[:, t], axis=0)[:, cols].T)
                hu = u @ h
                zr = g[: 2 * HIDDEN] + hu[: 2 * HIDDEN]
                zr *= np.float32(0.25)
                zr += np.float32(0.5)
                np.clip(zr, 0, 1, out=zr)
                z, r = zr[:HIDDEN], zr[HIDDEN:]
                c = r * hu[2 * HIDDEN :]
                c += g[2 * HIDDEN :]
                np.clip(c, -1, 1, out=c)
                new = z * (h - c)
                new += c
                there = at[:, t] > 0
                if not full:
                    new = np.where(there, new, h)
                if keep:
                    kept.append((s, t, h, hu, z, r, c, there))
                h = new
                states[t, HIDDEN * s : HIDDEN * (s + 1)] = h
        score = np.einsum("thn,h->tn", states, self.p["a"])
        if not full:
            score = np.where(at.T > 0, score, np.float32(-1e9))
        score -= score.max(0)
        weight = np.exp(score)
        if not full:
            weight *= at.T > 0
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,thn->hn", weight, states)
        logit = self.p["u"] @ pooled + self.p["c"][0]
        return (logit, states, weight, pooled, kept) if keep else logit

    def dense(self, inputs: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Logits of the windows that start at each of ``ids``, rows of ``inputs`` without padding, as long as one fits.

        Neighbours' inputs overlap, so a step reads a slice in place of a gather; of the states, attention needs two
        numbers each, which the next step's product brings along.
        """
        slope, shift = np.ones(3 * HIDDEN, dtype=np.float32), np.zeros(3 * HIDDEN, dtype=np.float32)
        slope[: 2 * HIDDEN], shift[: 2 * HIDDEN] = 0.25, 0.5  # the gates' hard sigmoid, but for its bounds
        steps = []
        for s, name in ((0, "f"), (1, "b")):
            own = slice(HIDDEN * s, HIDDEN * (s + 1))
            u = np.concatenate([self.p[f"U{name}"].T * slope[:, None], self.p["a"][None, own], self.p["u"][None, own]])
            steps.append((slice(3 * HIDDEN * s, 3 * HIDDEN * (s + 1)), np.ascontiguousarray(u, dtype=np.float32), range(WINDOW) if not s else range(WINDOW - 1, -1, -1)))
        zero, one = np.float32(0), np.float32(1)
        out = np.empty(len(ids) - WINDOW + 1, dtype=np.float32)
        for lo in range(0, len(out), DENSE_LANES):
            n = min(DENSE_LANES, len(out) - lo)
            block = np.ascontiguousarray(inputs.take(ids[lo : lo + n + WINDOW - 1], axis=0).T)
            score, value = np.zeros((WINDOW, n), dtype=np.float32), np.zeros((WINDOW, n), dtype=np.float32)
            product = np.empty((3 * HIDDEN + 2, n), dtype=np.float32)
            zr, c = np.empty((2 * HIDDEN, n), dtype=np.float32), np.empty((HIDDEN, n), dtype=np.float32)
            for cols, u, order in steps:
                x = block[cols] * slope[:, None] + shift[:, None]
                h, before = np.zeros((HIDDEN, n), dtype=np.float32), None
                for t in order:
                    np.matmul(u, h, out=product)
                    if before is not None:
                        score[before] += product[-2]
                        value[before] += product[-1]
                    np.add(x[: 2 * HIDDEN, t : t + n], product[: 2 * HIDDEN], out=zr)
                    np.clip(zr, zero, one, out=zr)
                    np.multiply(zr[HIDDEN:], product[2 * HIDDEN : 3 * HIDDEN], out=c)
                    c += x[2 * HIDDEN :, t : t + n]
                    np.clip(c, -one, one, out=c)
                    h -= c
                    h *= zr[:HIDDEN]
                    h += c
                    before = t
                score[before] += u[-2] @ h
                value[before] += u[-1] @ h
            score -= score.max(0)
            np.exp(score, out=score)
            value *= score
            out[lo : lo + n] = value.sum(0) / score.sum(0) + self.p["c"][0]
        return out

    def backward(self, at: np.ndarray, saved, error: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """Gradients of parameters but C and E; rows of the inputs in use, and their gradients."""
        _, states, weight, pooled, kept = saved
        g = {"u": pooled @ error, "c": np.array([error.sum()], dtype=np.float32)}
        d_pooled = self.p["u"][:, None] * error
        d_weight = np.einsum("hn,thn->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        d_states = weight[:, None] * d_pooled + d_score[:, None] * self.p["a"][:, None]
        g["a"] = np.einsum("tn,thn->h", d_score, states)
        gates_at: dict[int, list] = {0: [], 1: []}
        dh = {s: np.zeros((HIDDEN, at.shape[0]), dtype=np.float32) for s in (0, 1)}
        for name in "fb":
            g[f"U{name}"] = np.zeros_like(self.p[f"U{name}"])
        for s, t, h, hu, z, r, c, there in reversed(kept):
            name = "fb"[s]
            total = dh[s] + d_states[t, HIDDEN * s : HIDDEN * (s + 1)]
            live = np.where(there, total, 0)
            dz, dc = live * (h - c) * _inside(z), live * (1 - z) * (np.abs(c) < 1)
            dr = dc * hu[2 * HIDDEN :] * _inside(r)
            gates = np.concatenate([dz, dr, dc])
            d_hu = np.concatenate([dz, dr, dc * r])
            g[f"U{name}"] += h @ d_hu.T
            dh[s] = live * z + self.p[f"U{name}"] @ d_hu + np.where(there, 0, total)
            gates_at[s].append((t, gates))
        # both directions have met every place; bring them into the same order of steps
        steps = [[gates for _, gates in sorted(gates_at[s], key=lambda x: x[0])] for s in (0, 1)]
        rows = np.concatenate([np.concatenate([f, b]).T for f, b in zip(*steps, strict=True)])
        places = at.T.reshape(-1)
        return g, *sum_rows(places, rows)


def log_odds(sample: list[tuple[list[bytes], int]], smoothing: float = 2.0) -> np.ndarray:
    """Of each n-gram column: log odds of its documents with label 1, shrunk, and capped at 3."""
    seen = [np.zeros(1 << GRAM_BITS), np.zeros(1 << GRAM_BITS)]
    n = [1, 1]
    for words, y in sample:
        seen[y][np.unique(word_grams(sorted(set(words)))[0])] += 1
        n[y] += 1
    odds = np.log((seen[1] + smoothing) / (n[1] + smoothing)) - np.log((seen[0] + smoothing) / (n[0] + smoothing))
    return np.clip(odds, -3, 3).astype(np.float32)


def train(sample: list[tuple[bytes, int]], share: float, epochs: int = 5, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Network:
    """A network fitted on (text, label) by Adam; ``share`` of label 1 moves the bias from the balanced sample's to the corpus's."""
    docs = [(words_of(t), y) for t, y in sample]
    docs = [(w, y) for w, y in docs if w]
    counts: dict[bytes, int] = {}
    for w, _ in docs:
        for x in set(w):
            counts[x] = counts.get(x, 0) + 1
    frequent = sorted((w for w, k in counts.items() if k >= 5), key=lambda w: (-counts[w], w))[:20_000]
    net = Network({w: i + 1 for i, w in enumerate(frequent)})
    if len({y for _, y in docs}) < 2:
        share = min(max(share, 1e-3), 1 - 1e-3)
        net.p["u"][:] = 0
        net.p["c"][0] = np.log(share / (1 - share))
        return net
    net.p["C"][:, 0] = log_odds(docs) * 0.5
    vocabulary = sorted(counts)
    row = {w: i for i, w in enumerate(vocabulary)}
    _, flat, starts, own = net.vectors(vocabulary)
    ends = np.append(starts[1:], len(flat))
    rows = [np.array([row[x] for x in w], dtype=np.int64) for w, _ in docs]
    y = np.array([k for _, k in docs], dtype=np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            words, inverse = np.unique(np.concatenate([rows[i] for i in chosen]), return_inverse=True)
            sizes = ends[words] - starts[words]
            local = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            grams = flat[np.repeat(starts[words] - local, sizes) + np.arange(sizes.sum())]
            x = net.combine(grams, local, own[words])
            inputs = net.project(x)
            at, of, first = [], [], 0
            for j, i in enumerate(chosen):
                ids = inverse[first : first + len(rows[i])] + 1
                first += len(rows[i])
                padded = np.concatenate([ids, np.zeros(WINDOW, dtype=np.int64)])
                begins = windows(len(ids), TRAINING_STRIDE)
                at.append(padded[begins[:, None] + np.arange(WINDOW)])
                of += [j] * len(begins)
            at, of = np.concatenate(at), np.array(of)
            logit = np.concatenate([net.forward(inputs, at[k : k + LANES]) for k in range(0, len(at), LANES)])
            # the worst windows of each document: one of label 1, and the two nearest to an error of label 0
            rank = np.lexsort((-logit, of))
            place = np.arange(len(rank)) - np.searchsorted(of[rank], of[rank])
            use = rank[place < np.where(y[chosen][of[rank]] > 0, 1, 2)]
            at, target = at[use], y[chosen][of[use]]
            saved = net.forward(inputs, at, keep=True)
            error = (sigmoid(saved[0]) - target) * np.where(target > 0, 1.0, 0.5) / len(chosen)
            grad, live, d_inputs = net.backward(at, saved, error.astype(np.float32))
            live, d_inputs = live[live > 0] - 1, d_inputs[live > 0]
            df, db = d_inputs[:, : 3 * HIDDEN], d_inputs[:, 3 * HIDDEN :]
            grad |= {"Wf": x[live].T @ df, "Wb": x[live].T @ db, "bf": df.sum(0), "bb": db.sum(0)}
            dx = df @ net.p["Wf"].T + db @ net.p["Wb"].T
            step += 1
            lr = rate * (0.3 if epoch >= epochs * 0.7 else 1.0)
            for k, gk in grad.items():
                m, v = moments[k]
                m += 0.1 * (gk - m)
                v += 0.001 * (gk * gk - v)
                net.p[k] -= (lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            # vectors take plain adaptive steps on the rows in use
            per = (dx[:, :CHARS] / np.sqrt(sizes[live])[:, None]).repeat(sizes[live], axis=0).astype(np.float32)
            columns = np.concatenate([grams[local[i] : local[i] + sizes[i]] for i in live]) if len(live) else np.zeros(0, dtype=np.int64)
            for k, at_rows, g in (("C", columns, per), ("E", own[words][live], dx[:, CHARS:])):
                if not len(at_rows):
                    continue
                distinct, total = sum_rows(at_rows, g)
                v = moments[k][1]
                v[distinct] += total * total
                net.p[k][distinct] -= VECTOR_RATE * lr * total / (np.sqrt(v[distinct]) + FLOOR)
            net.p["E"][0] = 0
    shift = np.log(max(share, 1e-6) / max(1 - share, 1e-6)) - np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6))
    net.p["c"][0] += np.float32(0.5 * shift)
    return net


class Scorer:
    """Scores of texts; words' inputs are remembered, up to ``memory`` words."""

    def __init__(self, net: Network, memory: int = 300_000):
        self.net, self.memory = net, memory
        self.rows: dict[bytes, int] = {}
        # rows take memory once they are written
        self.table = np.empty((memory + LEARNED, 6 * HIDDEN), dtype=np.float32)
        self.table[0] = 0
        self.used = 1

    def _learn(self, words: list[bytes]) -> None:
        for lo in range(0, len(words), LEARNED):
            some = words[lo : lo + LEARNED]
            new = self.net.project(self.net.vectors(some)[0])[1:]
            while self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            self.table[self.used : self.used + len(new)] = new
            self.rows.update(zip(some, range(self.used, self.used + len(new)), strict=True))
            self.used += len(new)

    def score(self, batch: list[bytes]) -> list[float]:
        if self.used > self.memory:
            self.rows, self.used = {}, 1
        distinct = list(dict.fromkeys(batch))  # equal texts are scored once
        if len(distinct) < len(batch):
            known = dict(zip(distinct, self.score(distinct), strict=True))
            return [known[t] for t in batch]
        tokens = [words_of(t) for t in batch]
        unknown = set().union(*tokens).difference(self.rows) if tokens else set()
        self._learn(sorted(unknown))
        get = self.rows.__getitem__
        best = np.full(len(batch), -np.inf)
        short = [j for j, words in enumerate(tokens) if len(words) < WINDOW]
        at = np.zeros((len(short), WINDOW), dtype=np.int64)
        for row, j in enumerate(short):
            at[row, : len(tokens[j])] = [get(w) for w in tokens[j]]
        for lo in range(0, len(at), LANES):
            best[short[lo : lo + LANES]] = self.net.forward(self.table, at[lo : lo + LANES])
        # the others one behind the other; windows that reach into the next text do not count
        long = [j for j, words in enumerate(tokens) if len(words) >= WINDOW]
        if long:
            sizes = np.array([len(tokens[j]) for j in long])
            ids = np.fromiter((get(w) for j in long for w in tokens[j]), dtype=np.int64, count=sizes.sum())
            logit = np.append(self.net.dense(self.table, ids), np.full(WINDOW - 1, -np.inf, dtype=np.float32))
            first = np.cumsum(sizes) - sizes
            best[long] = np.maximum.reduceat(logit, np.stack([first, first + sizes - WINDOW + 1], axis=1).ravel())[::2]
        return sigmoid(np.clip(best, -30, 30)).tolist()


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, most: int = 3000, most_chars: int = 8_000, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted; one pass without a shuffle.

    Fitted on at most ``most`` labelled rows outside the fold ``modulus``/``remainder``; see ``labelled_sample``.
    """
    sample = labelled_sample(docs, labels, "toxic", modulus, remainder, most, most_chars).collect()
    sample.sort(key=lambda r: (r.doc_id, r.text))
    net = train([(r.text.encode(), r.label) for r in sample], class_shares(labels, "toxic", modulus, remainder))

    def run(batches):
        scorer = Scorer(net)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, at):
                scores = scorer.score(list(texts(part.column(at))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, type=pa.float64())], names=[*part.schema.names, "score"])

    kept = without(docs, "held_out", "score", "predicted").withColumn("held_out", held_out(modulus, remainder))
    scored = kept.mapInArrow(run, wider(kept, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
