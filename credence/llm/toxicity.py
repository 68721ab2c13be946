"""Toxicity scores by a bidirectional gated recurrent network.

A word's input is a word embedding (hashed) joined with the mean of the
embeddings of its characters' n-grams (prefixes of 1 to 6 characters and all
4-grams, hashed), so that unseen forms of a known stem are recognised. A
window of ``WINDOW`` words runs through a gated recurrent network in both
directions; attention pooling weighs the states, and a logistic unit gives the
window's probability. Windows overlap by half and cover the whole text; the
text's score is that of its worst window.

Training (numpy, Adam) is multiple-instance: of each labelled text the window
that scores highest is trained on, with one more window of texts labelled 0.
The first choice of windows is by the log-odds of words and n-grams, which
also start one dimension of the embeddings. It runs in one task, on
``SAMPLE`` labelled rows at most (a documented bound of the classifier's fit):
those with the least hash of their id, one third with label 1 and the rest
with label 0; of an id that repeats, the text with the least hash.
Scoring covers every row and every word. Labels, lang, source and ids are no
inputs of a score.

Cases: null and empty texts, and texts without words, get the score of a
window without words; labels that are null are no labels; of several labels of
one id the largest counts; without any labelled row, or with one label only,
the network is still trained on what there is (a constant for no rows: 0).
Repeated rows get equal scores; other columns are ignored. An empty table gives
no rows.
"""

from __future__ import annotations

import io
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credence.llm.common import as_bytes

WINDOW, STRIDE = 64, 32
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
BUCKETS = 1 << 15
PREFIXES = 6
BATCH = 192
SAMPLE = 4000
EPOCHS = 5
MIN_STEPS = 60      # few labelled texts are gone over more often
THRESHOLD = 0.3
KNOWN = 200_000      # distinct words whose inputs a task keeps at once
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Features:
    """Hash buckets of words: ``own`` has the word's, ``grams`` those of its
    character n-grams (prefixes and 4-grams), ``n`` of them for each word."""

    def __init__(self, words: list[bytes]) -> None:
        text = "\0".join(w.decode("utf-8", "replace").replace("\0", " ") for w in words) + "\0" * 4
        c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        ends = np.flatnonzero(c == 0)[: len(words)]
        starts = np.concatenate([[0], ends[:-1] + 1]) if words else ends
        size = ends - starts
        owner = np.repeat(np.arange(len(words)), size + 1)
        place = np.arange(len(owner)) - np.repeat(starts, size + 1)
        c = np.concatenate([c[: len(owner)], np.zeros(4, np.uint64)])
        with np.errstate(over="ignore"):
            each = _hashed(c[: len(owner)] * _GOLD + place.astype(np.uint64))
            each[c[: len(owner)] == 0] = 0
            total = np.cumsum(each)
            base = total[starts] - each[starts] if words else total
            self.own = _bucket(total[ends] - base + np.uint64(1)) if words else np.empty(0, np.int64)
            prefix = [np.flatnonzero(size >= k) for k in range(1, PREFIXES + 1)]
            h = [_bucket(total[starts[w] + k] - base[w] + np.uint64(2)) for k, w in enumerate(prefix)]
            four = np.flatnonzero((c[:-4] > 0) & (c[1:-3] > 0) & (c[2:-2] > 0) & (c[3:-1] > 0))
            g = c[four]
            for k in (1, 2, 3):
                g = _hashed(g * _GOLD + c[four + k])
            h.append(_bucket(g))
        owners = np.concatenate([*prefix, owner[four]]).astype(np.int64)
        order = np.argsort(owners, kind="stable")
        self.grams = np.concatenate(h)[order]
        self.n = np.bincount(owners, minlength=len(words))
        self.owners = owners[order]

    def __len__(self) -> int:
        return len(self.own)

    def pick(self, rows: np.ndarray) -> Features:
        out = object.__new__(Features)
        starts = np.cumsum(self.n) - self.n
        out.own, out.n = self.own[rows], self.n[rows]
        out.owners = np.repeat(np.arange(len(rows)), out.n)
        before = np.cumsum(out.n) - out.n
        out.grams = self.grams[np.repeat(starts[rows] - before, out.n) + np.arange(len(out.owners))]
        return out


_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _hashed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _bucket(x: np.ndarray) -> np.ndarray:
    return (_hashed(x) % np.uint64(BUCKETS)).astype(np.int64)


def window_starts(n: int) -> range:
    """Starts of the overlapping windows of n words; one window if n is small."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights by name; forward and backward over batches of windows."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)
        w = {"word": normal(BUCKETS, WORD_DIM, scale=0.05), "char": normal(BUCKETS, CHAR_DIM, scale=0.05)}
        for side in "fb":
            w |= {f"x{side}": normal(d, 3 * h, scale=d**-0.5), f"h{side}": normal(h, 3 * h, scale=h**-0.5),
                  f"c{side}": np.zeros(3 * h, np.float32)}
        return cls(w | {"att": normal(2 * h, 2 * h, scale=(2 * h) ** -0.5), "key": normal(2 * h, scale=(2 * h) ** -0.5),
                        "out": normal(2 * h, scale=(2 * h) ** -0.5), "bias": np.zeros(1, np.float32)})

    @classmethod
    def loaded(cls, blob: bytes) -> Network:
        with np.load(io.BytesIO(blob)) as z:
            return cls({k: z[k].astype(np.float32) for k in z.files})

    def saved(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: v.astype(np.float16) if k in ("word", "char") else v for k, v in self.w.items()})
        return out.getvalue()

    def inputs(self, words: Features) -> np.ndarray:
        """Word vectors; row 0 is for "no word"."""
        out = np.zeros((len(words) + 1, WORD_DIM + CHAR_DIM), np.float32)
        if len(words):
            out[1:, :WORD_DIM] = self.w["word"][words.own]
            chars = np.add.reduceat(self.w["char"][words.grams], np.cumsum(words.n) - words.n)
            out[1:, WORD_DIM:] = chars / words.n[:, None].astype(np.float32)
        return out

    def _steps(self, px: np.ndarray, idx: np.ndarray, mask: np.ndarray, side: str, out: np.ndarray,
               keep: list | None) -> None:
        """Runs over time x batch rows of the projected inputs into ``out``."""
        h = HIDDEN
        u = self.w[f"h{side}"]
        gates, own = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h:])
        state = np.zeros((idx.shape[1], h), np.float32)
        for t in range(len(idx)) if side == "f" else reversed(range(len(idx))):
            x = px[idx[t]]
            zr = _sigmoid(x[:, : 2 * h] + state @ gates)
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(x[:, 2 * h:] + (r * state) @ own)
            m = mask[t][:, None]
            new = state + m * z * (c - state)
            if keep is not None:
                keep.append((t, state, z, r, c, m))
            out[t] = state = new

    def forward(self, projected: dict[str, np.ndarray], index: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """index: batch x time rows of the projected inputs, 0 for no word."""
        idx = np.ascontiguousarray(index.T)
        mask = (idx > 0).astype(np.float32)
        tapes = {"f": [] if tape is not None else None, "b": [] if tape is not None else None}
        states = np.empty((*idx.shape, 2 * HIDDEN), np.float32)
        self._steps(projected["f"], idx, mask, "f", states[:, :, :HIDDEN], tapes["f"])
        self._steps(projected["b"], idx, mask, "b", states[:, :, HIDDEN:], tapes["b"])
        a = np.tanh(states.reshape(-1, 2 * HIDDEN) @ self.w["att"])
        e = (a @ self.w["key"]).reshape(idx.shape) - 1e9 * (1 - mask)
        a = a.reshape(states.shape)
        e = np.exp(e - e.max(0)) * mask
        weight = e / np.maximum(e.sum(0), 1e-30)
        pooled = np.einsum("tb,tbk->bk", weight, states)
        p = _sigmoid(pooled @ self.w["out"] + self.w["bias"][0])
        if tape is not None:
            tape |= {"idx": idx, "steps": tapes, "states": states, "a": a, "weight": weight, "pooled": pooled, "p": p}
        return p

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {s: x @ self.w[f"x{s}"] + self.w[f"c{s}"] for s in "fb"}

    def gradients(self, x: np.ndarray, tape: dict, y: np.ndarray, weights: np.ndarray) -> tuple[dict, np.ndarray]:
        """Of the weighted log loss; second: with respect to the word vectors."""
        w, h, g = self.w, HIDDEN, {}
        d = ((tape["p"] - y) * weights).astype(np.float32)
        g["bias"], g["out"] = d.sum(keepdims=True), d @ tape["pooled"]
        dpool = d[:, None] * w["out"]
        states, weight, a = tape["states"], tape["weight"], tape["a"]
        dstates = weight[:, :, None] * dpool
        dw = (states * dpool).sum(2)
        de = weight * (dw - (weight * dw).sum(0))
        g["key"] = np.einsum("tb,tbk->k", de, a)
        da = de[:, :, None] * w["key"] * (1 - a * a)
        flat = states.reshape(-1, 2 * h)
        g["att"] = flat.T @ da.reshape(-1, 2 * h)
        dstates = dstates + da @ w["att"].T
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            u, carry = w[f"h{s}"], np.zeros((states.shape[1], h), np.float32)
            gu, dp_all, idx_all = np.zeros_like(u), [], []
            for t, prev, z, r, c, m in reversed(tape["steps"][s]):
                carry = carry + dstates[t][:, k * h: (k + 1) * h]
                dz = m * carry * (c - prev) * z * (1 - z)
                dc = m * carry * z * (1 - c * c)
                back = dc @ u[:, 2 * h:].T
                dr = back * prev * r * (1 - r)
                dzr = np.hstack([dz, dr])
                gu[:, : 2 * h] += prev.T @ dzr
                gu[:, 2 * h:] += (r * prev).T @ dc
                carry = carry * (1 - m * z) + back * r + dzr @ u[:, : 2 * h].T
                dp_all.append(np.hstack([dzr, dc]))
                idx_all.append(tape["idx"][t])
            dp, idx = np.concatenate(dp_all), np.concatenate(idx_all)
            g[f"h{s}"], g[f"c{s}"], g[f"x{s}"] = gu, dp.sum(0), x[idx].T @ dp
            np.add.at(dx, idx, dp @ w[f"x{s}"].T)
        dx[0] = 0
        return g, dx


def _log_odds(docs: list[np.ndarray], feats: Features, y: np.ndarray) -> np.ndarray:
    """Per bucket (words first, then n-grams): log-odds of the share of texts
    labelled 1 and 0 that hold it, by one half smoothed."""
    has = np.zeros((2, 2 * BUCKETS))
    for d, label in zip(docs, y, strict=True):
        if len(d):
            words = feats.pick(np.unique(d))
            has[int(label), np.unique(np.concatenate([words.own, BUCKETS + words.grams]))] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])[:, None]
    share = np.log((has + 0.5) / (n + 1))
    odds = share[1] - share[0]
    odds[has.sum(0) < 3] = 0
    return np.clip(odds, -6, 6)


def train(texts: list[bytes], labels: list[int], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """A network from whole labelled texts."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    y = np.array(labels, np.float32)
    index: dict[bytes, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in WORDS.findall(t.lower())], np.int64) for t in texts]
    feats = Features(list(index))
    if not texts:
        net.w["bias"][:] = -30
        return net
    odds = _log_odds(docs, feats, y)
    net.w["word"][:, 0] = 0.5 * odds[:BUCKETS]
    net.w["char"][:, 0] = 0.5 * odds[BUCKETS:]
    by_word = np.zeros(max(1, len(feats)))
    if len(feats):
        by_word = odds[feats.own] + np.maximum.reduceat(odds[BUCKETS + feats.grams], np.cumsum(feats.n) - feats.n)
    wins, of = [], []
    for k, d in enumerate(docs):
        for s in window_starts(len(d)):
            row = np.zeros(WINDOW, np.int64)
            part = d[s: s + WINDOW] + 1
            row[: len(part)] = part
            wins.append(row)
            of.append(k)
    wins, of = np.array(wins), np.array(of)
    first = np.searchsorted(of, np.arange(len(docs)))
    score = np.where(wins > 0, by_word[np.maximum(wins - 1, 0)], -9).max(1)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.w.items()}
    step = 0
    balance = np.where(y == 1, 0.4 / max(1, y.sum()), 0.6 / max(1, (1 - y).sum())) * len(y)
    epochs = max(epochs, -(-MIN_STEPS * BATCH // (len(docs) + 1)))
    for epoch in range(epochs):
        if epoch:
            projected = net.projected(net.inputs(feats))
            score = np.concatenate([net.forward(projected, wins[i: i + 1024]) for i in range(0, len(wins), 1024)])
        best = np.maximum.reduceat(score, first)
        top = np.array([np.flatnonzero(score[a:b] == m)[0] + a
                        for a, b, m in zip(first, [*first[1:], len(of)], best, strict=True)])
        other = np.array([rng.integers(a, b) for a, b in zip(first, [*first[1:], len(of)], strict=True)])[y == 0]
        rows = rng.permutation(np.concatenate([top, other]))
        for i in range(0, len(rows), BATCH):
            pick = wins[rows[i: i + BATCH]]
            uniq, inverse = np.unique(pick, return_inverse=True)
            if uniq[0] != 0:
                uniq, inverse = np.concatenate([[0], uniq]), inverse + 1
            mine = feats.pick(uniq[1:] - 1)
            x, tape = net.inputs(mine), {}
            net.forward(net.projected(x), inverse.reshape(pick.shape), tape)
            label, weight = y[of[rows[i: i + BATCH]]], balance[of[rows[i: i + BATCH]]] / len(pick)
            grads, dx = net.gradients(x, tape, label, weight)
            gw, gc = np.zeros_like(net.w["word"]), np.zeros_like(net.w["char"])
            np.add.at(gw, mine.own, dx[1:, :WORD_DIM])
            np.add.at(gc, mine.grams, (dx[1:, WORD_DIM:] / np.maximum(mine.n, 1)[:, None])[mine.owners])
            grads |= {"word": gw, "char": gc}
            step += 1
            for k, gk in grads.items():
                m, v = moments[k]
                m += 0.1 * (gk - m)
                v += 0.01 * (gk * gk - v)
                net.w[k] -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


class Scorer:
    """Scores of whole texts; inputs of words are kept by word."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.projected = self.net.projected(self.net.inputs(Features([])))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if len(self.index) > KNOWN:
            self._reset()
        number, known = self.index.setdefault, len(self.index)
        docs = [np.array([number(w, len(self.index)) + 1 for w in WORDS.findall(t.lower())], np.int64) for t in texts]
        new = Features(list(itertools.islice(self.index, known, None)))
        if len(new):
            more = self.net.projected(self.net.inputs(new))
            self.projected = {s: np.vstack([self.projected[s], more[s][1:]]) for s in "fb"}
        n = np.array([len(window_starts(len(d))) for d in docs])
        wins = np.zeros((n.sum(), WINDOW), np.int64)
        at = 0
        for d, k in zip(docs, n, strict=True):
            padded = np.zeros((k - 1) * STRIDE + WINDOW, np.int64)
            padded[: len(d)] = d[: len(padded)]
            wins[at: at + k] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]
            at += k
        p = np.concatenate([self.net.forward(self.projected, wins[i: i + 1024]) for i in range(0, len(wins), 1024)])
        return np.maximum.reduceat(p, np.cumsum(n) - n)


def batch_scores(scorer: Scorer, texts: list[bytes]) -> np.ndarray:
    """Scores in slices of about a megabyte of text, for bounded memory."""
    out, part, size = [], [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > 1 << 20:
            out.append(scorer.scores(part))
            part, size = [], 0
    if part:
        out.append(scorer.scores(part))
    return np.concatenate(out) if out else np.empty(0, np.float32)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(text, label) of the training rows: fold 2 is held out, and at most
    ``limit`` ids, a third of label 1, by the least hash of the id."""
    y = (labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != 2)
         .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label")))
    half = [y.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
            for v, n in ((0, limit - limit // 3), (1, limit // 3))]
    chosen = F.broadcast(half[0].union(half[1]))  # `limit` pairs of numbers at most
    least = F.min(F.struct(F.xxhash64("text"), "text"))  # one text per id, folded before one task reads them
    return (docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(least.alias("t"))
            .select("doc_id", "t.text", "label"))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(d, t, y) for b in batches for d, t, y in zip(b.column("doc_id").to_pylist(), as_bytes(b.column("text")),
                                                          b.column("label").to_pylist(), strict=True)]
    rows = sorted(rows)  # training doesn't depend on how rows arrive
    net = train([t for _, t, _ in rows], [y for _, _, y in rows])
    yield pa.record_batch([pa.array([net.saved()], pa.binary())], names=["weights"])


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> bytes:
    """Trained weights, of a fixed size. One task trains, and Spark runs it again
    if its executor is lost."""
    sample = labelled_sample(docs, labels, limit).repartition(1)
    row = sample.mapInArrow(_fit, "weights binary").first()
    return bytes(row["weights"]) if row else train([], []).saved()


def with_score(docs: DataFrame, weights: bytes, text_col: str = "text", score_col: str = "score",
               where: float | None = None) -> DataFrame:
    """All columns with the score, or, with ``where``, the rows that score
    below it, without the score."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = docs.schema if where is not None else T.StructType([*docs.schema, T.StructField(score_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Network.loaded(sent.value))
        for batch in batches:
            s = batch_scores(scorer, as_bytes(batch.column(text_col))).astype(np.float64)
            if where is None:
                yield pa.record_batch([*batch.columns, pa.array(s)], names=[*batch.schema.names, score_col])
            else:
                yield batch.filter(pa.array(s < where))
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "score")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that score below the threshold, with all their columns; the
    network is fitted on the labelled ones of ``labelled``."""
    return with_score(docs, fit(labelled, labels), where=THRESHOLD)
