"""Toxic spans by a linear-chain conditional random field.

Labels are of documents, so the tokens of a bounded sample of labelled documents are
labelled first: in a toxic document, a token is toxic if its word or one of its stems
(first 4, 5 or 6 letters) occurs far more often in toxic documents than in others, beyond
what chance explains (log-likelihood ratio).  On
these token labels a two-state CRF is fitted (features: word and stems with a high
log-odds; a bias; transitions) by gradient steps on its exact likelihood.

Scoring runs forward and backward over every token of every text.  Most tokens have no
feature and so the same potentials; a run of them is one power of the transition
matrix.  The marginal of each token with a feature is the probability that it is toxic;
the document's score is 1 - product of (1 - marginal); tokens of marginal 0.5 or more
are its offending spans, as character offsets.

NULL, empty texts and texts without a featured token score 0 without spans.  Equal texts
score equally.  Neither ids nor other columns enter a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import rows_of, stored, text_of

SAMPLE = 8000          # labelled documents of each class, about, from which features are counted
FIT = 600              # documents of each class at most whose tokens the CRF is fitted on
FIT_TOKENS = 200       # tokens of such a document, from one before its first toxic token on
FEATURES = 4000        # features at most
STEMS = (4, 5, 6)
ODDS = 2.5             # log-odds of a feature, at least
G2 = 25.0              # log-likelihood ratio of a feature, at least
KNOWN = 400_000

_TOKEN = re.compile(r"\w+")


def features_of(token: str) -> list[str]:
    w = token.lower()
    return ["=" + w, *(f"{w[:k]}*" for k in STEMS if len(w) >= k)]


# --- fitting on a bounded sample -----------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of about ``sample`` label rows of each class, all if there are fewer: those
    whose id's hash is under the class's share of it."""
    ids = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic").distinct()
    sizes = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, sample / max(1, sizes.get(1, 0))).otherwise(sample / max(1, sizes.get(0, 0)))
    few = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
    few = stored(few, "toxic-sample")                          # about 2 * sample rows
    return stored(docs.join(F.broadcast(few), "doc_id").select(text_of("text").alias("text"), "toxic")
                  .dropDuplicates(["text", "toxic"]), "toxic-sample")


def feature_odds(sample: DataFrame, n: int = FEATURES) -> dict[str, float]:
    """Features by the log-odds of their document frequencies, the ``n`` most frequent above
    ``ODDS``."""

    def count(batches):
        pos, neg = Counter(), Counter()
        for b in batches:
            r = rows_of(b)
            for text, toxic in zip(r["text"], r["toxic"]):
                words = set(_TOKEN.findall(text))
                (pos if toxic else neg).update({f for w in words for f in features_of(w)})
        keys = list(pos.keys() | neg.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([pos[k] for k in keys], pa.int64()),
             pa.array([neg[k] for k in keys], pa.int64())], names=["feature", "pos", "neg"])

    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = size.get(1, 0) + 1, size.get(0, 0) + 1
    odds = (F.log((F.col("pos") + 0.5) / n_pos) - F.log((F.col("neg") + 0.5) / n_neg))
    share = n_pos / (n_pos + n_neg)
    both = F.col("pos") + F.col("neg")
    part = lambda n, p: F.when(n > 0, n * F.log(n / (both * p))).otherwise(0.0)
    g2 = 2 * (part(F.col("pos"), share) + part(F.col("neg"), 1 - share))
    top = (sample.mapInArrow(count, "feature string, pos bigint, neg bigint")
           .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
           .withColumn("odds", odds).where((F.col("odds") >= ODDS) & (g2 >= G2))
           .orderBy(F.desc("pos"), "feature").limit(n).collect())
    return {r["feature"]: r["odds"] for r in top}


def token_labels(tokens: list[str], toxic: int, odds: dict[str, float]) -> list[int]:
    return [int(bool(toxic) and any(f in odds for f in features_of(t))) for t in tokens]


class Chain:
    """The fitted model: weights of features, bias of the toxic state, transitions."""

    def __init__(self, weights: dict[str, float], bias: float, moves):
        self.weights, self.bias, self.moves = weights, float(bias), np.asarray(moves, dtype=float)

    def emission(self, token: str) -> float | None:
        """Score of the toxic state; None without a feature."""
        found = [self.weights[f] for f in features_of(token) if f in self.weights]
        return sum(found) if found else None


def fit_chain(sequences: list[tuple[list[str], list[int]]], odds: dict[str, float],
              steps: int = 80, rate: float = 0.3, l2: float = 0.01) -> Chain:
    """Adam steps on the log-likelihood of the labelled sequences, all side by side."""
    names = sorted(odds)
    index = {f: k for k, f in enumerate(names)}
    rows = [(s, y) for s, y in sequences if s]
    moves, weights, bias = np.zeros((2, 2)), np.zeros(len(names)), -3.0
    if not rows:
        return Chain(dict(zip(names, weights)), bias, moves)
    n, length = len(rows), max(len(s) for s, _ in rows)
    mask, gold = np.zeros((length, n)), np.zeros((length, n), dtype=int)
    at_t, at_b, at_f = [], [], []
    for b, (tokens, y) in enumerate(rows):
        mask[:len(tokens), b] = 1
        gold[:len(tokens), b] = y
        for t, token in enumerate(tokens):
            for f in features_of(token):
                if f in index:
                    at_t.append(t), at_b.append(b), at_f.append(index[f])
    at_t, at_b, at_f = (np.array(x, dtype=int) for x in (at_t, at_b, at_f))
    theta = np.concatenate([weights, [bias], moves.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    both = mask[1:] * mask[:-1]
    seen_moves = np.array([[(both * (gold[:-1] == i) * (gold[1:] == j)).sum() for j in (0, 1)] for i in (0, 1)])
    for step in range(1, steps + 1):
        w, bias, moves = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        e = np.full((length, n), bias)
        np.add.at(e, (at_t, at_b), w[at_f])
        pot = np.stack([np.ones_like(e), np.exp(np.clip(e, -30, 30))], axis=-1)
        move = np.exp(moves)
        alpha, beta = np.zeros((length, n, 2)), np.ones((length, n, 2))
        alpha[0] = pot[0] / pot[0].sum(-1, keepdims=True)
        for t in range(1, length):
            a = (alpha[t - 1] @ move) * pot[t]
            a /= a.sum(-1, keepdims=True)
            alpha[t] = np.where(mask[t][:, None] > 0, a, alpha[t - 1])
        for t in range(length - 2, -1, -1):
            b = (pot[t + 1] * beta[t + 1]) @ move.T
            b /= b.sum(-1, keepdims=True)
            beta[t] = np.where(mask[t + 1][:, None] > 0, b, 1.0)
        p = alpha * beta
        p = p[..., 1] / p.sum(-1)
        pair = alpha[:-1, :, :, None] * move * (pot[1:] * beta[1:])[:, :, None, :]
        pair /= pair.sum((-1, -2), keepdims=True)
        error = (gold - p) * mask
        g_w = np.zeros(len(names))
        np.add.at(g_w, at_f, error[at_t, at_b])
        g_m = seen_moves - (pair * both[..., None, None]).sum((0, 1))
        g = np.concatenate([g_w, [error.sum()], g_m.ravel()]) / n - l2 / n * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Chain(dict(zip(names, theta[:-5])), theta[-5], theta[-4:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fit: int = FIT) -> Chain:
    """The chain fitted on labelled rows; ``labels`` holds only rows that may be learned from."""
    rows = labelled_sample(docs, labels, sample)
    odds = feature_odds(rows)
    sequences = []
    for k in (1, 0):
        few = rows.where(F.col("toxic") == k).orderBy(F.xxhash64("text"), "text").limit(fit)
        few = few.mapInArrow(_cut(odds), "tokens array<string>, marks array<int>")
        sequences += [(r["tokens"], r["marks"]) for r in few.collect()]      # 2 * fit rows of FIT_TOKENS
    return fit_chain(sequences, odds)


def _cut(odds: dict[str, float]):
    def run(batches):
        for b in batches:
            r = rows_of(b)
            tokens, marks = [], []
            for text, toxic in zip(r["text"], r["toxic"]):
                words = _TOKEN.findall(text)
                y = token_labels(words, toxic, odds)
                at = max(0, y.index(1) - 1) if 1 in y else 0
                tokens.append(words[at:at + FIT_TOKENS])
                marks.append(y[at:at + FIT_TOKENS])
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int32()))],
                                             names=["tokens", "marks"])
    return run


# --- scoring -------------------------------------------------------------------------------

class Tagger:
    """Exact marginals of featured tokens by forward-backward over the whole text."""

    def __init__(self, chain: Chain):
        self.chain, self.known = chain, {}
        self.move = np.exp(chain.moves)
        self.plain = self.move * np.array([1.0, math.exp(chain.bias)])     # a step onto a plain token
        self.powers: dict[int, np.ndarray] = {}

    def score_of(self, token: str):
        if token in self.known:
            return self.known[token]
        score = self.chain.emission(token)
        if len(token) <= 256:
            if len(self.known) > KNOWN:
                self.known.clear()
            self.known[token] = score
        return score

    def run(self, k: int) -> np.ndarray:
        """``k`` plain tokens in a row, scaled to a greatest entry of 1."""
        if k not in self.powers:
            if len(self.powers) > 100_000:
                self.powers.clear()
            out, base, left = np.eye(2), self.plain, k
            while left:
                if left & 1:
                    out = out @ base
                    out = out / out.max()
                base = base @ base
                base = base / base.max()
                left >>= 1
            self.powers[k] = out
        return self.powers[k]

    def featured(self, tokens: list[str]) -> list[tuple[int, float]]:
        known = self.known
        try:
            return [(k, s) for k, w in enumerate(tokens) if (s := known[w]) is not None]
        except KeyError:
            scores = [self.score_of(w) for w in tokens]
            return [(k, s) for k, s in enumerate(scores) if s is not None]

    def marginals(self, tokens: list[str]) -> list[tuple[int, float]]:
        """(position, probability of the toxic state) of each featured token."""
        found = self.featured(tokens)
        if not found:
            return []
        pots = [np.array([1.0, math.exp(min(30.0, self.chain.bias + s))]) for _, s in found]
        first = np.array([1.0, math.exp(self.chain.bias)])
        alphas, a, at = [], None, -1
        for (k, _), pot in zip(found, pots):
            if a is None:
                a = pot if k == 0 else (first @ self.run(k - 1) @ self.move) * pot
            else:
                a = (a @ self.run(k - at - 1) @ self.move) * pot
            a, at = a / a.sum(), k
            alphas.append(a)
        out, b, after = [], np.ones(2), len(tokens)
        for (k, _), pot, a in zip(reversed(found), reversed(pots), reversed(alphas)):
            b = self.run(after - k - 1) @ b if after == len(tokens) else self.run(after - k - 1) @ self.move @ b
            b = b / b.sum()
            p = a * b
            out.append((k, float(p[1] / p.sum())))
            b, after = pot * b, k
        return out[::-1]

    def tag(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """The document's score and its offending character ranges."""
        found = self.marginals(_TOKEN.findall(text))
        if not found:
            return 0.0, []
        clean = 1.0
        for _, p in found:
            clean *= 1.0 - p
        bad = {k for k, p in found if p >= 0.5}
        spans = [m.span() for k, m in enumerate(_TOKEN.finditer(text)) if k in bad] if bad else []
        return 1.0 - clean, spans


def toxic_spans(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, score, spans) of each row of ``docs`` (doc_id, text)."""
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        tagger = Tagger(shipped.value)
        for b in batches:
            found = [tagger.tag(t) for t in rows_of(b)["text"]]
            spans = pa.array([[{"start": x, "end": y} for x, y in s] for _, s in found],
                             pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in found], pa.float64()), spans],
                                             names=["doc_id", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, spans array<struct<start:int,end:int>>")
