"""Toxic spans by a linear-chain conditional random field over words.

Fitting. Of the labelled rows it takes the SAMPLE_DOCS of smallest hash per
label, with their whole texts. Each word has features: itself, its prefixes of
PREFIXES letters and its endings of SUFFIXES. A feature is a candidate if it
occurs in at least LEAST toxic texts and ODDS times oftener (by share of texts)
than in clean ones. Documents say only that some token is toxic, so token labels
are estimated: at first all words with a candidate feature in toxic texts; then,
in ROUNDS, the field is trained on windows of these labels, and its marginals,
given that a toxic text has at least one toxic token, are the next labels. What
the field gives little weight is dropped. A logistic function of a text's
marginals is fitted on the document labels.

Scoring. A word without weighted features is neutral: all neutral words have
the same potentials, so a run of them is one power of one matrix, and forward
and backward passes step from one weighted word to the next with exactly the
marginals of the full chain. A document's score comes from the largest
marginal, the expected number of toxic words and their share; words with a
marginal of 0.5 or more are the offending spans (code points, end exclusive).

Null and empty texts have no words and get the score of the intercept, below
0.5. With labels of one kind only, every score is the share of that kind.
Labels that are null are not used, nor are null ids; several labels of one
document are rows of their own; of rows that repeat an id, fitting takes the text
that sorts first. Repeated documents are scored row by row, texts whole however
long; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import collect_bounded, map_batches
from .crf import LinearChain

SAMPLE_DOCS = 2000
PREFIXES, SUFFIXES = (3, 4, 5, 6), (4, 5)
#: Texts and odds from which a feature is a candidate; rounds in which token labels
#: are estimated anew; weight below which a feature is dropped.
LEAST, ODDS, ROUNDS, DROPPED = 4, 6.0, 3, 0.3
WINDOW, EPOCHS = 24, 8
MAX_MEMO = 100_000
#: Powers of the neutral matrix kept for each length; longer runs are squared.
KEPT_POWERS = 64
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return ["=" + word, *(f"{n}{word[:n]}" for n in PREFIXES if len(word) > n), *(f"-{word[-n:]}" for n in SUFFIXES if len(word) > n)]


class Model:
    """weights: label-1 minus label-0 potential by feature. The chain's neutral
    potentials are 0 for both labels."""

    def __init__(self, weights: dict[str, float], neutral: float, steps: np.ndarray, start: np.ndarray, logistic: list[float]):
        self.weights, self.neutral, self.logistic = weights, neutral, logistic
        self.steps, self.start = np.exp(steps - steps.max()), np.exp(start - start.max())
        self.known: dict[str, float] = {}
        one = self.steps * np.exp([0.0, neutral])
        self.powers, self.doubled = [np.eye(2)], [one / one.sum()]
        for _ in range(KEPT_POWERS):
            p = self.powers[-1] @ one
            self.powers.append(p / p.sum())
        for _ in range(40):
            p = self.doubled[-1] @ self.doubled[-1]
            self.doubled.append(p / p.sum())

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def weight(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            get = self.weights.get
            got = sum(w for f in features(word) if (w := get(f)) is not None)
            if len(self.known) >= MAX_MEMO:
                self.known.clear()
            self.known[word] = got
        return got

    def power(self, n: int) -> np.ndarray:
        """The matrix of n neutral words, up to scale; long runs by squaring."""
        if n < len(self.powers):
            return self.powers[n]
        out = np.eye(2)
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = out @ self.doubled[k]
                out /= out.sum()
        return out

    def marginals(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        """Places of the weighted words and their probabilities of label 1."""
        known, weight = self.known.get, self.weight
        at, emit = [], []
        for i, w in enumerate(words):
            x = known(w)
            if x is None:
                x = weight(w)
            if x:
                at.append(i)
                emit.append(x)
        if not at:
            return [], np.zeros(0)
        e = np.exp(np.clip(np.array(emit) + self.neutral, -30, 30))
        n = len(at)
        s, (p00, p01), (p10, p11) = self.start, *self.steps.tolist()
        forward, a0, a1, past = [], s[0], s[1], -1
        for i, x in zip(at, e.tolist(), strict=True):
            gap = i - past - 1
            if past < 0:
                if gap:  # the chain starts with neutral words
                    a1 *= math.exp(self.neutral)
                    v = np.array([a0, a1]) @ self.power(gap - 1)
                    a0, a1 = v[0] * p00 + v[1] * p10, v[0] * p01 + v[1] * p11
            else:
                if gap:
                    v = np.array([a0, a1]) @ self.power(gap)
                    a0, a1 = v
                a0, a1 = a0 * p00 + a1 * p10, a0 * p01 + a1 * p11
            a1 *= x
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            forward.append((a0, a1))
            past = i
        out = np.zeros(n)
        b = np.ones(2)
        if rest := len(words) - 1 - at[-1]:
            b = self.power(rest) @ b
        for k in range(n - 1, -1, -1):
            b /= b.sum()
            f0, f1 = forward[k]
            y0, y1 = f0 * b[0], f1 * b[1]
            out[k] = y1 / (y0 + y1)
            if k:
                c0, c1 = b[0], b[1] * e[k]
                b = np.array([p00 * c0 + p01 * c1, p10 * c0 + p11 * c1])
                if gap := at[k] - at[k - 1] - 1:
                    b = self.power(gap) @ b
        return at, out

    def summary(self, n: int, marginals: np.ndarray) -> tuple[float, float, float]:
        if not len(marginals):
            return 0.0, 0.0, 0.0
        expected = float(marginals.sum())
        return float(marginals.max()), math.log1p(expected), min(1.0, 10 * expected / n)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int]]]:
        """(score, offending spans)."""
        text = text or ""
        lower = text.lower()
        words = WORD.findall(lower)
        at, p = self.marginals(words)
        b, *w = self.logistic
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, b + sum(x * y for x, y in zip(w, self.summary(len(words), p), strict=True))))))
        spans = []
        if (hot := {i for i, x in zip(at, p.tolist(), strict=True) if x >= 0.5}):
            # lower-casing may change lengths; then words are found in the text itself
            spans = [(m.start(), m.end()) for i, m in enumerate(WORD.finditer(lower if len(lower) == len(text) else text)) if i in hot]
        return score, spans


def sample(texts: DataFrame, marks: DataFrame) -> list[tuple[str, int]]:
    """(text, toxic) of a bounded sample: per label the rows of smallest hash.
    texts: (id, text); marks: (id, toxic). Ids are ranked on the small table."""
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull()).select("id", "toxic").distinct()
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id")
    ranked = marks.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLE_DOCS)
    picked = collect_bounded(ranked, 2 * SAMPLE_DOCS, "toxicity sample")
    if not picked:
        return []
    usable = texts.filter(F.col("id").isin([r.id for r in picked]) & F.col("text").isNotNull())
    said = collect_bounded(usable.groupBy("id").agg(F.min("text").alias("text")), 2 * SAMPLE_DOCS, "toxicity sample")
    found: dict = {}
    for r in picked:
        found.setdefault(r.id, set()).add(r.toxic)
    return sorted({(r.text, y) for r in said for y in found[r.id]})


def fit(texts: DataFrame, marks: DataFrame) -> Model:
    """A model from (id, text) and (id, toxic)."""
    return train(sample(texts, marks))


def train(rows: list[tuple[str, int]]) -> Model:
    texts = [WORD.findall(t.lower()) for t, _ in rows]
    marks = [y for _, y in rows]
    toxic, clean = sum(marks), len(marks) - sum(marks)
    if not toxic or not clean:
        share = (toxic + 0.01) / (len(marks) + 1.0)
        return Model({}, 0.0, np.zeros((2, 2)), np.zeros(2), [math.log(share / (1 - share)), 0.0, 0.0, 0.0])
    counts = Counter(), Counter()
    for words, y in zip(texts, marks, strict=True):
        counts[y].update({f for w in set(words) for f in features(w)})
    telling = {f for f, n in counts[1].items() if n >= LEAST and n / toxic >= ODDS * (counts[0][f] + 0.5) / clean}
    number = {f: k + 2 for k, f in enumerate(sorted(telling))}
    slots = 2 + len(PREFIXES) + len(SUFFIXES)
    neutral = [1] + [0] * (slots - 1)  # feature 1 is the bias that all words have

    def coded(word):
        own = [number[f] for f in features(word) if f in number]
        return [1, *own, *[0] * (slots - 1 - len(own))] if own else neutral

    seqs, hot, there, owner = [], [], [], []
    for k, words in enumerate(texts):
        for i in range(0, len(words), WINDOW):
            part = [coded(w) for w in words[i : i + WINDOW]]
            marked = [r is not neutral for r in part]
            if any(marked) or i == 0:
                rest = WINDOW - len(part)
                seqs.append(part + [[0] * slots] * rest)
                hot.append(marked + [False] * rest)
                there.append([True] * len(part) + [False] * rest)
                owner.append(k)
    seqs, hot, there, owner = np.array(seqs, np.int32).reshape(-1, WINDOW, slots), np.array(hot).reshape(-1, WINDOW), np.array(there).reshape(-1, WINDOW), np.array(owner, np.int64)
    # A clean text has no toxic token. In a toxic one the candidates are, at first;
    # then each as likely as the field finds it, given that the text has at least one.
    likely = hot * np.array(marks, float)[owner][:, None]
    chain = LinearChain(len(number) + 2, 2)
    for round_ in range(ROUNDS):
        chain.fit(seqs, np.stack([1 - likely, likely], -1), there, EPOCHS)
        if round_ + 1 < ROUNDS:
            p = np.zeros(hot.shape)
            for at in np.array_split(np.arange(len(seqs)), max(1, len(seqs) // 1024)):
                p[at] = chain.forward_backward(chain.emissions(seqs[at]), there[at])[1][..., 1]
            p = np.clip(p * (likely > 0), 0, 1 - 1e-9)
            none = np.bincount(owner, np.log1p(-p).sum(1), len(texts))
            some = np.maximum(1e-9, 1 - np.exp(none))[owner][:, None]
            likely = np.minimum(1, p / some)
    gain = chain.weights[:, 1] - chain.weights[:, 0]
    model = Model({f: float(gain[k]) for f, k in number.items() if gain[k] >= DROPPED}, float(gain[1]), chain.steps, chain.start, [0.0] * 4)
    x = np.array([[1.0, *model.summary(len(w), model.marginals(w)[1])] for w in texts])
    t = np.array(marks, float)
    coefficients = np.array([-1.0, 1.0, 1.0, 1.0])
    for _ in range(40):  # Newton's method with a ridge; the intercept is free
        p = 1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30)))
        slope = x.T @ (p - t) + np.array([0, 1, 1, 1]) * 0.5 * coefficients
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.5, 0.5, 0.5])
        coefficients -= np.linalg.solve(curve, slope)
    model.logistic = coefficients.tolist()
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans array of (start, end)) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(rows):
        found = [shared.value.score(t) for t in rows["text"]]
        return {"id": rows["id"], "score": [s for s, _ in found], "spans": [[{"start": a, "end": b} for a, b in x] for _, x in found]}

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return map_batches(picked, work, f"id {kind}, score double, spans array<struct<start:bigint,end:bigint>>").withColumnRenamed("id", id_col)
