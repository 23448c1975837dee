"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels.

Voters are lexicons of words and patterns (beginnings of words, shouting). Some are given; more are induced from the
labelled rows that may be learned from, as the given lexicon covers one language. Labels serve for that, for the share
of toxic texts and for nothing else: the label model sees the votes alone, on labelled and unlabelled texts alike.

It is a factor graph over a text's hidden label y and its votes v: exp(sum of b_j v_j + a_j v_j y + c_jk v_j v_k). The
accuracies a_j and correlations c_jk are fitted by expectation and maximisation of the votes' pseudo-likelihood (each
vote given the others and y). The first rounds have no correlations; pairs that then still fire together beyond what the
label explains get one, so that they don't count twice. The classifier sees all words and word beginnings that tell the
posterior labels apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from legispark.llm import text as T
from legispark.llm.quality import sample, trainable

#: A small given lexicon, in groups of one meaning.
LEXICON = {
    "wits": ["idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "fool"],
    "worth": ["worthless", "pathetic", "loser", "losers", "useless"],
    "dirt": ["trash", "scum", "disgusting", "filth", "vermin", "garbage"],
    "scorn": ["clown", "clowns", "shut", "hate"],
}
#: Lengths of word beginnings, in code points.
BEGINNINGS = range(4, 9)
#: The bound of the sample: labelled rows, unlabelled ones, and bytes of each.
SAMPLE_ROWS, UNLABELLED_ROWS, SAMPLE_BYTES = 4000, 2000, 1 << 16
#: Induced voters and features at most; the least share of ones among a feature's texts, and standard deviations above chance.
MOST_VOTERS, MOST_FEATURES, LEAST_SHARE, LEAST_SCORE = 100, 300, 0.85, 6.0
THRESHOLD = 0.3
#: What a voter's accuracy is taken to be before its votes are seen (log odds), how firmly (texts), and the correlation of what the label leaves from which a pair gets a factor.
PRIOR_ODDS, FIRMNESS, RELATED = 7.0, 4.0, 0.7
#: Rounds of expectation and maximisation without and with correlations, steps of each maximisation.
FREE_ROUNDS, ROUNDS, STEPS = 4, 8, 60


def _features(words: pa.Array) -> list[tuple[str, pa.Array]]:
    """The kinds of features of each word: itself, and its beginnings, where it is longer than they are."""
    n = pc.utf8_length(words)
    out = [("=", words)]
    for k in BEGINNINGS:
        out.append((f"{k}", pc.if_else(pc.greater(n, k), pc.utf8_slice_codeunits(words, 0, k), pa.scalar(None, pa.string()))))
    return out


def _split(text: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    flat, at = T.split(T.recoded(text, T.ALNUM))
    code, words = T.coded(flat)
    return code, words, at


@dataclass
class LabelModel:
    """bias and accuracy of each voter, correlation of each pair (symmetric, no diagonal), and the offset of the label's log odds."""

    bias: np.ndarray
    accuracy: np.ndarray
    correlation: np.ndarray
    offset: float = 0.0

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """The label's log odds; the correlations are the same for either label and cancel."""
        return votes @ self.accuracy + self.offset

    def calibrated(self, votes: np.ndarray, share: float) -> np.ndarray:
        """The posteriors, with the offset at which they make up the given share."""
        z, low, high = votes @ self.accuracy, -60.0, 60.0
        for _ in range(60):
            self.offset = (low + high) / 2
            q = 1 / (1 + np.exp(-np.clip(z + self.offset, -40, 40)))
            low, high = (self.offset, high) if q.mean() < share else (low, self.offset)
        return q


def label_model(votes: np.ndarray, share: float) -> tuple[LabelModel, np.ndarray]:
    """votes: whether each voter fires on each text; share: of texts with label 1. Returns the model and the posteriors.

    A voter that doesn't fire abstains. No labels are seen: a voter is taken to speak for label 1 until its votes say
    otherwise, and the posteriors start from whether any voter fires.
    """
    v = votes.astype(np.float64)
    n, m = v.shape
    share = float(np.clip(share, 0.005, 0.995))
    start = v.any(axis=1)
    q = np.where(start, min(0.95, share / max(start.mean(), 1e-9)), 0.01) if m else np.full(n, share)
    rate = np.clip(v.mean(axis=0), 1e-4, 1 - 1e-4) if n else np.full(m, 0.5)
    model = LabelModel(np.log(rate / (1 - rate)) - PRIOR_ODDS * 0.5, np.full(m, PRIOR_ODDS), np.zeros((m, m)))
    if not m or not n:
        return model, model.calibrated(v, share)
    paired, prior = np.zeros((m, m)), model.accuracy
    for k in range(FREE_ROUNDS + ROUNDS):
        if k == FREE_ROUNDS:
            base = model.bias + v @ model.correlation
            left = v - q[:, None] / (1 + np.exp(-base - model.accuracy)) - (1 - q[:, None]) / (1 + np.exp(-base))
            size = np.sqrt((left**2).sum(axis=0)) + 1e-9
            paired = (left.T @ left / size[:, None] / size[None, :] >= RELATED) & ~np.eye(m, dtype=bool)
            beside = (paired * (v.T @ v)).sum(axis=0) / np.maximum(v.sum(axis=0), 1)
            prior = PRIOR_ODDS / (1 + beside)  # related voters that fire together share what one is taken to tell
            model.accuracy = np.minimum(model.accuracy, prior)
        first, second, t = {}, {}, 0
        for _ in range(STEPS):
            t += 1
            base = model.bias + v @ model.correlation
            p0, p1 = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (base, base + model.accuracy))
            left1 = q[:, None] * (v - p1)
            left = left1 + (1 - q)[:, None] * (v - p0)
            pull = v.T @ left / n
            pull = (pull + pull.T) * paired
            up = {"bias": left.sum(axis=0) / n, "accuracy": left1.sum(axis=0) / n - FIRMNESS * (model.accuracy - prior) / n, "correlation": pull}
            for name, g in up.items():
                first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
                step = 0.1 * (first[name] / (1 - 0.9**t)) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-6)
                setattr(model, name, getattr(model, name) + step)
            model.accuracy = np.maximum(model.accuracy, 0)  # such a voter speaks for label 1 or not at all
        q = model.calibrated(v, share)
    return model, q


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias for soft labels, by Adam on the whole sample."""
    w, b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = np.append(x.T @ (p - y) / len(y) + decay * w, (p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


@dataclass
class Model:
    weights: dict[str, tuple[pa.Array, np.ndarray]]  # by kind: features and their weights
    bias: float

    def score(self, text: pa.Array) -> np.ndarray:
        code, words, at = _split(text)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        z = np.full(len(at) - 1, self.bias)
        for kind, values in _features(words):
            known, weight = self.weights.get(kind, (pa.array([], pa.string()), np.zeros(0)))
            if not len(known) or not len(code):
                continue
            own = pc.fill_null(pc.index_in(values, value_set=known, skip_nulls=True), -1).to_numpy(zero_copy_only=False)[code]
            hit = np.flatnonzero(own >= 0)
            pairs = np.unique(doc[hit] * len(known) + own[hit])
            np.add.at(z, pairs // len(known), weight[pairs % len(known)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Sample:
    """Texts as numbered words; features are looked at one kind at a time, so no text's whole set of them is held."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.code, self.words, at = _split(pa.array(texts, pa.string()))
        self.doc = np.repeat(np.arange(self.n), np.diff(at))

    def pairs(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """values: a feature of each word, or null. Each text and feature that it has, once, and the features."""
        both = values.dictionary_encode()
        own = pc.fill_null(both.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[self.code]
        size = max(1, len(both.dictionary))
        met = np.unique(self.doc[own >= 0] * size + own[own >= 0])
        return met // size, met % size, both.dictionary

    def having(self, words: list[str]) -> np.ndarray:
        """The texts with any of the words."""
        known = pc.is_in(self.words, value_set=pa.array(words, pa.string())).to_numpy(zero_copy_only=False)
        return np.unique(self.doc[known[self.code]]) if len(self.code) else np.zeros(0, np.int64)

    def with_features(self, wanted: list[tuple[str, str]]) -> list[np.ndarray]:
        """The texts with each feature (kind, value)."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(wanted)
        for kind, values in _features(self.words):
            place = {value: k for k, (own, value) in enumerate(wanted) if own == kind}
            if place and len(self.code):
                at = pc.fill_null(pc.index_in(values, value_set=pa.array(list(place), pa.string()), skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)[self.code]
                for i, k in enumerate(place.values()):
                    out[k] = np.unique(self.doc[at == i])
        return out

    def telling(self, y: np.ndarray, most: int) -> list[tuple[str, str, np.ndarray]]:
        """Features (kind, value, texts) that texts with high y have and others don't, the strongest first; of those in the same texts, one."""
        prior = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        found = []
        for kind, values in _features(self.words):
            doc, feature, names = self.pairs(values)
            n, one = np.bincount(feature, minlength=len(names)), np.bincount(feature, weights=y[doc], minlength=len(names))
            score = (one - prior * n) / np.sqrt(np.maximum(n, 1) * prior * (1 - prior))
            good = (one >= LEAST_SHARE * n) & (score >= LEAST_SCORE)
            doc, feature = doc[good[feature]], feature[good[feature]]
            order = np.argsort(feature, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(feature[order])) + 1) if len(order) else []:
                k = int(feature[own[0]])
                found.append((-float(score[k]), kind != "=", kind, names[k].as_py(), doc[own]))
        found.sort(key=lambda x: x[:4])
        out = {}
        for _, _, kind, value, docs in found:
            out.setdefault(docs.tobytes(), (kind, value, docs))
        return list(out.values())[:most]

    def matrix(self, columns: list[np.ndarray], kind: type) -> np.ndarray:
        out = np.zeros((self.n, len(columns)), kind)
        for k, docs in enumerate(columns):
            out[docs, k] = 1
        return out


def train(texts: list[str], labels: list[int | None]) -> Model:
    """labels: 0, 1, or None for an unlabelled text. Without labelled texts of both kinds, the share of ones alone."""
    order = sorted(range(len(texts)), key=lambda k: labels[k] is None)  # the labelled ones first
    y = np.array([labels[k] for k in order if labels[k] is not None], float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(set(y.tolist())) < 2:
        return Model({}, float(np.log(share / (1 - share))))
    known = Sample([texts[k] for k in order[: len(y)]])
    found = known.telling(y, MOST_VOTERS)
    every = Sample([texts[k] for k in order])
    voters = [every.having(words) for words in LEXICON.values()] + [every.having([w]) for words in LEXICON.values() for w in words] + every.with_features([(kind, value) for kind, value, _ in found])
    voters = list({d.tobytes(): d for d in voters if len(d)}.values())  # those that always agree are one
    _, q = label_model(every.matrix(voters, bool), share)
    features = every.telling(q, MOST_FEATURES)
    w, b = logistic(every.matrix([d for _, _, d in features], np.float32), q)
    kinds: dict[str, tuple[list[str], list[float]]] = {}
    for (kind, value, _), weight in zip(features, w.tolist(), strict=True):
        kinds.setdefault(kind, ([], []))
        kinds[kind][0].append(value)
        kinds[kind][1].append(weight)
    return Model({k: (pa.array(v, pa.string()), np.array(u)) for k, (v, u) in kinds.items()}, b)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, unlabelled: int = UNLABELLED_ROWS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """The model, from a bounded sample on the driver."""
    found = sample(docs, labels, "toxic", trainable(), rows, most_bytes, unlabelled)
    return train([r.text for r in found], [r.label if r.label is None else int(r.label) for r in found])


def scored(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """docs' columns but for the text, and score (0 to 1, higher: toxic likelier), predicted.

    Null, empty and wordless texts get the bias's score. Rows that repeat get equal scores; an empty table gives an
    empty result. Columns of docs that are named like the new ones are replaced.
    """
    shared = spark.sparkContext.broadcast(model)  # MOST_FEATURES at most

    def values(text: pa.Array) -> list:
        score = shared.value.score(text)
        return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

    return T.annotated(docs, text_col, {"score": "double", "predicted": "int"}, values)
