"""Problem 9: subject areas of each document.

Labels are of documents, subjects show in sentences. From a bounded sample of labelled documents a sentence model is estimated: each
sentence belongs to one of its document's labelled subjects or to none, which is found by alternating between assigning sentences and
estimating term distributions. Its output, the share of sentences of every subject, is with source and structure the input of a
classifier chain: for every subject a logistic model that also sees the decisions on the subjects before it, so that subjects that
occur together are modelled. The models are calibrated on held-out documents, and a beam search finds the most probable combination.

Site furniture, which isn't a sentence, is a matter of the whole corpus: the sentences that many documents of a source share are
counted over all documents, labelled or not. The sample is for the models only.

The model goes to the executors (its size is bounded by the sample, the furniture's is checked); all documents are scored in one pass
without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lontar.llm.sourcelines import repeated_hashes
from lontar.session import cut, small_side

_INVISIBLE = re.compile("[­͏؜᠎​-‏‪-‮⁠-⁤︀-️﻿\U0001f000-\U0001faff☀-➿\U000e0000-\U000e007f\x00-\x08\x0b\x0e-\x1f\x7f]")
_BREAK = re.compile(r"(?<=[.!?])[\"”']?\s+(?=[\"“'(]?[^\W\d_a-z])|[\r\n  ]+")
_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f]")
#: A sentence that so many documents of one source share, and this part of the source's documents, digits apart, is site furniture.
FURNITURE, FURNITURE_SHARE = 3, 0.012
#: The furniture of all sources goes to the driver and the executors, eight bytes each; more is refused.
MOST_FURNITURE = 4_000_000
_WORD = re.compile(r"[^\W\d_]{3,}")


def clean(text: str) -> str:
    """Compatibility forms without invisible characters and pictures, which may stand inside words."""
    if text.isascii():
        return _CONTROL.sub("", text)
    return _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))


def sentences(text: str | None) -> list[str]:
    """The sentences of a text: by line and by end marks, not after initials; pieces without a word don't count."""
    out: list[str] = []
    held = ""
    for piece in _BREAK.split(clean(text or "")):
        if held:
            piece, held = f"{held} {piece}", ""
        if piece[-1:] == "." and piece[-2:-1].isalpha() and (len(piece) == 2 or piece[-3] in " \"“("):
            held = piece  # an initial
        elif piece and _WORD.search(piece):
            out.append(piece)
    if held and _WORD.search(held):
        out.append(held)
    return out


def _shape(sentence: str) -> bytes:
    """A sentence without digits, stars, case and spaces: what site furniture has in common."""
    return sentence.lower().replace("\xa0", "").encode("utf-8", "surrogatepass").translate(None, b"0123456789* \t\r\n")


def _hashes(shapes: list[bytes]) -> np.ndarray:
    """64-bit hashes that are the same in every process."""
    return pd.util.hash_array(np.array(shapes, dtype=object), categorize=False).view(np.int64) if shapes else np.empty(0, np.int64)


def _kept(pieces: list[list[str]], sources: list[str | None], furniture: dict[str | None, np.ndarray]) -> list[list[str]]:
    """The sentences of each document that aren't its source's furniture (sorted hashes)."""
    h, at, out = _hashes([_shape(s) for doc in pieces for s in doc]), 0, []
    for doc, source in zip(pieces, sources):
        own, mine = furniture.get(source), h[at : at + len(doc)]
        at += len(doc)
        out.append(doc if own is None else [s for s, gone in zip(doc, own.take(own.searchsorted(mine), mode="clip") == mine) if not gone])
    return out


def find_furniture(documents: DataFrame) -> dict[str | None, np.ndarray]:
    """The sorted hashes of each source's site furniture, counted over all documents that have a text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in filter(len, batches):
            own = [list({_shape(s) for s in sentences(t)}) for t in b["text"]]
            yield pd.DataFrame({"source": b["source"], "hashes": np.split(_hashes([x for doc in own for x in doc]), np.cumsum([len(doc) for doc in own])[:-1])})

    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")).where("text is not null and text != ''")
    hashed = cut(rows.mapInPandas(run, "source string, hashes array<long>"))  # read twice; texts are split once
    found = cut(repeated_hashes(hashed, FURNITURE, FURNITURE_SHARE))
    if found.count() > MOST_FURNITURE:
        raise ValueError(f"over {MOST_FURNITURE} sentences of site furniture")
    return {r["source"]: np.sort(np.array(r["h"], np.int64)) for r in found.groupBy("source").agg(F.collect_list("hash").alias("h")).collect()}


def terms(sentence: str) -> list[str]:
    """Distinct words and pairs of neighbouring words of a sentence."""
    w = _WORD.findall(sentence.lower())
    return list({*w, *map(" ".join, zip(w, w[1:]))})


@dataclass
class SentenceModel:
    """Log-probabilities of terms by subject relative to no subject."""

    vocabulary: dict[str, int]
    weight: np.ndarray  # terms x subjects
    prior: np.ndarray
    furniture: dict[str | None, np.ndarray]

    def scores(self, texts: list[str | None], sources: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Of every sentence of the texts the text's number and the log-odds of each subject against none; site furniture isn't a sentence."""
        get, doc, ids, ends = self.vocabulary.get, [], [], []
        for d, own in enumerate(_kept([sentences(t) for t in texts], sources, self.furniture)):
            for s in own:
                doc.append(d)
                ids += [i for t in terms(s) if (i := get(t)) is not None]
                ends.append(len(ids))
        if not doc:
            return np.empty(0, np.int64), np.empty((0, len(self.prior)))
        score = np.tile(self.prior, (len(doc), 1))
        end = np.array(ends)
        start = np.r_[0, end[:-1]]
        some = np.flatnonzero(end > start)
        for lo in range(0, len(some), 2_000):  # stays in the cache
            at = some[lo : lo + 2_000]
            rows = self.weight[np.array(ids[start[at[0]] : end[at[-1]]], np.int64)]
            score[at] += np.add.reduceat(rows, start[at] - start[at[0]], axis=0)
        return np.array(doc), score


def fit_sentences(texts: list[str], sources: list[str | None], labels: np.ndarray, furniture: dict[str | None, np.ndarray], rounds: int = 5, least: int = 3) -> SentenceModel:
    """Estimate the sentence model from texts and their labels (texts x subjects, 0 or 1)."""
    k = labels.shape[1]
    split = [[terms(s) for s in doc] for doc in _kept([sentences(t) for t in texts], sources, furniture)]
    df = Counter(t for doc in split for t in {x for s in doc for x in s})
    vocabulary = {t: i for i, (t, c) in enumerate(sorted(df.items())) if c >= least}
    vocabulary = {t: i for i, t in enumerate(vocabulary)}
    row, col, doc_of = [], [], []
    for d, doc in enumerate(split):
        for s in doc:
            ids = [vocabulary[t] for t in s if t in vocabulary]
            row += [len(doc_of)] * len(ids)
            col += ids
            doc_of.append(d)
    row_a, col_a, doc_a = np.array(row, np.int64), np.array(col, np.int64), np.array(doc_of, np.int64)
    v, n = len(vocabulary), len(doc_of)
    if not v or not n:
        return SentenceModel({}, np.zeros((0, k)), np.full(k, -1.0), furniture)
    allowed = labels[doc_a] > 0

    def sums(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((n, k))
        for j in range(k):
            out[:, j] = np.bincount(row_a, weights=weight[col_a, j], minlength=n)
        return out

    # start: how much likelier a term is in documents with the subject than in others
    pairs = np.unique(doc_a[row_a] * v + col_a)
    t_of, d_of = pairs % v, pairs // v
    with_s = np.stack([np.bincount(t_of, weights=labels[d_of, j], minlength=v) for j in range(k)], axis=1)
    all_t = np.bincount(t_of, minlength=v)[:, None]
    size = labels.sum(axis=0)[None, :]
    lift = np.log((with_s + 0.5) / (size + 1)) - np.log((all_t - with_s + 0.5) / (len(texts) - size + 1))
    score = sums(np.clip(lift - 1.0, 0, 3.0) * (with_s >= least)) - 1.5
    weight, prior = np.zeros((v, k)), np.zeros(k)
    for _ in range(rounds):
        best = np.where(allowed, score, -np.inf).argmax(axis=1)
        own = np.where((np.where(allowed, score, -np.inf).max(axis=1) > 0), best, k)
        # a sentence that fits a subject its document isn't labelled with says nothing about "none"
        other = (own == k) & (score.max(axis=1) > 1.0)
        counts = np.stack([np.bincount(col_a[own[row_a] == j], minlength=v) for j in range(k)], axis=1).astype(float)
        none = np.bincount(col_a[(own[row_a] == k) & ~other[row_a]], minlength=v).astype(float)
        have = np.bincount(own[~other], minlength=k + 1).astype(float) + 1.0
        total = counts.sum(axis=1) + none
        rate = (total + 0.1) / have.sum()
        # smoothed towards the overall rate, so that subjects stay apart where "none" has never seen a term
        p_s = (counts + 5 * rate[:, None]) / (have[:k] + 5)
        p_none = (none + 5 * rate) / (have[k] + 5)
        weight = np.where((total >= 2)[:, None], np.clip(np.log(p_s) - np.log(p_none)[:, None], -3.0, 8.0), 0.0)
        prior = np.log(have[:k] / have[k]) - 1.0
        score = sums(weight) + prior
    return SentenceModel(vocabulary, weight.astype(np.float32), prior, furniture)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float | np.ndarray = 1.0, centre: np.ndarray | None = None, ridge_intercept: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression, the last one the intercept, by Newton steps; the ridges draw them to ``centre``."""
    penalty = np.r_[np.broadcast_to(ridge, x.shape[1]), ridge_intercept]
    x = np.c_[x, np.ones(len(x))]
    centre = np.zeros(x.shape[1]) if centre is None else centre
    w = centre.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (penalty * (w - centre) ** 2).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty * (w - centre))
        size = 1.0
        while (then := loss(w + size * step)) > now and size > 1e-4:  # a full step may overshoot
            size /= 2
        if then > now:
            break
        w, done, now = w + size * step, now - then < 1e-7 * (1 + abs(now)), then
        if done:
            break
    return w


#: A subject's share of the sentences is binned: a step at each of these.
STEPS = np.arange(1, 31) / 50
#: The log-odds of a subject before anything is learnt: without a sentence, and by share of the sentences.
BEFORE, BY_SHARE = -4.0, 20.0


@dataclass
class Chain:
    """The trained model: sentence model, source priors, chain of calibrated logistic models."""

    names: list[str]
    sentence: SentenceModel
    source_prior: dict[str, np.ndarray]
    base: np.ndarray
    weights: list[np.ndarray]
    scale: np.ndarray  # a, b of each subject's calibration
    beam: int = 8

    def features(self, texts: list[str | None], sources: list[str | None]) -> np.ndarray:
        """Term, source and structure features of documents, a row each: by subject the share of sentences, the mean probability of a
        sentence, the mean evidence of terms, the number of sentences, the share of those about anything and the source's prior; then
        the number of sentences, the share about nothing and the number of subjects met."""
        doc, score = self.sentence.scores(texts, sources)
        k, m = len(self.names), len(texts)
        n = np.bincount(doc, minlength=m)
        best = score.argmax(axis=1) if len(score) else np.empty(0, np.int64)
        subject = np.where(score[np.arange(len(score)), best] > 0, best, -1)
        some = np.maximum(1, n)[:, None]
        mean = lambda x: np.stack([np.bincount(doc, weights=x[:, j], minlength=m) for j in range(k)], axis=1).reshape(m, k) / some
        count = np.bincount(doc[subject >= 0] * k + subject[subject >= 0], minlength=m * k).reshape(m, k).astype(float)
        about = count.sum(axis=1)
        prior = np.array([self.source_prior.get(s or "", self.base) for s in sources]).reshape(m, k)
        none = np.where(n > 0, 1 - about / np.maximum(1, n), 1.0)
        return np.c_[count / some, mean(_sigmoid(score)), mean(np.clip(score - self.sentence.prior, 0, 10)) / 10, np.minimum(count, 4) / 4, count / np.maximum(1, about)[:, None], prior, np.log1p(n), none, (count > 0).sum(axis=1) / k]

    def _x(self, f: np.ndarray, j: int) -> np.ndarray:
        """What subject j's model sees of the documents, its share of the sentences first; the decisions before it follow."""
        k = len(self.names)
        others = np.delete(f[:, :k], j, axis=1).max(axis=1, initial=0.0)
        share = np.c_[f[:, j], f[:, j, None] >= STEPS - 1e-9]
        return np.c_[share, *[f[:, i * k + j] for i in range(1, 6)], others, f[:, 6 * k :]]

    def decode(self, f: np.ndarray) -> np.ndarray:
        """The most probable combination of subjects of each document (documents x subjects, 0 or 1), by beam search along the chain."""
        k, m = len(self.names), len(f)
        score, y = np.zeros((m, 1)), np.zeros((m, 1, k))
        for j in range(k):
            x = self._x(f, j)
            w = self.weights[j]
            z = (x @ w[: x.shape[1]])[:, None] + y @ w[x.shape[1] : -1] + w[-1]
            p = np.clip(_sigmoid(self.scale[j, 0] * z + self.scale[j, 1]), 1e-6, 1 - 1e-6)
            yes = y.copy()
            yes[:, :, j] = 1
            score, y = np.concatenate([score + np.log(p), score + np.log(1 - p)], axis=1), np.concatenate([yes, y], axis=1)
            if score.shape[1] > self.beam:
                top = np.argsort(-score, axis=1, kind="stable")[:, : self.beam]
                score, y = np.take_along_axis(score, top, axis=1), np.take_along_axis(y, top[:, :, None], axis=1)
        return y[np.arange(m), score.argmax(axis=1)]


def fit_chain(texts: list[str], sources: list[str | None], labels: np.ndarray, names: list[str], furniture: dict[str | None, np.ndarray], ridge: float = 0.5, ridge_context: float = 30.0, towards: float = 3.0) -> Chain:
    """Train on texts, sources and labels (texts x subjects); every fifth text calibrates.

    What all subjects have in common is learnt first, from all of them together; each subject's model is drawn towards it by
    ``towards``, so that few labels leave it there and many move it. The subject's own evidence is hardly penalised; sources,
    structure and other subjects are, as labels are few and partly wrong.
    """
    k = len(names)
    base = np.log((labels.sum(axis=0) + 1) / (len(labels) - labels.sum(axis=0) + 1)) if len(labels) else np.full(k, -2.0)
    priors = {}
    for s in {x or "" for x in sources}:
        at = np.array([(x or "") == s for x in sources])
        p = (labels[at].sum(axis=0) + 20 * _sigmoid(base)) / (at.sum() + 20)
        priors[s] = np.log(p / (1 - p))
    model = Chain(names, fit_sentences(texts, sources, labels, furniture), priors, base, [], np.tile([1.0, 0.0], (k, 1)))
    # a sentence model knows the texts it is fitted to too well: each half is described by the other half's
    f = np.zeros((len(texts), 6 * k + 3))
    for half in (0, 1):
        at = [i for i in range(len(texts)) if i % 2 == half]
        rest = [i for i in range(len(texts)) if i % 2 != half]
        if at:
            other = fit_sentences([texts[i] for i in rest], [sources[i] for i in rest], labels[rest], furniture)
            f[at] = replace(model, sentence=other).features([texts[i] for i in at], [sources[i] for i in at])
    held = np.arange(len(texts)) % 5 == 4
    x, y = [model._x(f, j) for j in range(k)], labels.astype(float)
    if not k:
        return model
    width = x[0].shape[1]
    own = len(STEPS) + 5
    penalty = np.r_[np.full(own, ridge), np.full(width - own, ridge_context)]
    stack = lambda at: (np.concatenate([a[at] for a in x]), np.concatenate([y[at, j] for j in range(k)]))
    common = logistic(*stack(~held), penalty, np.r_[BY_SHARE, np.zeros(width - 1), BEFORE])
    calibrated = lambda z, t, centre, r: logistic(z[:, None], t, r, centre, r)
    xs, ys = stack(held)
    scale = calibrated(np.c_[xs, np.ones(len(xs))] @ common, ys, np.array([1.0, 0.0]), 1.0)
    scale = scale if scale[0] > 0.2 else np.array([1.0, 0.0])
    for j in range(k):
        before = y.copy()
        before[:, j:] = 0
        own_x = np.c_[x[j], before]
        w = logistic(own_x[~held], y[~held, j], np.r_[np.maximum(penalty, towards), np.full(k, ridge_context)], np.r_[common[:-1], np.zeros(k), common[-1]])
        model.weights.append(w)
        s = calibrated(np.c_[own_x[held], np.ones(held.sum())] @ w, y[held, j], scale, 10.0)
        model.scale[j] = s if s[0] > 0.2 else scale
    return model


def gather_labels(labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject): labels in the names of ``areas``, either language; a label counts unless most of the document's annotators left it out.

    Labels that name no area, and null ids, are left out; repeated rows count once.
    """
    known = areas.select(F.lower(F.trim(F.col("subject"))).alias("as"), F.col("subject").alias("to")).unionByName(areas.select(F.lower(F.trim(F.col("name_en"))).alias("as"), F.col("subject").alias("to"))).where("`as` is not null and to is not null").dropDuplicates(["as"])
    named = labels.select("doc_id", F.lower(F.trim(F.col("subject"))).alias("as"), F.coalesce(F.col("annotator"), F.lit("")).alias("who")).join(small_side(known), "as").where("doc_id is not null").select("doc_id", F.col("to").alias("subject"), "who").distinct()
    people = named.groupBy("doc_id").agg(F.count_distinct("who").alias("all"))
    votes = named.groupBy("doc_id", "subject").agg(F.count("*").alias("votes"))
    return votes.join(people, "doc_id").where("votes * 2 >= `all`").select("doc_id", "subject")


def train(documents: DataFrame, labels: DataFrame, areas: DataFrame, most_labelled: int = 6000, longest: int = 20_000, seed: int = 7) -> Chain:
    """Train on at most ``most_labelled`` labelled documents, chosen by a seeded hash when there are more; site furniture is counted over all documents.

    What is brought to the driver is bounded by both parameters: labelled documents of over ``longest`` characters aren't trained on
    (they are assigned subjects like all others). ``areas`` must be a short list (under 1000 rows). Documents with null or empty text are left out. Without labelled documents the
    model assigns nothing.
    """
    names = sorted(r[0] for r in areas.select("subject").where("subject is not null").distinct().limit(1000).collect())
    agreed = gather_labels(labels, areas).groupBy("doc_id").agg(F.array_sort(F.collect_set("subject")).alias("subjects"))  # at most as many as there are areas
    chosen = agreed.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most_labelled)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")).where("text is not null and text != ''").where(F.length("text") <= longest).join(chosen, "doc_id").toPandas().sort_values("doc_id")
    y = np.zeros((len(rows), len(names)), np.int64)
    where = {s: j for j, s in enumerate(names)}
    for i, own in enumerate(rows["subjects"]):
        for s in own:
            y[i, where[s]] = 1
    return fit_chain(rows["text"].tolist(), rows["source"].tolist(), y, names, find_furniture(documents))


def assign(documents: DataFrame, model: Chain) -> DataFrame:
    """(doc_id, source, subject): one row for each subject of each document.

    Null, empty and very short texts have no sentence about anything and give no row; texts of any length are read whole; a repeated
    row is assigned as often as it occurs. Other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            for lo in range(0, len(b), 2000):
                part = b.iloc[lo : lo + 2000]
                f = m.features(part["text"].tolist(), part["source"].tolist())
                d, j = np.nonzero(m.decode(f))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy()[d], "source": part["source"].to_numpy()[d], "subject": np.array(m.names, dtype=object)[j]})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")).where("doc_id is not null and text is not null and text != ''")
    return rows.mapInPandas(run, "doc_id long, source string, subject string")


def makeup(assigned: DataFrame) -> DataFrame:
    """(source, subject, documents): the corpus's make-up by subject and source."""
    return assigned.groupBy("source", "subject").agg(F.count("*").alias("documents"))
