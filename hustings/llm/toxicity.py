"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, are trained from document labels."""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import ALNUM, of_text, spare
from hustings.llm.sampling import held_out, sample_ids, sampled

#: Bounds of the training sample: documents of each label, and bytes of a text; of longer ones so many parts are learned from.
SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_PARTS = 3000, 16_384, 4
#: A feature counts if toxic sample documents have it in excess by this log-likelihood ratio; words of a sentence at
#: most (longer ones are parted); bytes of a word's beginning; words whose weights a worker keeps.
LEAST_RATIO, SENTENCE_WORDS, BEGINNING, KEPT_WORDS = 16.0, 40, 6, 500_000
#: Like ALNUM, but marks that end a sentence become line feeds.
SENTENCES = bytes(10 if b in b".!?\n" else a for b, a in enumerate(ALNUM))


def sentences(text: bytes) -> list[list[bytes]]:
    """Sentences as lists of lower-case words, none empty and none of over SENTENCE_WORDS."""
    out = []
    for line in text.translate(SENTENCES).split(b"\n"):
        words = line.split()
        out.extend(words[at : at + SENTENCE_WORDS] for at in range(0, len(words), SENTENCE_WORDS))
    return out


def features(word: bytes) -> list[bytes]:
    """The word itself, and of a longer one how it begins and how long it is, which its near relations share."""
    return [word] if len(word) <= BEGINNING else [word, b"%s %d" % (word[:BEGINNING], len(word))]


class Weights(dict):
    """What a word adds to its sentence, kept for words that were asked for."""

    def __init__(self, by_feature: dict[bytes, float]):
        super().__init__()
        self.by_feature = by_feature

    def __missing__(self, word: bytes) -> float:
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = value = sum(self.by_feature.get(f, 0.0) for f in features(word))
        return value


def feature_set(text: str) -> set[bytes]:
    return {f for s in sentences(text.encode()) for w in s for f in features(w)}


def telling(sample: list[tuple[str, int, float]]) -> list[bytes]:
    """Features that toxic documents have in excess, by the log-likelihood ratio of their weighted counts."""
    positive, weighted = Counter(), Counter()
    for text, label, _ in sample:
        if label:
            positive.update(feature_set(text))
    positive = Counter({f: n for f, n in positive.items() if n > 2})
    for text, _, w in sample:
        for f in feature_set(text):
            if f in positive:
                weighted[f] += w
    toxic = [w for _, label, w in sample if label]
    rate, scale = sum(toxic) / sum(w for *_, w in sample), toxic[0]
    kept = []
    for f, n in positive.items():
        got, total = n * scale, max(weighted[f], n * scale)
        share = got / total
        ratio = 2 * (n * np.log(share / rate) + ((total - got) * np.log((1 - share) / (1 - rate)) if share < 1 else 0.0))
        if share * (1 - rate) > 2 * rate * (1 - share) and ratio >= LEAST_RATIO:
            kept.append(f)
    return sorted(kept)


def train(sample: list[tuple[str, int, float]], rounds: int = 300, rate: float = 0.1, decay: float = 2e-6) -> tuple[dict[bytes, float], float]:
    """Weights of features and a bias. A sentence's score is the logistic of the bias and its words' weights; a document's
    is 1 less the product of 1 less each sentence's (noisy-or). Adam lowers the weighted log-loss of document labels."""
    y = np.array([y for _, y, _ in sample], float)
    importance = np.array([w for *_, w in sample])
    index = {f: i for i, f in enumerate(telling(sample))} if 0 < y.sum() < len(y) else {}
    if not index:
        share = np.average(y, weights=importance) if len(y) else 0.0
        return {}, -12.0 if share < 0.5 else 12.0
    words, sentence_of, doc_of = [], [], []
    for d, (text, *_) in enumerate(sample):
        for s in sentences(text.encode()):
            known = [index[f] for w in s for f in features(w) if f in index]
            words += known
            sentence_of += [len(doc_of)] * len(known)
            doc_of.append(d)
    words, sentence_of, doc_of = (np.array(x, np.int64) for x in (words, sentence_of, doc_of))
    importance = importance / importance.mean()
    theta = np.zeros(len(index) + 1)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = theta[-1] + np.bincount(sentence_of, theta[words], len(doc_of))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        any_p = np.clip(1 - np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y))), 1e-6, 1)
        slope = importance[doc_of] * np.where(y[doc_of] == 1, -p * (1 - any_p[doc_of]) / any_p[doc_of], p) / len(y)
        grad = np.append(np.bincount(words, slope[sentence_of], len(index)), slope.sum()) + decay * theta * (np.arange(len(theta)) < len(index))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {w: float(theta[i]) for w, i in index.items()}, float(theta[-1])


def sample_text(text: Column) -> Column:
    """What is learned from a text: all of it, or if it has over SAMPLE_BYTES as many evenly spread parts as SAMPLE_PARTS."""
    size = SAMPLE_BYTES // (4 * SAMPLE_PARTS)  # characters, of at most four bytes
    step = (F.length(text) - size) / (SAMPLE_PARTS - 1)
    parts = F.concat_ws("\n", *(F.substr(text, F.floor(step * k).cast("int") + 1, F.lit(size)) for k in range(SAMPLE_PARTS)))
    return F.when(F.octet_length(text) <= SAMPLE_BYTES, text).otherwise(parts)


def score_toxicity(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, sample_docs: int = SAMPLE_DOCS, threshold: float = 0.5) -> DataFrame:
    """Every row of docs with the named columns (all by default), held_out, score and offending.

    score is the chance that the document would be labelled toxic; offending lists (sentence, score, text) of its
    sentences that score at least threshold, counted from 0. Learns from at most sample_docs documents of each label of
    labels (doc_id, toxic), none of them held out, of long ones from SAMPLE_PARTS parts (SAMPLE_BYTES at most). Text is the only input of a score; missing
    and empty texts have no sentences and score 0; long ones are scored whole. Rows that share a doc_id are scored one by
    one and learned from once, labels that do count as the smallest. Without labels of both kinds every sentence scores as the one kind
    does. Columns of docs named as the new ones give way to them; an empty table gives an empty result.
    """
    new = ("held_out", "score", "offending")
    back = [c for c in docs.columns if c not in new] if columns is None else columns
    text = F.col("text").cast("string")
    ids = sample_ids(labels.filter(~held_out()), "toxic", sample_docs)
    held = docs.sparkSession.sparkContext.broadcast(train(sampled(docs, ids, "toxic", sample_text(text))))
    offending = pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))

    def setup():
        by_feature, bias = held.value
        weights = Weights(by_feature)

        def score(texts: list[bytes]) -> pa.Array:
            parted = [sentences(t) for t in texts]
            flat = [s for d in parted for s in d]
            size = np.fromiter(map(len, flat), np.int64, len(flat))
            known = np.fromiter(map(weights.__getitem__, chain.from_iterable(flat)), np.float64, int(size.sum()))
            z = bias + (np.add.reduceat(known, np.cumsum(size) - size) if len(flat) else np.empty(0))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            count = np.array([len(d) for d in parted], np.int64)
            quiet = np.bincount(np.repeat(np.arange(len(parted)), count), np.log1p(-np.minimum(p, 1 - 1e-12)), len(parted))
            first, found = np.cumsum(count) - count, [[] for _ in parted]
            high = np.flatnonzero(p >= threshold)
            for i, d in zip(high.tolist(), (np.searchsorted(first, high, side="right") - 1).tolist(), strict=True):
                found[d].append({"sentence": i - int(first[d]), "score": float(p[i]), "text": b" ".join(flat[i]).decode()})
            return pa.StructArray.from_arrays([pa.array(1 - np.exp(quiet)), pa.array(found, offending)], ["score", "offending"])

        return score

    inner = spare(docs.select(*back), "_told")
    schema = "score double, offending array<struct<sentence: int, score: double, text: string>>"
    told = docs.select(*back, held_out().alias("held_out"), of_text(docs.sparkSession, text, schema, setup).alias(inner))
    return told.select(*back, "held_out", *(F.col(inner)[c].alias(c) for c in ("score", "offending")))
