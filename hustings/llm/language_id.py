"""Language identification by a small byte convolutional network, trained in numpy, over windows of whole texts."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.common import of_text, spare
from hustings.llm.sampling import held_out, sample_ids, sampled

#: Documents of each language in the training sample; of each the first, the middle and the last window.
SAMPLE_DOCS = 500
#: Bytes of a window, widths of filters, filters of each width, letters that a window needs to be learned from.
WINDOW, WIDTHS, FILTERS, LETTERS = 256, (2, 3, 4), 8, 20
#: Letters keep their lower case, digits are one symbol, other ASCII is one, bytes from 128 on each have one.
SYMBOL = np.array([b - 128 + 28 if b >= 128 else (b | 32) - 97 + 2 if 97 <= (b | 32) <= 122 and b >= 65 else 1 if 48 <= b <= 57 else 0 for b in range(256)], np.int32)
SYMBOLS = 156
#: Steps that training takes at least, however small the sample.
LEAST_STEPS = 300
#: Bytes of text whose windows are looked at together; a multiple of WINDOW.
PART = 1 << 20
ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class Model:
    languages: list[str]
    filters: list[np.ndarray]  # for each width: (width, SYMBOLS, FILTERS)
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray


def windows(text: bytes) -> np.ndarray:
    """Symbols of consecutive windows of the whole text, the last one filled up with blanks."""
    n = max(1, -(-len(text) // WINDOW))
    return SYMBOL[np.frombuffer(text.ljust(n * WINDOW), np.uint8)].reshape(n, WINDOW)


def sample_windows(text: Column) -> Column:
    """The bytes of a text's first, middle and last window, cut by Spark so that no whole text reaches the driver."""
    raw = F.encode(text, "UTF-8")
    last = F.greatest(F.ceil(F.octet_length(text) / WINDOW), F.lit(1)).cast("int") - 1
    places = F.array_distinct(F.array(F.lit(0), F.floor(last / 2).cast("int"), last))
    return F.when(text.isNotNull(), F.transform(places, lambda i: F.substring(raw, i * WINDOW + 1, F.lit(WINDOW))))


def train(sample: list[tuple[list[bytes], str, float]], rounds: int = 12, rate: float = 0.02, seed: int = 7) -> Model:
    """Adam on the log-loss of windows: convolution, maximum over the window, rectifier, dense layer, softmax.

    Windows of fewer than LETTERS letters are left out, unless a language has no others. Where no window has a letter, or all
    are of one language, the most frequent language is the answer to everything.
    """
    languages = sorted({y for _, y, _ in sample})
    rng = np.random.default_rng(seed)
    model = Model(languages, [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)) for w in WIDTHS], np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model
    x = np.concatenate([windows(bytes(piece)) for pieces, *_ in sample for piece in pieces])
    y = np.array([languages.index(label) for pieces, label, _ in sample for _ in pieces])
    letters = (x > 1).sum(axis=1)
    if letters.max() == 0 or len(languages) < 2:
        model.dense[:], model.bias[:] = 0, np.log([np.mean(y == k) for k in range(len(languages))])
        return model
    enough = np.array([(letters[y == k] >= LETTERS).any() for k in range(len(languages))])
    told = letters >= np.where(enough[y], LETTERS, 1)
    x, y = x[told], y[told]
    parts = [*model.filters, model.shift, model.dense, model.bias]
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(max(rounds, -(-LEAST_STEPS * 128 // len(x)))):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            step += 1
            xb, yb = x[order[at : at + 128]], y[order[at : at + 128]]
            n = len(xb)
            best, peak = [], []
            for f in model.filters:
                conv = sum(f[k][xb[:, k : WINDOW - len(f) + 1 + k]] for k in range(len(f)))
                where = conv.argmax(axis=1)
                best.append(where)
                peak.append(np.take_along_axis(conv, where[:, None, :], axis=1)[:, 0])
            h = np.concatenate(peak, axis=1) + model.shift
            a = np.maximum(h, 0)
            z = a @ model.dense + model.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), yb] -= 1
            p /= n
            dh = (p @ model.dense.T) * (h > 0)
            grads = []
            for i, f in enumerate(model.filters):
                g, d = np.zeros_like(f), dh[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(len(f)):
                    np.add.at(g[k], (np.take_along_axis(xb, best[i] + k, axis=1), np.arange(FILTERS)[None, :]), d)
                grads.append(g)
            grads += [dh.sum(axis=0), a.T @ p, p.sum(axis=0)]
            for i, g in enumerate(grads):
                g = g + 1e-4 * parts[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                parts[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return model


class Predictor:
    """The network for many windows at once. A filter of width w is a sum over pairs of symbols, looked up in tables."""

    def __init__(self, model: Model):
        self.model = model
        two, three, four = (f.astype(np.float32) for f in model.filters)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        # One row holds what a pair adds to each width, so that one look-up serves all of them.
        self.pairs = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
        self.third, self.tail = three[2], pair(four[2], four[3])
        self.dense, self.shift, self.bias = (a.astype(np.float32) for a in (model.dense, model.shift, model.bias))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.model.languages)), np.float32)
        for at in range(0, len(x), 64):
            xb = x[at : at + 64]
            pair = xb[:, :-1] * SYMBOLS + xb[:, 1:]
            base = self.pairs[pair]
            peak = np.concatenate([base[:, :, :FILTERS].max(axis=1), (base[:, :-1, FILTERS : 2 * FILTERS] + self.third[xb[:, 2:]]).max(axis=1), (base[:, :-2, 2 * FILTERS :] + self.tail[pair[:, 2:]]).max(axis=1)], axis=1)
            z = np.maximum(peak + self.shift, 0) @ self.dense + self.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            out[at : at + 64] = p / p.sum(axis=1, keepdims=True)
        return out


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode())))


def learned_from(docs: DataFrame) -> DataFrame:
    """The rows of docs that identify() may learn from."""
    return docs.filter(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())


def identify(docs: DataFrame, columns: list[str] | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Every row of docs with the named columns (all by default), held_out, lang_pred and score.

    Learns from three windows of text, and lang, of at most sample_docs documents of each language, none of them held
    out. A prediction averages the chances of all windows of the whole text, each by its number of letters. Texts that are
    missing or have no letter are 'und' with score 0; so is every text if there is no labelled one to learn from. Only
    the text goes to Python; a very long one is taken in windows. Rows that share a doc_id are predicted one by one and
    learned from once. Columns of docs named as the new ones give way to them; an empty table gives an empty result.
    """
    new = ("held_out", "lang_pred", "score")
    names = [c for c in docs.columns if c not in new]
    back = names if columns is None else columns
    ids = sample_ids(learned_from(docs), "lang", sample_docs)
    model = train(sampled(docs, ids, "lang", sample_windows(F.col("text").cast("string"))))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        languages, predictor = held.value.languages, Predictor(held.value)

        def predict(texts: list[bytes]) -> pa.Array:
            total, weights = np.zeros((len(texts), max(1, len(languages)))), np.zeros(len(texts))
            owner, parts = [], []

            def settle() -> None:
                x = np.concatenate(parts)
                weight = (x > 1).sum(axis=1) + 1e-3
                np.add.at(weights, owner, weight)
                np.add.at(total, owner, predictor.probabilities(x) * weight[:, None])

            for at, text in enumerate(texts if languages else ()):
                for start in range(0, max(1, len(text)), PART):
                    parts.append(windows(text[start : start + PART]))
                    owner += [at] * len(parts[-1])
                    if len(owner) * WINDOW >= PART:
                        settle()
                        owner, parts = [], []
            if parts:
                settle()
            mean = total / np.maximum(weights, 1e-9)[:, None]
            best = mean.argmax(axis=1)
            known = [bool(languages) and has_letter(t) for t in texts]
            pred = [languages[b] if k else "und" for b, k in zip(best.tolist(), known, strict=True)]
            score = np.where(known, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)
            return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

        return predict

    inner = spare(docs.select(*back), "_told")
    told = docs.select(*back, held_out().alias("held_out"), of_text(docs.sparkSession, F.col("text"), "lang_pred string, score double", setup).alias(inner))
    return told.select(*back, "held_out", *(F.col(inner)[c].alias(c) for c in ("lang_pred", "score")))
