"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased whole text fall into hashed
slots.  Document frequencies are counted over all training rows.  Weights
are fitted by follow-the-regularised-leader (per-coordinate rates, elastic
net) on a stratified sample of at most about ``rows_per_language`` rows a
language; one fifth of the sample is held back to fit one temperature, by
which the scores are calibrated probabilities.
"""

from __future__ import annotations

import base64
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents

UNDETERMINED = "und"


def slot_counts(text: str, bits: int, longest: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the text's character n-grams and how often each occurs."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint32)
    dense = np.zeros(1 << bits, np.int64)
    rolled = np.zeros(len(codes), np.uint32)
    for n in range(longest):
        rolled = rolled[: len(codes) - n] * np.uint32(0x01000193) + codes[n:]
        slots = ((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)) >> np.uint32(32 - bits)
        dense += np.bincount(slots, minlength=1 << bits)
    at = np.flatnonzero(dense)
    return at.astype(np.int32), dense[at].astype(np.int32)


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def _vector(at, n, idf):
    x = (1 + np.log(n)) * idf[at]
    norm = np.sqrt(x @ x)
    return x / norm if norm > 0 else x


def _frequencies(bits: int):
    def run(frames):
        seen = np.zeros(1 << bits, np.int64)
        rows = 0
        for frame in frames:
            for text in frame.text:
                seen[slot_counts(text, bits)[0]] += 1
                rows += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": np.append(at, -1).astype(np.int32), "n": np.append(seen[at], rows)})
    return run


def _vectors(bits: int):
    def run(frames):
        for frame in frames:
            got = [slot_counts(t, bits) for t in frame.text]
            frame["at"], frame["n"] = [a.tobytes() for a, _ in got], [n.tobytes() for _, n in got]
            yield frame[["place", "lang", "at", "n"]]
    return run


def fit_ftrl(rows: list, idf: np.ndarray, labels: list, alpha: float, beta: float, l1: float, l2: float,
             epochs: int) -> np.ndarray:
    """Weights (slots x labels) after ``epochs`` passes of FTRL-proximal over (slots, counts, label index)."""
    z = np.zeros((len(idf) + 1, len(labels)))
    g2 = np.zeros_like(z)

    def weights(at):
        zs, ns = z[at], g2[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for at, n, y in rows:
            x = np.append(_vector(at, n, idf), 1.0)
            at = np.append(at, len(idf))  # the last slot is the intercept
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = np.outer(x, p)
            sigma = (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / alpha
            z[at] += g - sigma * w
            g2[at] += g * g
    return weights(slice(None))


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max())
    return e / e.sum()


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss on held-back rows, over a geometric grid.

    As if one more row were spread over all labels, so that no finite sample
    without errors makes the scores certain.
    """
    target = np.full(logits.shape, 1 / logits.shape[1] / (len(y) + 1)) if len(y) else None

    def loss(t):
        a = logits / t
        a = a - a.max(axis=1, keepdims=True)
        a -= np.log(np.exp(a).sum(axis=1, keepdims=True))
        return -float(np.sum(a * target) + np.sum(a[np.arange(len(y)), y]) * len(y) / (len(y) + 1))

    return min(np.geomspace(0.02, 20, 200), key=loss) if len(y) else 1.0


def fit(train: DataFrame, bits: int = 15, rows_per_language: int = 1500, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.01, l2: float = 0.1, epochs: int = 3) -> dict:
    """Model from the rows of ``train`` (doc_id, text, lang) whose text has a letter and whose lang is not null.

    The driver gets two bounded things: 2**bits slot frequencies, and the
    sparse slot counts of the sample, in which ``rows_per_language`` bounds
    the expected rows of a language and ``bits`` the size of a row.
    """
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    idf = np.ones(1 << bits)
    sample = []
    if labels:
        got = (train.select("text").mapInPandas(_frequencies(bits), "slot int, n bigint")
               .groupBy("slot").agg(F.sum("n").alias("n")).toPandas().set_index("slot").n)
        df = np.zeros(1 << bits)
        total = got.pop(-1)
        df[got.index.to_numpy(dtype=int)] = got.to_numpy()
        idf = np.log((1 + total) / (1 + df)) + 1
        place = F.xxhash64(F.lit(11), "doc_id", "text")
        share = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1.0, rows_per_language / sizes[k]))])
        drawn = train.withColumn("place", place).where(
            F.pmod("place", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
        sample = (drawn.select("place", "lang", "text")
                  .mapInPandas(_vectors(bits), "place bigint, lang string, at binary, n binary")
                  .toPandas().sort_values(["place", "lang"]).itertuples(index=False))
    index = {k: i for i, k in enumerate(labels)}
    rows = [(np.frombuffer(r.at, np.int32), np.frombuffer(r.n, np.int32), index[r.lang]) for r in sample]
    held, fitted = rows[::5], [r for i, r in enumerate(rows) if i % 5]
    w = fit_ftrl(fitted or rows, idf, labels, alpha, beta, l1, l2, epochs)
    logits = np.array([np.append(_vector(at, n, idf), 1.0) @ w[np.append(at, len(idf))] for at, n, _ in held])
    temperature = fit_temperature(logits, np.array([y for _, _, y in held])) if len(labels) > 1 and held else 1.0
    return {"bits": bits, "labels": labels, "idf": idf.astype(np.float32), "w": w.astype(np.float32),
            "temperature": float(temperature)}


def predicted(model: dict):
    """A function of a text column that gives its (lang_pred, score), Arrow batch by batch."""
    bits, labels, t = model["bits"], model["labels"], model["temperature"]
    packed = {k: base64.b64encode(model[k].tobytes()).decode() for k in ("idf", "w")}
    shape = model["w"].shape

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        idf = np.frombuffer(base64.b64decode(packed["idf"]), np.float32).astype(np.float64)
        w = np.frombuffer(base64.b64decode(packed["w"]), np.float32).reshape(shape).astype(np.float64)
        for texts in series:
            pred, score = [], []
            for text in texts:
                if not labels or not has_letter(text):
                    pred.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                at, n = slot_counts(text, bits)
                p = _softmax((_vector(at, n, idf) @ w[at] + w[-1]) / t)
                pred.append(labels[int(p.argmax())])
                score.append(float(p.max()))
            yield pd.DataFrame({"lang_pred": pred, "score": score})
    return F.pandas_udf(run, "lang_pred string, score double")


def predict(df: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score for every row: ``und`` and 0 where the text is null or has no letter.

    Ids may be null or repeat; rows are judged one by one, on the whole text.
    A model fitted on no labelled row calls every row ``und``.
    """
    return documents(df).select("doc_id", predicted(model)(F.col("text")).alias("x")).select("doc_id", "x.*")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by


def identify(df: DataFrame, **params) -> DataFrame:
    """Fit on the rows whose id's crc32 modulo 3 is not 1; doc_id, held_out, lang_pred, score of every row.

    Rows with a null id are not learned from; their held_out is false.
    """
    docs = documents(df, "lang")
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs.where(F.col("doc_id").isNotNull() & ~held), **params)
    return predict(docs, model).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score")
