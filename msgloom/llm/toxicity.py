"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Spark counts the n-grams of all labelled texts by class. The n-grams that separate the classes
best (chi-square) are kept; presence of each is scaled by its log-count ratio, and logistic
regression on all labelled rows weighs them: the driver holds one number for each n-gram, each
step sums the gradient in Spark. The sums are of whole numbers, so that they don't depend on how
rows fall to tasks. Every whole text is scored.

Null and empty texts hold no n-gram and get the model's base score. Labels that are null, or
of rows that documents lack, are left out; of repeated labels the larger counts. Without both
classes, every score is the share of label 1, or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.llm.common import if_small, stored

ORDERS = (3, 4, 5)
BITS = 21
FEATURES = 20_000
MIN_TEXTS = 3
SMOOTHING = 1.0
PENALTY = 1e-3
THRESHOLD = 0.7
PIECE = 1 << 20
#: Steps of the fit, pairs of steps that it remembers, and the relative gain at which it ends.
STEPS, REMEMBERED, SETTLED = 40, 8, 1e-3
#: Errors and losses are summed in units of 1 / UNITS. Rows are read in groups of so many.
UNITS, GROUP = 1 << 22, 256
#: Features of labelled rows of at most so many bytes are summed on the driver.
LOCAL_BYTES = 4 << 20


@dataclass
class Model:
    slots: np.ndarray
    weights: np.ndarray
    base: float


def slot_pieces(text: str | None, orders=ORDERS, bits: int = BITS) -> Iterator[np.ndarray]:
    """Hash slots of all character n-grams of a text, a long text in pieces that overlap."""
    padded = f" {text.lower()} " if text else ""
    step, over = PIECE, max(orders) - 1
    for at in range(0, max(len(padded) - 1, 0), step):
        piece = padded[at : at + step + over]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        mixed = codes
        for n in range(2, max(orders) + 1):
            if len(codes) < n:
                break
            mixed = mixed[: len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1 :]
            if n in orders:
                yield (mixed * np.uint32(0x9E3779B1) ^ np.uint32(n * 0x51ED27)) >> np.uint32(32 - bits)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text) of the labelled documents."""
    one = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("_id"))
    ids = if_small(stored(one.agg(F.max("toxic").cast("int").alias("label")), "labels"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(ids, F.col("doc_id") == F.col("_id")).select("label", "text")


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of each class that hold a slot, summed inside the task."""
    counts = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for label, text in zip(batch["label"].tolist(), batch["text"].tolist(), strict=True):
            pieces = list(slot_pieces(text))
            if pieces:
                counts[label, np.unique(np.concatenate(pieces))] += 1
    slot = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"slot": slot.astype("int32"), "clean": counts[0, slot], "toxic": counts[1, slot]})


class Presence:
    """Numbers of the kept features that a text holds."""

    def __init__(self, slots: np.ndarray):
        self.number = np.full(1 << BITS, -1, np.int32)
        self.number[slots] = np.arange(len(slots), dtype=np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        found = [np.zeros(0, np.int32)]
        for slots in slot_pieces(text):
            numbers = self.number[slots]
            found.append(np.unique(numbers[numbers >= 0]))
        return np.unique(np.concatenate(found))


def _sums(labels: np.ndarray, held: list[bytes], weights: np.ndarray, base: float) -> np.ndarray:
    """By class: the rows' errors summed by feature, all errors, all losses, in whole UNITS."""
    width = len(weights)
    out = np.zeros((2, width + 2))
    for at in range(0, len(held), GROUP):
        some, y = held[at : at + GROUP], labels[at : at + GROUP].astype(np.int64)
        index = np.frombuffer(b"".join(some), "<i2")
        row = np.repeat(np.arange(len(some)), [len(h) // 2 for h in some])
        z = np.bincount(row, weights=weights[index], minlength=len(some)) + base
        error = np.rint((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * UNITS)
        loss = np.rint(np.minimum(np.logaddexp(0, (1 - 2 * y) * z), 1000) * UNITS)
        out[:, :width] += np.bincount(index + width * y[row], weights=error[row], minlength=2 * width).reshape(2, width)
        out[:, width] += np.bincount(y, weights=error, minlength=2)
        out[:, width + 1] += np.bincount(y, weights=loss, minlength=2)
    return out


def _passes(held: DataFrame, width: int):
    """A function (weights, base) -> _sums over all rows of held (label, held), a stored table."""
    size = held.agg(F.sum(F.length("held"))).first()[0] or 0
    if size <= LOCAL_BYTES:
        rows = held.toPandas()
        return lambda weights, base: _sums(rows["label"].to_numpy(), list(rows["held"]), weights, base)

    def over_all(weights: np.ndarray, base: float) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros((2, width + 2))
            for batch in batches:
                sums += _sums(batch["label"].to_numpy(), list(batch["held"]), weights, base)
            some = np.flatnonzero(sums.any(axis=0))
            yield pd.DataFrame({"at": some.astype("int32"), "clean": sums[0, some].astype("int64"), "toxic": sums[1, some].astype("int64")})

        added = held.mapInPandas(part, "at int, clean long, toxic long").groupBy("at")
        got = added.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
        out = np.zeros((2, width + 2))
        out[:, got["at"].to_numpy()] = got[["clean", "toxic"]].to_numpy(float).T
        return out

    return over_all


def _fit(passes, ratio: np.ndarray, clean: int, toxic: int) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio, both classes with the same weight (L-BFGS)."""
    width = len(ratio)
    share = np.array([0.5 / clean, 0.5 / toxic]) / UNITS

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        sums = share @ passes(x[:-1] * ratio, x[-1])
        return sums[width + 1] + PENALTY / 2 * x[:-1] @ x[:-1], np.append(sums[:width] * ratio + PENALTY * x[:-1], sums[width])

    x, past = np.zeros(width + 1), []
    loss, grad = at(x)
    for _ in range(STEPS):
        way, kept = -grad, []
        for s, d in reversed(past):
            kept.append((s @ way) / (s @ d))
            way = way - kept[-1] * d
        if past:
            s, d = past[-1]
            way = way * (s @ d) / (d @ d)
        else:
            way = way / max(np.linalg.norm(grad), 1e-12)
        for (s, d), k in zip(past, reversed(kept), strict=True):
            way = way + (k - (d @ way) / (s @ d)) * s
        size, slope = 1.0, grad @ way
        new_loss, new_grad = at(x + way)
        while new_loss > loss + 1e-4 * size * slope and size > 1e-4:
            size /= 4
            new_loss, new_grad = at(x + size * way)
        if new_loss >= loss:
            break
        step, change, gain = size * way, new_grad - grad, loss - new_loss
        if step @ change > 1e-12:
            past = [*past, (step, change)][-REMEMBERED:]
        x, loss, grad = x + step, new_loss, new_grad
        if gain < SETTLED * loss:
            break
    return x[:-1], float(x[-1])


def train(docs: DataFrame, labels: DataFrame, features: int = FEATURES) -> Model:
    """Fit on documents (doc_id, text) with labels (doc_id, toxic)."""
    if features > 1 << 15:
        raise ValueError("feature numbers have 16 bits")
    train_set = stored(training_rows(docs, labels), "labelled")
    sizes = {r["label"]: r["count"] for r in train_set.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        base = 30.0 if toxic else -30.0
        return Model(np.zeros(0, np.int64), np.zeros(0), base)
    counted = train_set.mapInPandas(_count, "slot int, clean int, toxic int")
    counted = counted.groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    apart = a * (clean - b) - b * (toxic - a)
    chi = apart * apart / ((a + b) * (clean + toxic - a - b + 1))
    best = counted.filter(F.col("toxic") + F.col("clean") >= MIN_TEXTS)
    best = best.orderBy(chi.desc(), "slot").limit(features).toPandas()
    slots = best["slot"].to_numpy(np.int64)
    p = (best["toxic"].to_numpy(float) + SMOOTHING) / (toxic + 2 * SMOOTHING)
    q = (best["clean"].to_numpy(float) + SMOOTHING) / (clean + 2 * SMOOTHING)
    ratio = np.log(p / q)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = Presence(slots)
        for batch in batches:
            held = [find(t).astype("<i2").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "held": held})

    held = stored(train_set.mapInPandas(present, "label int, held binary"), "held")
    w, base = _fit(_passes(held, len(slots)), ratio, clean, toxic)
    return Model(slots, (w * ratio).astype(np.float64), base)


def scorer(model: Model):
    """A column function: text -> score from 0 to 1."""
    slots, weights, base = model.slots, model.weights, model.base

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = Presence(slots)
        for texts in batches:
            z = np.array([base + weights[find(t)].sum() for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    rest = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3
    return rest == 1


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs (doc_id, text)."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    made = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(model)("text").alias("score"))
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with a score below the threshold."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    return docs.filter(scorer(model)(docs["text"]) < threshold)
