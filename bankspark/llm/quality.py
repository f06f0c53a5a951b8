"""Quality classifier by compression.

Two zstandard raw-content dictionaries are built from sampled good and bad labelled text.  For a text with
coded sizes ``b`` (bad) and ``g`` (good) the normalised difference (b - g) / (b + g) is the raw value; a
logistic curve, fitted on other labelled rows and weighted by the class counts over all labelled rows,
turns it into a calibrated probability of label 1.

Texts are coded whole.  Before coding, a word equal to the word before it is replaced by a mark with the
length of the run so far, and an all-capitals word by a mark and its lower-case form, so both habits show
in a dictionary whatever the words are.

Defined cases: null text counts as empty and gets the score of difference 0; rows without label or id are
not learnt from; if all labels are equal each score is that label, without any label it is 0.5; a doc_id
with both labels counts once for each; repeated rows get equal results; an empty table gives an empty
result; labels and further columns never enter a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column
from bankspark.llm.compression import DICT_ROWS, PIECE_CHARS, Coder, dictionaries, sampled_ids, sampled_texts
from bankspark.session import bounded_batches

BLOCK_BYTES = 256
FIT_ROWS = 1500  # sampled per label for the calibration
THRESHOLD = 0.3


def marked(text: str) -> str:
    """Text with repeated and all-capitals words replaced by marks."""
    out, last, run = [], None, 0
    for word in text.split(" "):
        if word == last:
            run += 1
            out.append(f"\x01{run}")
        else:
            last, run = word, 0
            out.append("\x02" + word.lower() if len(word) > 1 and word.isupper() else word)
    return " ".join(out)


def difference(text: str | None, bad: Coder, good: Coder) -> float:
    data = marked(text or "").encode("utf-8", "surrogatepass")
    b, g = bad.size(data), good.size(data)
    return (b - g) / (b + g)


@dataclass
class Model:
    dictionaries: dict[int, bytes]
    slope: float
    intercept: float

    def score(self, value: float) -> float:
        x = self.slope * value + self.intercept
        return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(slope, intercept) of weighted logistic regression on one value, by Newton's method."""
    scale = x.std() or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def train(labels: DataFrame, texts: DataFrame, per_class: int = DICT_ROWS, fit_rows: int = FIT_ROWS,
          piece: int = PIECE_CHARS) -> Model:
    """Model from labels (id, label 0/1) and texts (id, text); both samples are bounded by the parameters."""
    known = labels.filter("label is not null and id is not null")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model({}, 0.0, math.inf if 1 in counts else -math.inf if 0 in counts else 0.0)
    texts = texts.filter("id is not null")
    half = F.pmod(F.xxhash64("id", F.lit(80)), F.lit(2))
    pieces = sampled_texts(sampled_ids(known.filter(half == 0), per_class, 8), texts, piece)
    found = dictionaries([(k, marked(t)) for k, t in pieces])
    found = {k: found.get(k, b"") for k in (0, 1)}
    bad, good = (Coder(found[k], BLOCK_BYTES) for k in (0, 1))
    fit = sampled_texts(sampled_ids(known.filter(half == 1), fit_rows, 81), texts, piece * 20)
    if len({k for k, _ in fit}) < 2:
        return Model(found, 50.0, math.log(counts[1] / counts[0]))
    y = np.array([k for k, _ in fit], float)
    x = np.array([difference(t, bad, good) for _, t in fit])
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts[0] / max(1, (1 - y).sum()))
    return Model(found, *fit_logistic(x, y, weight / weight.mean()))


def score(docs: DataFrame, model: Model, keep: dict[str, Column], text_col: str = "text",
          threshold: float = THRESHOLD, text_name: str | None = None) -> DataFrame:
    """``keep`` columns, score, predicted (1 if score >= threshold); ``text_name`` names the kept column that is the text."""
    bounded_batches(docs.sparkSession)
    names = list(keep)
    extra = [F.col(text_col).alias("__text")] if text_name is None else []
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], *extra)
    text = text_name or "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = (Coder(model.dictionaries.get(k, b""), BLOCK_BYTES) for k in (0, 1))
        for b in batches:
            scores = [model.score(difference(t.as_py(), bad, good) if model.dictionaries else 0.0)
                      for t in column(b, text)]
            yield pa.RecordBatch.from_arrays(
                [column(b, n) for n in names] + [pa.array(scores, pa.float64()),
                                                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                [*names, "score", "predicted"])

    return rows.mapInArrow(run, rows.select(*names).schema.add("score", "double").add("predicted", "integer"))
