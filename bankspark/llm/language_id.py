"""Language identification by compression.

Each language is a zstandard raw-content dictionary of sampled training text; a text gets the language
whose dictionary codes it smallest.  Texts are folded to lower case first, whole, and coded in blocks
(see ``compression``).  A text whose margin over the second language is below ``min_margin`` (a share of
the second size) is rejected: it gets ``und`` in ``lang``, while ``lang_pred`` keeps the best guess.

Defined cases: null text or a text without any letter is ``und`` with score 0; equal sizes go to the
language with more training rows, then to the first by name; rows without label or id are not learnt
from; without any labelled row every text is ``und``; repeated rows get equal results; an empty table
gives an empty result; further columns, and the label itself, never enter a prediction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankspark.llm.arrow_text import column
from bankspark.llm.compression import DICT_ROWS, PIECE_CHARS, Coder, dictionaries, sampled_ids, sampled_texts

UNKNOWN = "und"
MIN_MARGIN = 0.01
SCALE = 8.0  # bytes of difference that make one unit of log odds


def train(rows: DataFrame, per_class: int = DICT_ROWS, piece: int = PIECE_CHARS) -> list[tuple[str, bytes]]:
    """[(language, dictionary)] from rows (id, label, text), most frequent language first."""
    known = rows.filter("label is not null and id is not null and text is not null")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    samples = sampled_texts(sampled_ids(known.select("id", "label"), per_class, 6), known.select("id", "text"), piece)
    found = dictionaries([(k, t.lower()) for k, t in samples])
    return sorted(found.items(), key=lambda x: (-counts[x[0]], x[0]))


def identify(docs: DataFrame, model: list[tuple[str, bytes]], keep: dict[str, Column], text_col: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1), margin, and lang (``und`` where the margin is too narrow)."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], F.col(text_col).alias("__text"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [(name, Coder(data)) for name, data in model]
        for b in batches:
            out: list[tuple] = []
            for text in column(b, "__text"):
                out.append(_judge(text.as_py(), coders, min_margin))
            pred, score, margin, lang = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [column(b, n) for n in names] + [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                                 pa.array(margin, pa.float64()), pa.array(lang, pa.string())],
                [*names, "lang_pred", "score", "margin", "lang"])

    schema = rows.drop("__text").schema
    for n, t in (("lang_pred", "string"), ("score", "double"), ("margin", "double"), ("lang", "string")):
        schema = schema.add(n, t)
    return rows.mapInArrow(run, schema)


def _judge(text: str | None, coders: list[tuple[str, Coder]], min_margin: float) -> tuple[str, float, float, str]:
    if not coders or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0, UNKNOWN
    data = text.lower().encode("utf-8", "surrogatepass")
    sizes = [c.size(data) for _, c in coders]
    least = min(sizes)
    best = sizes.index(least)
    score = 1 / sum(math.exp(min(0.0, (least - s) / SCALE)) for s in sizes)
    second = min((s for i, s in enumerate(sizes) if i != best), default=least + len(data))
    margin = (second - least) / max(1, second)
    name = coders[best][0]
    return name, score, margin, name if margin >= min_margin else UNKNOWN
