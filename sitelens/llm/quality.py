"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Words are runs of letters and digits or runs of other signs, case kept.
Features are 1- and 2-grams of words, hashed to 2**BITS places; a text's value
at a place is log(1 + count), scaled to length one.

Defined results: a null text is empty; an empty text has the intercept's
score; repeated rows are scored each; with no labelled row every score is 0.5;
an empty table gives an empty result; a null id is never held out.  Other
columns of the input, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm import classify as cl
from sitelens.llm import textbatch as tb

#: 0 white space, 1 letters, digits and all beyond ASCII, 2 other signs.
KIND = np.full(256, 2, np.int8)
KIND[tb.SPACE] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: Bits of a feature's place in the weight table.
BITS = 18
EPOCHS = 12
#: Rows of the sample whose features are sent in one batch.
RUN = 256


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``places, values`` of each row in order; the places of a row are distinct."""
    shift = tb.U64(64 - BITS)
    for _, data, offsets in tb.text_chunks(column):
        start, end, first = tb.class_spans(KIND[data], offsets)
        one = tb.span_hash(tb.prefix_hash(data), start, end)
        two = tb.mix(one[:-1] * tb.PLACE[0] + one[1:] * tb.PLACE[1]) >> shift
        one = one >> shift
        for i, j in zip(first[:-1], first[1:], strict=True):
            at, count = np.unique(np.concatenate([one[i:j], two[i : max(i, j - 1)]]), return_counts=True)
            value = np.log1p(count)
            yield at.astype(np.int64), value / max(np.sqrt(value @ value), 1e-9)


def _lists(column: pa.Array) -> Iterator[list[pa.Array]]:
    """``features`` of runs of rows as list columns."""
    for i in range(0, len(column), RUN):
        at, value = zip(*features(column.slice(i, RUN)), strict=True)
        cut = pa.array(np.cumsum([0, *map(len, at)], dtype=np.int32))
        yield [pa.ListArray.from_arrays(cut, pa.array(np.concatenate(x).astype(kind))) for x, kind in ((at, np.int32), (value, np.float32))]


def _margins(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    return np.fromiter((weights[at] @ value for at, value in features(column)), np.float64, len(column))


def train(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", bound: int = cl.MAX_LABELLED) -> tuple[np.ndarray, float]:
    """Weights and intercept from at most ``bound`` labelled rows; ``keep`` is a condition on the column ``id``."""
    sample = cl.labelled_sample(docs, labels, label, keep, id_col, text_col, bound)
    rows = cl.featured(sample, _lists, {"at": "array<int>", "value": "array<float>"})
    return cl.fitted(rows, 1 << BITS, epochs=EPOCHS, alpha=10.0, beta=1.0, l1=0.05, l2=0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` of every row: the likelihood that its label is 1."""
    return cl.scored(docs, {id_col: F.col(id_col)}, text_col, model, _margins)
