"""Quality classifier: gradient-boosted trees over statistics of whole texts.

At most ``sample`` labelled rows (those of the smallest hash of the id) are brought to the driver as statistics to fit the
trees; then one pass over all texts computes their statistics and scores them by the flattened trees, a slice at a time. Labels that are null, or of no document, are not used; the statistics see the text alone. Null texts
count as empty and are scored like them; every input row gives one row; further columns are not read.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm import boosting
from leadloom.llm.common import fold_of, id_type, map_texts

SAMPLE_ROWS = 20_000
CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": [9, 10, 11, 12, 13, 32], "line": [10],
           "symbol": b"#*$%&|<>", "stop": b".!?", "comma": b",;:", "bracket": b"()[]{}", "quote": b"\"'`", "path": b"/\\=_~^@+",
           "control": [*range(9), *range(14, 32), 127], "wide": range(128, 256)}
NAMES = [*CLASSES, "bytes", "entropy", "words", "word_size", "long_words", "distinct", "twice", "triples", "lines", "line_words",
         "same_lines", "ended_lines", "capital_words"]
_SUMS = np.zeros((256, len(CLASSES)))
for _k, _own in enumerate(CLASSES.values()):
    _SUMS[list(_own), _k] = 1


def describe(text: bytes) -> list[float]:
    """Statistics in the order of ``NAMES``; all are 0 for an empty text."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts[counts > 0] / n
    m = len(words)
    lines = [x for x in text.split(b"\n") if x]
    return [*(counts @ _SUMS / n).tolist(), np.log1p(n), float(-(share * np.log2(share)).sum()), np.log1p(m), n / m,
            sum(map((12).__lt__, map(len, words))) / m, len(set(words)) / m, sum(map(eq, words, words[1:])) / m,
            len(set(zip(words, words[1:], words[2:]))) / max(1, m - 2), np.log1p(len(lines)), m / len(lines),
            1 - len(set(lines)) / len(lines), sum(x[-1] in b".!?" for x in lines) / len(lines), sum(map(bytes.istitle, words)) / m]


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of each document."""
    def make():
        def step(rows, texts):
            flat = np.array([describe(t) for t in texts], dtype=np.float32)
            return [rows.column(0), pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * len(NAMES), flat.ravel())]

        return step

    return map_texts(docs.select(F.col(doc_id), F.col(text)), text, make, f"`{doc_id}` {id_type(docs, doc_id)}, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text",
        sample: int = SAMPLE_ROWS) -> boosting.Forest:
    """Trees learned from at most ``sample`` labelled rows; several labels of one id count as their largest."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("y"))
    chosen = F.broadcast(known.orderBy(F.xxhash64(doc_id), doc_id).limit(sample))  # bounded by ``sample``
    described = statistics(docs.select(doc_id, text).join(chosen.select(doc_id), doc_id, "left_semi"), doc_id, text)
    rows = described.join(chosen, doc_id).orderBy(F.xxhash64(doc_id), doc_id).limit(sample).select("x", "y").toPandas()
    x = np.array(rows["x"].tolist(), dtype=np.float32).reshape(len(rows), len(NAMES))
    return boosting.fit(x, rows["y"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, forest: boosting.Forest, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of all documents, in one pass over their texts."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def make():
        def step(rows, texts):
            return [rows.column(0), shared.value.score(np.array([describe(t) for t in texts], dtype=np.float32))]

        return step

    return map_texts(docs.select(F.col(doc_id), F.col(text)), text, make, f"`{doc_id}` {id_type(docs, doc_id)}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
                   sample: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score``; labels of ids whose fold is 0 are held out from learning."""
    forest = fit(docs, labels.where(fold_of(doc_id) != 0), label, doc_id, text, sample)
    return score(docs, forest, doc_id, text).select(doc_id, (fold_of(doc_id) == 0).alias("held_out"), "score")
