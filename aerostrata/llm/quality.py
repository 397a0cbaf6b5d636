"""Quality classification by compression.

Two zstandard dictionaries are trained on texts labelled good and bad. A text is compressed whole, in
blocks, with either dictionary and with none; the difference of the two sizes over the size without a
dictionary says which kind of text it resembles. A logistic curve fitted on labelled rows turns the
difference, the compressed share and the evidence's amount into a score.

The dictionaries and the curve are fitted on at most ``SAMPLE`` labelled rows of each class, taken by the
hash of their text; everything else covers all rows, and no row is shuffled.

Defined cases: null text equals empty text and gets the score of a text without evidence; texts
of any length are read whole; repeated rows get equal scores; without labels of both classes every
score is the share of good labels (0.5 without any); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import held_out, read, small_batches
from aerostrata.llm.logistic import fit_logistic, labelled_sample, sigmoid

SAMPLE = 3000
BLOCK = 2048
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
THRESHOLD = 0.3


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[bytes, bytes], level: int):
    import zstandard as z

    options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    found = []
    for raw in (*dictionaries, b""):
        if raw:
            digested = z.ZstdCompressionDict(raw)
            digested.precompute_compress(level=level)
            found.append(z.ZstdCompressor(dict_data=digested, **options))
        else:
            found.append(z.ZstdCompressor(**options))
    return found


def blocks(text: bytes, size: int = BLOCK) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


def train_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the blocks of texts; where there is too little text, the text itself."""
    import zstandard as z

    samples = [b for t in texts for b in blocks(t)]
    try:
        return z.train_dictionary(size, samples).as_bytes()
    except z.ZstdError:  # too few samples to train on
        return b"".join(samples)[-size:]


def features(texts: list[bytes], dictionaries: tuple[bytes, bytes], level: int = LEVEL) -> np.ndarray:
    """Per text: the normalised size difference, its least value of a block, the compressed share, log length."""
    good, bad, plain = _compressors(dictionaries, level)
    rows = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        cut = blocks(text)
        if cut:
            sizes = np.array([(len(good.compress(b)), len(bad.compress(b)), len(plain.compress(b))) for b in cut], float)
            g, b, p = sizes.sum(axis=0)
            rows[i] = (b - g) / p, ((sizes[:, 1] - sizes[:, 0]) / sizes[:, 2]).min(), p / len(text), np.log1p(len(text))
    return rows


class QualityModel:
    def __init__(self, dictionaries: tuple[bytes, bytes], weights: np.ndarray):
        self.dictionaries, self.weights = dictionaries, weights

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        x = features(texts, self.dictionaries)
        return sigmoid(np.column_stack([x, x[:, :2] ** 2, np.ones(len(x))]) @ self.weights)


def learn(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", sample: int = SAMPLE,
) -> QualityModel:
    """A model from labelled rows outside the held-out fold."""
    texts, y, share = labelled_sample(docs, labels, id_column, text_column, label_column, sample)
    if len(set(y.tolist())) < 2:
        base = float(np.clip(share, 1e-6, 1 - 1e-6))
        return QualityModel((b"", b""), np.array([0, 0, 0, 0, 0, 0, np.log(base / (1 - base))]))
    # Dictionaries from every other text, the curve from the rest, which they have not seen.
    first = np.arange(len(y)) % 2 == 0
    dictionaries = tuple(train_dictionary([t for t, f, v in zip(texts, first, y) if f and v == k]) for k in (1, 0))
    rest = [t for t, f in zip(texts, first) if not f]
    x = features(rest, dictionaries)
    x = np.column_stack([x, x[:, :2] ** 2])
    # Weights restore the share of the classes among all labels.
    label = y[~first]
    weight = np.where(label == 1, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9))
    return QualityModel(dictionaries, fit_logistic(x, label, weight))


def score(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            scores = model([t or b"" for t in batch.column(2).to_pylist()])
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "held_out", "score", "predicted"])

    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), held_out(id_column).alias("out"),
        F.col(f"`{text_column}`").cast("binary").alias("text"),
    )
    return rows.mapInArrow(run, f"`{id_column}` bigint, held_out boolean, score double, predicted int")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return score(docs, learn(docs, read(spark, folder, "labels")))
