"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point and a seed. A trigram is bound
from its letters: the first's vector rotated by two places, the second's by one, the third's
as it is, multiplied. A text is the bundle (sum) of its trigrams; a language's prototype is the bundle
of its training texts, each scaled to one. A text gets the language of the nearest prototype by
cosine. All texts are read whole, all training rows count, and no row is shuffled: tasks send
one sum per language. Bundles of few texts with common trigrams come from one table of counts, others from the trigrams of
each text, a slice of vectors at a time, so memory is bounded whatever letters the texts hold.

Defined cases: text that is null or holds no letter is ``und`` with score 0; where no language can be
learnt every text is ``und``; ties go to the language that sorts first; other columns are ignored;
an empty table gives an empty result. As a filter (``keep_identified``) only texts without a letter go, also where no language
can be learnt; how sure a prediction is plays no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import filter_rows, held_out, read, small_batches, texts_of

DIMENSIONS = 1024
SEED = 20011
UNKNOWN = "und"
#: Sharpness of the score among the languages, in cosine.
TEMPERATURE = 0.05
SPACE = 32
#: Cells of a table of counts, and vectors that are made at a time.
TABLE = 1 << 22
VECTORS = 1 << 11


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=50_000)
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=[seed, code])).integers(0, 2, dimensions, np.int8)
    return bits * np.int8(2) - np.int8(1)


class Trigrams:
    """The trigrams of some texts in order: ``doc`` and ``gram`` of each, and whether a text has a letter."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        sizes = np.array([len(t) + 2 for t in lowered])
        # A text stands between separators; a run of other characters counts as one separator.
        codes = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), "<u4")
        doc = np.repeat(np.arange(len(texts)), sizes)
        is_letter = letters()[codes]
        keep = is_letter.copy()
        keep[0] = True
        keep[1:] |= is_letter[:-1] | (doc[1:] != doc[:-1])
        self.texts = len(texts)
        self.has_letter = np.bincount(doc, weights=is_letter, minlength=len(texts)) > 0
        codes, doc = np.where(is_letter, codes, SPACE)[keep], doc[keep]
        self.alphabet, place = np.unique(codes, return_inverse=True)
        a = len(self.alphabet)
        gram = (place[:-2] * a + place[1:-1]) * a + place[2:]
        inside = (doc[:-2] == doc[2:]) & self.has_letter[doc[:-2]]
        self.doc, gram = doc[:-2][inside], gram[inside]
        if a**3 <= TABLE:
            self.present = np.flatnonzero(np.bincount(gram, minlength=a**3))
            rank = np.zeros(a**3, np.int64)
            rank[self.present] = np.arange(len(self.present))
            self.gram = rank[gram]
        else:
            self.present, self.gram = np.unique(gram, return_inverse=True)

    def codes(self, grams: np.ndarray) -> np.ndarray:
        """Code points of trigrams, three a row."""
        a, found = len(self.alphabet), self.present[grams]
        return self.alphabet[np.stack([found // (a * a), found // a % a, found % a], axis=1)]

    def bundles(self, group: np.ndarray, groups: int, weight: np.ndarray | None, dimensions: int, seed: int) -> np.ndarray:
        """Sum of the trigrams' vectors by group; ``group`` and ``weight`` belong to the texts."""
        of, n = group[self.doc], len(self.present)
        weights = None if weight is None else weight[self.doc]
        out = np.zeros((groups, dimensions), np.float32)
        if groups * n <= TABLE:
            counts = np.bincount(of * n + self.gram, weights, groups * n).reshape(groups, n).astype(np.float32)
            for k in range(0, n, VECTORS):
                out += counts[:, k : k + VECTORS] @ bind(self.codes(np.arange(k, min(n, k + VECTORS))), dimensions, seed)
            return out
        order = np.argsort(of, kind="stable")
        for k in range(0, len(order), VECTORS):
            part = order[k : k + VECTORS]
            vectors = bind(self.codes(self.gram[part]), dimensions, seed)
            if weights is not None:
                vectors *= weights[part, None].astype(np.float32)
            first = np.flatnonzero(np.diff(of[part], prepend=-1))
            out[of[part[first]]] += np.add.reduceat(vectors, first, axis=0)
        return out


def bind(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """The vectors of trigrams: rotated letter vectors, multiplied."""
    alphabet, place = np.unique(grams, return_inverse=True)
    place = place.reshape(grams.shape)
    base = np.array([letter_vector(int(c), dimensions, seed) for c in alphabet], np.int8).reshape(-1, dimensions)
    bound = np.roll(base, 2, axis=1)[place[:, 0]]
    bound *= np.roll(base, 1, axis=1)[place[:, 1]]
    bound *= base[place[:, 2]]
    return bound.astype(np.float32)


def prototypes(
    docs: DataFrame, text_column: str, lang_column: str, dimensions: int = DIMENSIONS, seed: int = SEED
) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from all rows of ``docs`` with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in small_batches(batches, 0, 1 << 20):
            grams = Trigrams(texts_of(batch, 0))
            names, of = np.unique(np.array(batch.column(1).to_pylist(), object), return_inverse=True)
            share = 1 / np.maximum(np.bincount(grams.doc, minlength=grams.texts), 1)
            for n, v in zip(names, grams.bundles(of, len(names), share, dimensions, seed)):
                sums[n] = sums.get(n, 0) + v.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["lang", "sum"]
            )

    labelled = docs.select(F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang"))
    parts = labelled.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "lang string, sum array<double>")
    # Dimensions times languages numbers, whatever the corpus holds.
    sums = (
        parts.select("lang", F.posexplode("sum").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("xs")).orderBy("lang").collect()
    )
    vectors = np.array([[x.x for x in r.xs] for r in sums]).reshape(-1, dimensions)
    norms = np.linalg.norm(vectors, axis=1)
    known = norms > 0
    return [r.lang for r, k in zip(sums, known) if k], vectors[known] / norms[known, None]


class Identifier:
    """Languages and scores of texts against prototypes."""

    def __init__(self, langs: list[str], vectors: np.ndarray, seed: int = SEED, temperature: float = TEMPERATURE):
        self.langs, self.vectors, self.seed, self.temperature = langs, vectors.astype(np.float32), seed, temperature

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        grams = Trigrams(texts)
        has_letter = grams.has_letter
        if not self.langs or not has_letter.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        bundles = grams.bundles(np.arange(len(texts)), len(texts), None, self.vectors.shape[1], self.seed)
        norms = np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-30)
        cosine = (bundles @ self.vectors.T) / norms
        share = np.exp((cosine - cosine.max(axis=1, keepdims=True)).astype(np.float64) / self.temperature)
        score = np.where(has_letter, 1 / share.sum(axis=1), 0.0)
        best = cosine.argmax(axis=1)
        return [self.langs[b] if h else UNKNOWN for b, h in zip(best, has_letter)], score


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> Identifier:
    """An identifier from the text and language of the rows outside the held-out fold."""
    return Identifier(*prototypes(docs.where(~held_out(id_column)), text_column, lang_column))


def identify(docs: DataFrame, identifier: Identifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2, 1 << 20):
            langs, score = identifier(texts_of(batch, 2))
            columns = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "held_out", "lang_pred", "score"])

    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), held_out(id_column).alias("out"),
        F.col(f"`{text_column}`").alias("text"),
    )
    return rows.mapInArrow(run, f"`{id_column}` bigint, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, identifier: Identifier, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that have a language; texts without a letter go, and no others, even if no language was learnt."""

    def keep(texts: list[str]) -> np.ndarray:
        if not identifier.langs:
            return Trigrams(texts).has_letter
        return np.array([x != UNKNOWN for x in identifier(texts)[0]])

    return filter_rows(docs, text_column, keep)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return identify(docs, learn(docs))
