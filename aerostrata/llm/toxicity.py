"""Toxicity classification with a counterfactual penalty.

A text is the set of its words and of their beginnings and endings; a logistic model weighs the ones that
tell toxic from other labelled texts. Naming a group of people is no sign of toxicity, so in every
labelled text that names one the term is swapped for the others of its group, and the fit is charged for the square
of the score's change. Terms that occur mostly in toxic texts thereby lose their weight.

The fit uses at most ``SAMPLE`` labelled texts of each class, taken by the hash of the text. Features that ``LEAST_SAMPLED`` of
them have and that lean to one class there are candidates, a number the sample bounds; they are counted over all labelled
rows outside the held-out fold, of which only the candidates' numbers are shuffled, and all that tell the classes
apart are kept. Every text is scored whole.

Defined cases: null and empty texts get the score of a text without evidence; texts of any length
are read whole; repeated rows get equal scores; without labels of both classes every score is
the share of label 1 (0.5 without any label); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm.common import filter_rows, held_out, read, small_batches, texts_of
from aerostrata.llm.logistic import agreed_labels, fit_sparse, labelled, labelled_sample, sigmoid

SAMPLE = 3000
LEAST_TEXTS = 5
LEAST_SAMPLED = 3
#: Chi-square in the sample above which a feature is a candidate, that of a chance of one in ten.
LEANING = 2.71
#: Chi-square above which a feature is kept, that of a chance of one in a hundred thousand: as many features are tried.
SIGNIFICANT = 19.51
PENALTY = 10.0
THRESHOLD = 0.5
MEMO = 150_000
WORD = re.compile(r"[^\W\d_]+")
#: Terms that name groups of people, in English, German, French and Spanish; those of one line may stand for each other.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("immigrants", "refugees", "foreigners", "locals"), ("immigrant", "refugee", "foreigner", "local"),
    ("old", "young"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
    ("schwul", "lesbisch", "bisexuell", "transgeschlechtlich", "heterosexuell"),
    ("schwarze", "weiße", "asiatische", "indigene"), ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("behindert", "blind", "taub"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("gays", "lesbiennes", "bisexuels", "transgenres", "hétérosexuels"),
    ("noirs", "blancs", "asiatiques", "autochtones"), ("immigrés", "réfugiés", "étrangers", "habitants"),
    ("handicapés", "aveugles", "sourds"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("lesbianas", "homosexuales", "bisexuales", "transexuales", "heterosexuales"),
    ("negros", "blancos", "asiáticos", "indígenas"), ("inmigrantes", "refugiados", "extranjeros", "vecinos"),
    ("discapacitados", "ciegos", "sordos"),
)


def word_features(word: str) -> list[str]:
    """A word, its beginnings of four to six letters and its ending of five."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n), *([f"*{word[-5:]}"] if len(word) >= 5 else [])]


def text_features(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swaps(words: set[str], groups: tuple[tuple[str, ...], ...]) -> list[set[str]]:
    """The word sets with one identity term swapped for each other term of its group."""
    return [
        (words - {term}) | {other}
        for group in groups for term in group if term in words for other in group if other != term
    ]


def chi_square(a: np.ndarray, b: np.ndarray, n1: int, n0: int, least: int = LEAST_TEXTS) -> np.ndarray:
    """By counts of texts with a feature of either class; 0 where fewer than ``least`` have it."""
    a, b = a.astype(float), b.astype(float)
    n, with_it = n0 + n1, a + b
    value = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / ((with_it + 1e-9) * (n - with_it + 1e-9) * n0 * n1)
    return np.where(with_it >= least, value, 0)


def select_features(texts: list[str], y: np.ndarray, least: int = LEAST_TEXTS, above: float = SIGNIFICANT) -> list[str]:
    """The features whose share differs between the classes, by chi-square; those of few texts are left out."""
    counts = [Counter(), Counter()]
    for text, v in zip(texts, y.astype(int)):
        counts[v].update(text_features(words_of(text)))
    names = sorted(f for f in counts[0].keys() | counts[1].keys() if counts[0][f] + counts[1][f] >= least)
    chi = chi_square(*(np.array([counts[k][f] for f in names]) for k in (1, 0)), int((y == 1).sum()), int((y == 0).sum()), least)
    return [f for f, c in zip(names, chi) if c > above]


class FeatureNumbers:
    """Numbers of some features in a text."""

    def __init__(self, names: list[str]):
        self.number = {f: i for i, f in enumerate(names)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"number": self.number, "memo": {}}

    def __call__(self, text: str) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo = {}
        known, number, found = self.memo, self.number, set()
        for w in words_of(text):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = tuple(number[f] for f in word_features(w) if f in number)
            if hit:
                found.update(hit)
        return np.fromiter(found, np.int32, len(found))


def telling_features(
    docs: DataFrame, labels: DataFrame, candidates: list[str], id_column: str, text_column: str, label_column: str
) -> list[str]:
    """The candidates that tell the classes apart over all labelled rows outside the held-out fold.

    Every text goes to its label as the numbers of its candidates. Each task adds up one count per class and
    candidate, and so does the driver with the sums of the tasks.
    """
    # The sample bounds the candidates, whatever the corpus holds.
    numbers_of = docs.sparkSession.sparkContext.broadcast(FeatureNumbers(candidates))
    width = len(candidates) + 1

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = numbers_of.value
        for batch in small_batches(batches, 1):
            rows = pa.array([of(t) for t in texts_of(batch, 1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["id", "found"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, width), np.int64)
        for batch in batches:
            found, label = batch.column(0), np.asarray(batch.column(1))
            sizes = np.asarray(pc.list_value_length(found))
            values, of = np.asarray(found.flatten()), np.repeat(label, sizes)
            for v in (0, 1):
                counts[v] += np.bincount(values[of == v], minlength=width)
                counts[v, -1] += int((label == v).sum())  # texts of the class
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])], ["number", "n0", "n1"])

    rows = docs.where(~held_out(id_column)).select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    known = labelled(rows.mapInArrow(numbered, "id bigint, found array<int>"), agreed_labels(labels, id_column, label_column))
    sums = (
        known.select("found", "label").mapInArrow(counted, "number bigint, n0 bigint, n1 bigint")
        .groupBy("number").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    )
    counts = np.zeros((2, width), np.int64)
    for v in (0, 1):
        counts[v, np.asarray(sums["number"])] = np.asarray(sums[f"n{v}"])
    chi = chi_square(counts[1, :-1], counts[0, :-1], int(counts[1, -1]), int(counts[0, -1]))
    return [candidates[i] for i in np.flatnonzero(chi > SIGNIFICANT)]


class ToxicityModel:
    def __init__(self, weights: dict[str, float], constant: float):
        self.weights, self.constant = weights, constant
        self.numbers, self.values = FeatureNumbers(list(weights)), np.array(list(weights.values()))

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = [self.values[np.sort(self.numbers(t))].sum() for t in texts]
        return sigmoid(np.array(out) + self.constant)


def fit(
    texts: list[str], y: np.ndarray, share: float,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, penalty: float = PENALTY, names: list[str] | None = None,
) -> ToxicityModel:
    """A model from labelled texts by ``names``, their own features if None; ``share`` is the share of label 1 among all labelled rows."""
    if len(set(y.tolist())) < 2:
        base = float(np.clip(share, 1e-6, 1 - 1e-6))
        return ToxicityModel({}, float(np.log(base / (1 - base))))
    names = select_features(texts, y) if names is None else list(names)
    terms = {t for g in groups for t in g}
    named = [(i, w) for i, t in enumerate(texts) if (w := words_of(t)) & terms]
    present = {f for _, w in named for t in w & terms for f in word_features(t)}
    names += sorted(present - set(names))
    column = {f: i for i, f in enumerate(names)}

    def row(words: set[str]) -> np.ndarray:
        return np.array(sorted({column[f] for f in text_features(words) if f in column}), np.int32)

    x = [row(words_of(t)) for t in texts]
    changes = [(np.setdiff1d(r, x[i]), np.setdiff1d(x[i], r)) for i, w in named for r in map(row, swaps(w, groups))]
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = fit_sparse(x, len(names), y, weight, changed=changes, penalty=penalty)
    return ToxicityModel({f: float(v) for f, v in zip(names, w)}, float(w[-1]))


def learn(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    sample: int = SAMPLE,
) -> ToxicityModel:
    """A model from labelled rows outside the held-out fold."""
    texts, y, share = labelled_sample(docs, labels, id_column, text_column, label_column, sample)
    texts = [t.decode() for t in texts]
    if len(set(y.tolist())) < 2:
        return fit(texts, y, share)
    candidates = select_features(texts, y, LEAST_SAMPLED, LEANING)
    return fit(texts, y, share, names=telling_features(docs, labels, candidates, id_column, text_column, label_column))


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2):
            scores = model(texts_of(batch, 2))
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "held_out", "score", "predicted"])

    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), held_out(id_column).alias("out"),
        F.col(f"`{text_column}`").alias("text"),
    )
    return rows.mapInArrow(run, f"`{id_column}` bigint, held_out boolean, score double, predicted int")


def keep_harmless(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    return filter_rows(docs, text_column, lambda texts: model(texts) < THRESHOLD)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return score(docs, learn(docs, read(spark, folder, "labels")))
