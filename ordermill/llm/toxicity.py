"""Toxicity: logistic regression with a counterfactual penalty.

Features are the words of a whole text and their first four and five bytes, each
present or not, as 64-bit hashes. Of the labelled documents a bounded sample is
used; the features that tell its labels apart best are kept. In every labelled
text that names a group, the term is swapped for another of its kind, and the fit
pays for the change of the score, so that a group's name by itself says nothing.

A null or empty text has no features: its score is that of the bias. Repeated
rows are scored each. Labels that are null or not 0 or 1 do not count; of several
for one document the greatest does. Without labels of both kinds the score is the
rate of label 1, or 0.5 without any. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.quality import one_per_id, sample_labels, scored_rows
from ordermill.llm.text import ALNUM, LOWER, Block, blocks, span_hashes, words
from ordermill.scratch import materialize

#: Labelled rows that may be fitted on: those of least id hash.
MAX_LABELLED = 20_000
MAX_FEATURES = 8_192
LEAST_DOCUMENTS = 4
LEAST_Z = 4.0
RIDGE = 5e-5
FAIRNESS = 1.0
STEPS = 300
PREFIXES = (4, 5)

# Neutral names of groups, by kind, in English, German, French and Spanish.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("weiblich", "männlich"),
    ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer"),
    ("schwul", "lesbisch", "heterosexuell", "bisexuell"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("behinderte", "blinde", "gehörlose", "alte", "junge"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("féminin", "masculin"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques", "africains", "européens"),
    ("homosexuel", "lesbienne", "hétérosexuel", "bisexuel"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    ("handicapés", "aveugles", "sourds", "vieux", "jeunes"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("niñas", "niños"),
    ("femenino", "masculino"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos"),
    ("homosexual", "lesbiana", "heterosexual"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("discapacitados", "ciegos", "sordos", "viejos", "jóvenes"),
)

_KINDS = np.array([0x9E3779B97F4A7C15 * (k + 1) % (1 << 64) for k in range(3)], dtype=np.uint64)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row for each word: hashes of the word and of its beginnings."""
    columns = [span_hashes(data, starts, ends) ^ _KINDS[0]]
    for kind, size in zip(_KINDS[1:], PREFIXES):
        columns.append(span_hashes(data, starts, np.minimum(starts + size, ends)) ^ kind)
    return np.stack(columns, axis=1) if len(starts) else np.zeros((0, 3), np.uint64)


def _term_features(term: str) -> np.ndarray:
    data = np.frombuffer(term.encode(), dtype=np.uint8)
    return _features(data, np.array([0]), np.array([len(data)]))[0]


def swaps(groups: tuple[tuple[str, ...], ...]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By the hash of a term: its features and those of the next term of its kind."""
    found = {}
    for group in groups:
        for term, other in zip(group, group[1:] + group[:1]):
            mine = _term_features(term)
            found[int(mine[0])] = (mine, _term_features(other))
    return found


def block_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Features of all words of a block, and the first word of each row."""
    data = LOWER[block.data]
    found = words(block, data, ALNUM)
    return _features(data, found.starts, found.ends), found.first


def labelled_features(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``y``, ``features`` and, where a group is named, the ``swapped`` ones, one row an id."""
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        "doc_id", "text", "y", F.xxhash64("text").alias("h")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = swaps(IDENTITY_TERMS)
        names = np.array(sorted(terms), dtype=np.uint64)
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first, block.rows)
                found, first = block_features(block)
                own, swapped = [], []
                for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
                    mine = np.unique(found[low:high])
                    own.append(mine.view(np.int64))
                    said = np.intersect1d(found[low:high, 0], names)
                    if len(said):
                        pairs = [terms[int(t)] for t in said]
                        left = np.setdiff1d(mine, np.concatenate([a for a, _ in pairs]))
                        other = np.union1d(left, np.concatenate([b for _, b in pairs]))
                        swapped.append(other.view(np.int64))
                    else:
                        swapped.append(None)
                listed = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("h"),
                        part.column("y"),
                        pa.array(own, type=listed),
                        pa.array(swapped, type=listed),
                    ],
                    names=["doc_id", "h", "y", "features", "swapped"],
                )

    kind = dict(chosen.dtypes)["doc_id"]
    found = chosen.mapInArrow(
        read, f"doc_id {kind}, h long, y double, features array<long>, swapped array<long>"
    )
    return one_per_id(found, "h", "y", "features", "swapped").drop("h")


class Model(NamedTuple):
    """Sorted feature hashes with their weights."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, block: Block) -> np.ndarray:
        found, first = block_features(block)
        flat = found.ravel()
        seen = np.zeros(1 << 16, dtype=bool)
        seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        maybe = np.flatnonzero(seen[(flat >> np.uint64(48)).astype(np.int64)])
        row = np.searchsorted(first, maybe // found.shape[1], side="right") - 1
        total = np.full(block.rows, self.bias)
        if len(self.hashes) and len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, flat[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == flat[maybe]
            once = np.unique(row[same] * np.int64(len(self.hashes)) + at[same])
            np.add.at(total, once // len(self.hashes), self.weights[once % len(self.hashes)])
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


class Sparse(NamedTuple):
    """Rows of present features."""

    row: np.ndarray
    column: np.ndarray
    rows: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.rows)

    def back(self, values: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], columns)


def _sparse(lists: list[np.ndarray]) -> Sparse:
    sizes = [len(x) for x in lists]
    flat = np.concatenate(lists).astype(np.int64) if sizes else np.zeros(0, np.int64)
    return Sparse(np.repeat(np.arange(len(sizes)), sizes), flat, len(sizes))


def train(
    x: Sparse,
    y: np.ndarray,
    pairs: np.ndarray,
    other: Sparse,
    columns: int,
    *,
    ridge: float = RIDGE,
    fairness: float = FAIRNESS,
    steps: int = STEPS,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over all rows; row ``pairs[k]`` pairs with ``other``'s k."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w = np.append(np.zeros(columns), np.log(rate / (1 - rate)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        p = sigmoid(x.times(w[:-1]) + w[-1])
        gap = (p - y) / len(y)
        if len(pairs):
            q = sigmoid(other.times(w[:-1]) + w[-1])
            change = fairness * 2 * (p[pairs] - q) / len(pairs)
            gap += np.bincount(pairs, change * p[pairs] * (1 - p[pairs]), len(y))
            back = -change * q * (1 - q)
            slope = x.back(gap, columns) + other.back(back, columns)
            bias = gap.sum() + back.sum()
        else:
            slope, bias = x.back(gap, columns), gap.sum()
        g = np.append(slope + ridge * w[:-1], bias)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _select(kept: DataFrame, most: int, n: int, ones: float) -> np.ndarray:
    """Hashes of the features whose rate differs most between the labels."""
    counts = kept.select("y", F.explode("features").alias("f")).groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")
    )
    rate = F.col("n") / n
    gap = F.col("n1") / ones - (F.col("n") - F.col("n1")) / (n - ones)
    z = F.abs(gap) / F.sqrt(rate * (1 - rate) * (1 / ones + 1 / (n - ones)))
    best = (
        counts.where((F.col("n") >= LEAST_DOCUMENTS) & (F.col("n") < n))
        .select("f", z.alias("z"))
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "f")
        .limit(most)
    )
    return np.sort(np.array([r["f"] for r in best.collect()], dtype=np.int64).view(np.uint64))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    *,
    label: str,
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    fairness: float = FAIRNESS,
) -> Model:
    """Fit on the labelled documents for which ``learn`` (of ``doc_id``) holds.

    ``fairness`` weighs the penalty; 0 is plain logistic regression.
    """
    sample = sample_labels(labels, "doc_id", label, learn, max_labelled)
    kept = materialize(labelled_features(docs, sample), "features")
    n, ones = kept.agg(F.count("y"), F.sum("y")).first()
    if not n or not ones or ones == n:
        rate = 0.5 if not n else min(1 - 1e-9, max(1e-9, ones / n))
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(rate / (1 - rate))))
    hashes = _select(kept, max_features, n, ones)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen(cell) -> np.ndarray | None:
            if not cell.is_valid:
                return None
            mine = cell.values.to_numpy().view(np.uint64)
            return np.flatnonzero(np.isin(hashes, mine)).astype(np.int32)

        listed = pa.list_(pa.int32())
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y"),
                    pa.array([chosen(c) for c in batch.column("features")], type=listed),
                    pa.array([chosen(c) for c in batch.column("swapped")], type=listed),
                ],
                names=["y", "features", "swapped"],
            )

    # At most MAX_LABELLED rows, of the selected features alone.
    rows = kept.mapInArrow(narrow, "y double, features array<int>, swapped array<int>").toPandas()
    own = rows["features"].tolist()
    order = sorted(range(len(own)), key=lambda k: (rows["y"][k], tuple(own[k])))
    y = rows["y"].to_numpy()[order]
    pairs = [k for k, at in enumerate(order) if rows["swapped"][at] is not None]
    weights, bias = train(
        _sparse([own[at] for at in order]),
        y,
        np.array(pairs, dtype=np.int64),
        _sparse([rows["swapped"][order[k]] for k in pairs]),
        len(hashes),
        fairness=fairness,
    )
    return Model(hashes, weights, bias)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``row`` (the columns of ``keep``) and ``score``, the chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[Block], np.ndarray]:
        known = shared.value
        return lambda block: known.scores(block)

    return scored_rows(docs, keep, prepare)
