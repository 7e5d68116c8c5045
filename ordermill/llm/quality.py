"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A document is a fixed number of statistics of its whole text. Cosines of random
projections of the standardised statistics approximate a Gaussian kernel; tasks
sum the normal equations of their labelled rows, and the sums of all tasks give
ridge scores in closed form. Half of the labelled rows, by hash of their text,
fit the ridge; the other half fit the isotonic map from scores to probabilities.

A null or empty text has the statistics of an empty text and is scored too.
Repeated rows are scored each. Labels that are null or not 0 or 1 do not count;
of several labels for one document the greatest does. Without labels of both
kinds the score is the rate of label 1, or 0.5 without any. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.text import LOWER, NOT_BLANK, Block, blocks, span_hashes, words
from ordermill.scratch import materialize

#: Labelled rows that may be fitted on: those of least text hash.
MAX_LABELLED = 20_000
FEATURES = 384
GAMMA = 0.15
RIDGE = 1.0
SEED = 7
#: Tasks that sum normal equations, and bands of rows in which these are added up.
TASKS = 8
BANDS = 16

_ALPHA_LOW = np.zeros(256, dtype=bool)
_ALPHA_LOW[97:123] = True
_ALPHA_UP = np.zeros(256, dtype=bool)
_ALPHA_UP[65:91] = True
_CLASSES = {
    "lower": _ALPHA_LOW,
    "upper": _ALPHA_UP,
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "blank": ~NOT_BLANK,
    "line": np.arange(256) == 10,
    "stop": np.isin(np.arange(256), [ord(c) for c in ".?!"]),
    "bang": np.arange(256) == ord("!"),
    "comma": np.isin(np.arange(256), [ord(c) for c in ",;:"]),
    "bar": np.isin(np.arange(256), [ord(c) for c in "|/\\<>{}[]_=~^"]),
    "sign": np.isin(np.arange(256), [ord(c) for c in "#$%&*@+"]),
    "control": np.isin(np.arange(256), [*range(9), *range(14, 32), 127]),
    "high": np.arange(256) >= 128,
}
STATISTICS = (*_CLASSES, "log_bytes", "word_length", "long_words", "distinct", "top_word",
              "same_as_last", "ends_with_sign", "capital_words", "line_words", "distinct_lines")
_N = len(STATISTICS)


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return np.diff(total[offsets]).astype(float)


def statistics(block: Block) -> np.ndarray:
    """One row of statistics for each text of a block."""
    data, at = block.data, block.offsets
    size = np.maximum(np.diff(at), 1).astype(float)
    out = np.zeros((block.rows, _N))
    for k, flags in enumerate(_CLASSES.values()):
        out[:, k] = _row_sums(flags[data], at) / size
    out[:, _N - 10] = np.log1p(np.diff(at))
    lower = LOWER[data]
    found = words(block, lower, NOT_BLANK)
    n = np.maximum(np.diff(found.first), 1).astype(float)
    if len(found.starts):
        lengths = found.ends - found.starts
        first = found.first
        hashes = span_hashes(lower, found.starts, found.ends)
        owner = np.repeat(np.arange(block.rows), np.diff(first))
        out[:, _N - 9] = _row_sums(lengths, first) / n
        out[:, _N - 8] = _row_sums(lengths > 20, first) / n
        order = np.lexsort((hashes, owner))
        own, h = owner[order], hashes[order]
        new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]))
        at_new = np.flatnonzero(new)
        runs = np.diff(np.append(at_new, len(h)))
        out[:, _N - 7] = np.bincount(own[at_new], minlength=block.rows) / n
        most = np.zeros(block.rows)
        np.maximum.at(most, own[at_new], runs)
        out[:, _N - 6] = most / n
        same = np.append(False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
        out[:, _N - 5] = _row_sums(same, first) / n
        out[:, _N - 4] = _row_sums(_CLASSES["sign"][data[found.ends - 1]], first) / n
        out[:, _N - 3] = _row_sums(_ALPHA_UP[data[found.starts]], first) / n
    lines = words(block, data, ~_CLASSES["line"])
    n_lines = np.maximum(np.diff(lines.first), 1).astype(float)
    out[:, _N - 2] = np.log1p(np.diff(found.first) / n_lines)
    if len(lines.starts):
        hashes = span_hashes(data, lines.starts, lines.ends)
        owner = np.repeat(np.arange(block.rows), np.diff(lines.first))
        order = np.lexsort((hashes, owner))
        own, h = owner[order], hashes[order]
        new = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]))
        out[:, _N - 1] = np.bincount(own[new], minlength=block.rows) / n_lines
    return out


class Model(NamedTuple):
    """Everything a task needs to score: its size depends on ``FEATURES`` alone."""

    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        return fourier((rows - self.mean) / self.scale, self.turn, self.phase)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated, between the isotonic steps by line."""
        return np.interp(self.features(rows) @ self.weights, self.steps, self.levels)


def fourier(rows: np.ndarray, turn: np.ndarray, phase: np.ndarray) -> np.ndarray:
    wave = np.sqrt(2.0 / len(phase)) * np.cos(np.clip(rows, -6, 6) @ turn + phase)
    return np.hstack([wave, np.ones((len(rows), 1))])


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the best rising map, one step for each pool."""
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []
    for x, y in zip(scores[order].tolist(), labels[order].tolist()):
        pools.append([y, 1.0, x, x])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, n, _, high = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += n
            pools[-1][3] = high
    steps, levels = [], []
    for total, n, low, high in pools:
        # Laplace: a pool of few rows is no certainty.
        level = (total + 1) / (n + 2)
        for x in (low, high):
            if not steps or x > steps[-1]:
                steps.append(x)
                levels.append(max(level, levels[-1] if levels else 0.0))
    return np.array(steps), np.array(levels)


def sample_labels(labels: DataFrame, doc_id: str, label: str, learn: Column, most: int) -> DataFrame:
    """``doc_id``, ``y``: about ``most`` labelled documents at most, by hash of their ids."""
    known = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").cast("double").alias("y"))
    )
    n = known.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / max(1, n)))
    return known.where(share)


def labelled_statistics(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``x`` (statistics), ``y``, ``h`` of the sampled documents, one row an id.

    The sample is bounded by its parameter, so it is broadcast and no text moves.
    """
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        "doc_id", "text", "y", F.xxhash64("text", "doc_id").alias("h")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                part = batch.slice(block.first, block.rows)
                rows = statistics(block)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows.tolist(), type=pa.list_(pa.float64())),
                        part.column("y"),
                        part.column("h"),
                        part.column("doc_id"),
                    ],
                    names=["x", "y", "h", "doc_id"],
                )

    kind = dict(chosen.dtypes)["doc_id"]
    return one_per_id(chosen.mapInArrow(read, f"x array<double>, y double, h long, doc_id {kind}"), "h", "y", "x")


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """The least of the rows of each ``doc_id``, so that repeats do not pass the bound."""
    return rows.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("least")).select("least.*")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, _N)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    *,
    label: str,
    max_labelled: int = MAX_LABELLED,
    features: int = FEATURES,
    gamma: float = GAMMA,
    ridge: float = RIDGE,
    seed: int = SEED,
) -> Model:
    """Fit on the labelled documents for which ``learn`` (of ``doc_id``) holds."""
    sample = sample_labels(labels, "doc_id", label, learn, max_labelled)
    kept = materialize(labelled_statistics(docs, sample), "statistics")
    sums = kept.select(F.posexplode("x")).groupBy("pos").agg(
        F.avg("col").alias("mean"), F.stddev_pop("col").alias("scale")
    )
    mean, scale = np.zeros(_N), np.ones(_N)
    for row in sums.collect():  # one row per statistic
        mean[row["pos"]] = row["mean"]
        scale[row["pos"]] = row["scale"] if row["scale"] and row["scale"] > 1e-9 else 1.0
    rng = np.random.Generator(np.random.PCG64(seed))
    turn = rng.normal(0.0, np.sqrt(2 * gamma), (_N, features))
    phase = rng.uniform(0.0, 2 * np.pi, features)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        seen = 0
        for batch in batches:
            rows = fourier((_matrix(batch) - mean) / scale, turn, phase)
            left += rows.T @ rows
            right += rows.T @ batch.column("y").to_numpy()
            seen += len(rows)
        if seen:
            bands = np.array_split(np.hstack([left, right[:, None]]), BANDS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(BANDS), type=pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * BANDS, type=pa.int32()),
                    pa.array([band.tobytes() for band in bands], type=pa.binary()),
                ],
                names=["band", "task", "sums"],
            )

    def add_up(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")
        sums = sum(np.frombuffer(part.as_py()) for part in parts.column("sums"))
        return pa.table(
            {"band": parts.column("band").slice(0, 1), "sums": pa.array([sums.tobytes()], pa.binary())}
        )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = fourier((_matrix(batch) - mean) / scale, turn, phase)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows @ weights), batch.column("y")], names=["s", "y"]
            )

    fitting = kept.where("h % 2 = 0").repartition(TASKS, "h").sortWithinPartitions("h", "y")
    sums = fitting.mapInArrow(equations, "band int, task int, sums binary")
    sums = sums.groupBy("band").applyInArrow(add_up, "band int, sums binary")
    total = np.zeros((features + 1, features + 2))
    found = sorted((row["band"], bytes(row["sums"])) for row in sums.collect())  # one matrix
    if found:
        total = np.concatenate([np.frombuffer(part) for _, part in found]).reshape(total.shape)
    keep_bias = np.full(features + 1, ridge)
    keep_bias[-1] = 1e-9
    weights = np.linalg.solve(total[:, :-1] + np.diag(keep_bias), total[:, -1])
    # Half of the bounded sample: two numbers a row.
    held = kept.where("h % 2 != 0").mapInArrow(scored, "s double, y double").toPandas()
    rate = kept.agg(F.avg("y")).first()[0]
    if held["y"].nunique() < 2 or not total[-1, -2]:
        flat = np.array([0.5 if rate is None else rate])
        return Model(mean, scale, turn, phase, np.zeros(features + 1), np.zeros(1), flat)
    held = held.sort_values(["s", "y"])
    steps, levels = isotonic(held["s"].to_numpy(), held["y"].to_numpy())
    return Model(mean, scale, turn, phase, weights, steps, levels)


def scored_rows(
    docs: DataFrame, keep: list[str], prepare: Callable[[], Callable[[Block], np.ndarray]]
) -> DataFrame:
    """``row``, a struct of the columns of ``keep``, and ``score`` of its text.

    Nothing is shuffled. The struct lets kept columns have any name.
    """
    inside = "text" in keep
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    chosen = docs.select(row) if inside else docs.select(row, "text")
    schema = T.StructType([chosen.schema["row"], T.StructField("score", T.DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probability = prepare()
        for batch in batches:
            rows = batch.column("row")
            texts = rows.field("text") if inside else batch.column("text")
            for block in blocks(texts):
                found = np.clip(probability(block), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(block.first, block.rows), pa.array(found)], names=["row", "score"]
                )

    return chosen.mapInArrow(judge, schema)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``row`` (the columns of ``keep``) and ``score``, the chance of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare() -> Callable[[Block], np.ndarray]:
        known = shared.value
        return lambda block: known.probability(statistics(block))

    return scored_rows(docs, keep, prepare)


def judged(scored: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    """The columns of a result: ``held_out``, ``score``, ``predicted``."""
    return scored.select("row.*", "score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
