"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, packed, rest_field, slices, spark_schema, texts_of, tidy, unpacked
from quayside.session import materialize

_SYMBOLS = b"#*$%&|<>"
_ENDS = (".", "!", "?", ":", ";", '"', "'", ")", "…")
_MARKED = re.compile(r"[^\w\s]{2,}(?=\s|$)")

FEATURES = (
    "log_words", "word_length", "word_length_spread", "symbols", "bangs", "digits", "other_marks", "non_ascii",
    "capitals", "capital_words", "marked_words", "different_words", "top_word", "repeats_next", "repeated_windows",
    "log_lines", "repeated_lines", "ended_lines", "line_length", "barred_chars", "worst_line", "deflated",
)


def statistics(text: str) -> list[float]:
    """What is told of a text, in the order of ``FEATURES``; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = text.encode()
    chars = len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    by_word = Counter(words)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text))) or 1
    upper = chars - len(re.sub(r"[A-ZÀ-ÖØ-Þ]+", "", text))
    windows = max(1, n - 2)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    marked = len(_MARKED.findall(text))
    barred = [line for line in lines if line.count(" | ") > 1]
    return [
        np.log1p(n),
        float(lengths.mean()),
        float(lengths.std()),
        symbols / chars,
        text.count("!") / chars,
        (len(raw) - len(raw.translate(None, b"0123456789"))) / chars,
        (len(raw) - len(raw.translate(None, b".,;:?\"'()-"))) / chars,
        (len(raw) - chars) / chars,
        upper / letters,
        sum(c for w, c in by_word.items() if w.isupper() and len(w) > 1) / n,
        marked / n,
        len(by_word) / n,
        max(by_word.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 0.0,
        np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip().endswith(_ENDS) for line in lines) / len(lines),
        np.log1p(chars / len(lines)),
        sum(map(len, barred)) / chars,
        max(sum(map(line.count, "#*$%&|<>!")) / len(line) for line in lines),
        len(zlib.compress(raw, 1)) / len(raw),
    ]


@dataclass(frozen=True)
class QualityModel:
    """All a worker needs to score; its size follows from the parameters alone."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Fourier features of rows of statistics, with a constant and the standardised statistics themselves."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([np.ones((len(z), 1)), waves, z])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lifted(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated share of label 1 between 0 and 1."""
        return np.interp(self.raw(x), self.knots, self.levels) if len(self.knots) else np.full(len(x), 0.5)


def isotonic(totals: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Shares of ones that never fall from bin to bin, closest to the bins' own (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for total, one in zip(totals.tolist(), ones.tolist()):
        blocks.append([total, one, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            total, one, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + one, blocks[-1][2] + size]
    return np.concatenate([np.full(size, one / total) for total, one, size in blocks]) if blocks else np.zeros(0)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (array of ``FEATURES``) of every whole text; null texts as empty ones. No shuffle."""
    schema = spark_schema([("doc_id", docs.schema["doc_id"].dataType), ("x", T.ArrayType(T.DoubleType(), False))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = [statistics(text or "") for text in texts_of(part)]
                yield arrow_batch(arrow, {"doc_id": part.column("doc_id"), "x": x})

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))


def _summed(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the vectors (binary doubles) of each ``part``: first per partition, then per part; a fixed number of rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                vector = np.frombuffer(data)
                sums[part] = sums[part] + vector if part in sums else vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "data"]
        )

    total = vectors.repartition("part").mapInArrow(add, "part int, data binary")
    return {row["part"]: np.frombuffer(row["data"]) for row in total.collect()}


def fit(
    examples: DataFrame, waves: int = 256, width: float = 1.0, ridge: float = 1e-3, bins: int = 1000, seed: int = 7
) -> QualityModel:
    """A model from rows of x, label (0 or 1) and calibrate (boolean).

    ``width`` is the kernel's, in units of the square root of the number of statistics. Rows that are not
    for calibration are standardised by their own mean and spread, lifted to ``waves`` Fourier features,
    and each partition adds up its normal equations; the driver gets their sum, whose size depends on
    ``waves`` alone. Rows for calibration are counted by bins of their ridge score (``bins`` of equal
    width), and the bins are made monotone. Any number of rows fits; none gives a model that says 0.5.
    """
    examples = examples.where(F.col("label").isin(0, 1))
    to_fit = examples.where(~F.col("calibrate"))
    d = len(FEATURES)
    # The width of the sums depends on the number of statistics only.
    moments = to_fit.select(
        F.count("*").alias("n"),
        *[F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(d)],
        *[F.sum(F.col("x")[k] * F.col("x")[k]).alias(f"q{k}") for k in range(d)],
    ).first()
    n = moments["n"]
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(d, waves)) / (width * np.sqrt(d))
    phases = rng.uniform(0, 2 * np.pi, waves)
    empty = QualityModel(np.zeros(d), np.ones(d), directions, phases, np.zeros(1 + waves + d), np.zeros(0), np.zeros(0))
    if not n:
        return empty
    mean = np.array([moments[f"s{k}"] for k in range(d)]) / n
    spread = np.sqrt(np.maximum(np.array([moments[f"q{k}"] for k in range(d)]) / n - mean**2, 0))
    model = QualityModel(mean, np.where(spread > 1e-9, spread, 1.0), directions, phases, empty.weights, empty.knots, empty.levels)
    size = len(empty.weights)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, size + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                lifted = model.lifted(_rows(some))
                label = some.column("label").to_numpy(zero_copy_only=False).astype(float)
                sums += lifted.T @ np.hstack([lifted, label[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([row.tobytes() for row in sums], pa.binary())], ["part", "data"]
        )

    by_row = _summed(to_fit.select("x", "label").mapInArrow(normal, "part int, data binary"))
    system = np.stack([by_row[k] for k in range(size)])
    gram, right = system[:, :-1], system[:, -1]
    weights = np.linalg.solve(gram + ridge * n * np.diag([1e-6, *np.ones(waves), *np.full(d, 0.1)]), right)
    model = QualityModel(model.mean, model.scale, directions, phases, weights, empty.knots, empty.levels)

    edges = np.linspace(-0.5, 1.5, bins + 1)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, bins))
        for batch in batches:
            if batch.num_rows:
                at = np.clip(np.searchsorted(edges, model.raw(_rows(batch)), "right") - 1, 0, bins - 1)
                label = batch.column("label").to_numpy(zero_copy_only=False)
                for k in (0, 1):
                    sums[k] += np.bincount(at[label == k], minlength=bins)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array([row.tobytes() for row in sums], pa.binary())], ["part", "data"]
        )

    counts = _summed(examples.where("calibrate").select("x", "label").mapInArrow(binned, "part int, data binary"))
    zeros, ones = counts.get(0, np.zeros(bins)), counts.get(1, np.zeros(bins))
    used = np.flatnonzero(zeros + ones)
    if not len(used):
        # Nothing to calibrate by: the ridge score itself, within 0 and 1.
        return QualityModel(model.mean, model.scale, directions, phases, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    centres = (edges[used] + edges[used + 1]) / 2
    levels = isotonic((zeros + ones)[used], ones[used])
    return QualityModel(model.mean, model.scale, directions, phases, weights, centres, levels)


def held_out() -> F.Column:
    """Rows never learned from: CRC-32 of the id as text leaves 2 when divided by 4; a null id is not one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(statistics_table: DataFrame, labels: DataFrame, **parameters) -> QualityModel:
    """A model from labelled documents that are not held out; remainder 1 calibrates, the others fit.

    Labels other than 0 and 1 and ids without a document are left out; several labels of a document are
    several examples.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out() & F.col("label").isin(0, 1))
    joined = statistics_table.join(known, "doc_id").withColumn("calibrate", remainder == 1)
    return fit(materialize(joined.select("x", "label", "calibrate"), "examples"), **parameters)


def score_statistics(statistics_table: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of each row of statistics; empty texts are scored like others."""
    schema = spark_schema([("doc_id", statistics_table.schema["doc_id"].dataType), ("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield arrow_batch(arrow, {"doc_id": batch.column("doc_id"), "score": model.score(_rows(batch))})

    return statistics_table.select("doc_id", "x").mapInArrow(run, schema)


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Documents with their score, in one pass over the texts; a column named score gives way.

    Null texts count as empty and are scored; repeated rows, null ids and other columns pass. No rows, no
    rows.
    """
    schema = T.StructType([rest_field(docs), *spark_schema([("text", T.StringType()), ("score", T.DoubleType())]).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = np.array([statistics(text or "") for text in texts_of(part)]).reshape(-1, len(FEATURES))
                rest = part.column("rest").cast(arrow.field("rest").type)
                yield arrow_batch(arrow, {"rest": rest, "text": part.column("text").cast(pa.string()), "score": model.score(x)})

    return unpacked(packed(docs).mapInArrow(tidy(run), schema), docs.columns, ["score"])
