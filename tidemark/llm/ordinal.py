"""Quality by ordinal regression on graded ratings: a cumulative-link model over hashed text.

P(grade <= k) = logistic(threshold_k - f(text)) with thresholds in order and one f for all of them: the mean weight
of the text's hashed words, their first three, four and five and last three bytes, and six measures of the whole text.
From it come the expected grade and the probability of a grade at least as high as asked, by which texts are selected.

The fit sees a bounded sample: at most ``per_grade`` rows of each grade, those with the smallest hash of the id, of at
most ``most_chars`` characters. Scoring sees whole texts. Defined results: a null or blank text is scored by its
measures alone; grades that were never seen have probability near 0; without ratings every grade is equally
likely; null ids or grades are no training rows; repeated rows have equal results; very long texts are scored whole; all columns of the
table are kept, but for those that have the results' names; an empty table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import attempt_name, open_input, open_output, shared_dir, written
from tidemark.llm.samples import smallest_hashes
from tidemark.llm.textscan import SPACES, WordScanner, column_bytes, rows_of, slices
from tidemark.llm.toxicity import _FOLD, CHARS, WORDS, word_features

MEASURES = 6


def _measures(data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Six numbers of each row, each of about unit size."""
    size, words = np.diff(offsets), np.diff(first)

    def share(flags):
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=upto[1:])
        return (upto[offsets[1:]] - upto[offsets[:-1]]) / np.maximum(1, size)

    digit = (data >= 48) & (data < 58)
    upper = (data >= 65) & (data < 91)
    letter = upper | ((data >= 97) & (data < 123)) | (data >= 128)
    row = rows_of(first)
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][new], minlength=len(size))
    white = (data == 32) | (data == 10)
    return np.stack([np.log1p(words) / 5, size / np.maximum(1, words) / 8, 4 * share(~(digit | letter | white)), 4 * share(digit), 4 * share(upper), distinct / np.maximum(1, words)], 1).astype(np.float32)


class CumulativeLink:
    def __init__(self, weights: np.ndarray, measures: np.ndarray, thresholds: np.ndarray):
        self.weights, self.measures, self.thresholds = weights, measures, thresholds

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, w=self.weights.astype(np.float16), m=self.measures, t=self.thresholds)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> CumulativeLink:
        x = np.load(io.BytesIO(raw))
        return CumulativeLink(x["w"].astype(np.float32), x["m"], x["t"])

    def probabilities(self, f: np.ndarray) -> np.ndarray:
        """Of each grade, one row a text."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - f[:, None], -40, 40)))
        edge = np.concatenate([np.zeros((len(f), 1)), below, np.ones((len(f), 1))], 1)
        return np.diff(edge, axis=1)


def fit(texts: list[bytes], grades: np.ndarray, n_grades: int, steps: int = 80) -> CumulativeLink:
    """Maximum likelihood with a small penalty, by Adam on all texts at once."""
    if not len(grades):
        share = np.arange(1, n_grades) / n_grades
        return CumulativeLink(np.zeros(WORDS + CHARS, np.float32), np.zeros(MEASURES, np.float32), np.log(share / (1 - share)))
    scanner = WordScanner(SPACES)
    rows, places, weight, dense = [], [], [], []
    for r, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        at = np.array([0, len(data)])
        starts, ends, first = scanner.split(data, at)
        hashes = scanner.hashes(data, starts, ends)
        dense.append(_measures(data, at, hashes, first))
        if len(starts):
            place, n = np.unique(word_features(data, starts, ends, hashes, _FOLD), return_counts=True)
            rows.append(np.full(len(place), r))
            places.append(place)
            weight.append(n / len(starts))
    rows, places, weight = (np.concatenate([*x, np.zeros(0)]) for x in (rows, places, weight))
    used, at = np.unique(places.astype(np.int64), return_inverse=True)
    rows, weight, dense = rows.astype(np.int64), weight.astype(np.float64), np.concatenate(dense).astype(np.float64)
    n = len(grades)
    seen = np.cumsum(np.bincount(grades, minlength=n_grades) + 0.5)[:-1] / (n + 0.5 * n_grades)
    start = np.log(seen / (1 - seen))
    # thresholds are the first one and the logarithms of the steps between them, so they stay in order
    p = [np.zeros(len(used)), np.zeros(MEASURES), np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    balance = 1 / np.maximum(1, np.bincount(grades, minlength=n_grades))[grades]
    balance *= n / balance.sum()
    for step in range(1, steps + 1):
        t = np.concatenate([p[2][:1], p[2][0] + np.cumsum(np.exp(p[2][1:]))])
        f = np.bincount(rows, weight * p[0][at], n) + dense @ p[1]
        edges = np.concatenate([[-40.0], t, [40.0]])
        hi, lo = edges[grades + 1] - f, edges[grades] - f
        s_hi, s_lo = (1 / (1 + np.exp(-np.clip(x, -40, 40))) for x in (hi, lo))
        gap = np.maximum(s_hi - s_lo, 1e-9)
        d_hi, d_lo = s_hi * (1 - s_hi) / gap * balance, s_lo * (1 - s_lo) / gap * balance  # of the log likelihood
        d_f = (d_hi - d_lo) / n
        d_edge = np.bincount(grades + 1, -d_hi / n, n_grades + 1) + np.bincount(grades, d_lo / n, n_grades + 1)
        d_t = d_edge[1:-1]
        tail = np.cumsum(d_t[::-1])[::-1]
        grad = [np.bincount(at, weight * d_f[rows], len(used)) + 1e-6 * p[0], dense.T @ d_f + 1e-4 * p[1], np.concatenate([tail[:1], tail[1:] * np.exp(p[2][1:])])]
        for k, (x, g) in enumerate(zip(p, grad)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            x -= (1.0, 0.1, 0.05)[k] * (1 - 0.8 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-9)
    weights = np.zeros(WORDS + CHARS, np.float32)
    weights[used] = p[0]
    return CumulativeLink(weights, p[1].astype(np.float32), np.concatenate([p[2][:1], p[2][0] + np.cumsum(np.exp(p[2][1:]))]))


def training_rows(docs: DataFrame, rated: DataFrame, grade_col: str = "grade", text_col: str = "text", id_col: str = "doc_id", per_grade: int = 1500, seed: int = 5, n_grades: int = 3) -> DataFrame:
    """(id_col, text_col, grade_col) of documents with a grade: at most 2 * ``per_grade`` ids of each grade, chosen before texts are read.

    The ids that are chosen, a bounded number, are what is broadcast. Grades are whole numbers from 0 to ``n_grades`` - 1, others and
    null are left out; an id with several grades has the highest.
    """
    grade = F.col(grade_col).cast("int")
    own = rated.where(F.col(id_col).isNotNull() & grade.between(0, n_grades - 1)).groupBy(id_col).agg(F.max(grade).alias(grade_col))
    picked = smallest_hashes(own, grade_col, id_col, 2 * per_grade, seed)
    return docs.select(id_col, text_col).join(F.broadcast(picked), id_col)


def train_model(rated: DataFrame, grade_col: str = "grade", n_grades: int = 3, text_col: str = "text", id_col: str = "doc_id", per_grade: int = 1500, most_chars: int = 20_000, seed: int = 5) -> str:
    """Fit on a bounded sample of ``rated`` in one task; the address of the model file."""
    folder = shared_dir(rated.sparkSession, "ordinal")
    rows = rated.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(grade_col).cast("int").alias("y"))
    rows = rows.where(f"id is not null and y between 0 and {n_grades - 1} and length(coalesce(text, '')) <= {most_chars}")
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id", F.lit(seed)), "id", "text"))
    sample = rows.withColumn("place", place).where(F.col("place") <= per_grade).drop("place")
    # a row of nulls, which is skipped: there is a task, and a model, without any sample
    sample = sample.unionAll(rows.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType) for f in sample.schema]))

    def run(batches):
        got = sorted((r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))) if r[0] is not None), key=lambda r: (r[0], r[2], r[1] or ""))
        model = fit([(t or "").encode("utf-8", "replace") for _, t, _ in got], np.array([y for *_, y in got], np.int64), n_grades)
        path = f"{folder}/{attempt_name('model')}.npz"
        with open_output(path) as out:
            out.write(model.dump())
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return written(sample.repartition(1).mapInArrow(run, "path string"), f"{folder}/fitted").first().path


def with_grades(docs: DataFrame, model: str, at_least: int = 2, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade and tail_probability, P(grade >= at_least), of each whole text; columns of these names are replaced."""
    docs = docs.drop("expected_grade", "tail_probability")
    column = docs.columns.index(text_col)

    def run(batches):
        with open_input(model) as f:
            link = CumulativeLink.load(f.read())
        scanner = WordScanner(SPACES)
        for batch in batches:
            data, offsets = column_bytes(batch.column(column))
            f = np.zeros(batch.num_rows)
            for i, j in slices(offsets):
                part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = scanner.split(part, local)
                hashes = scanner.hashes(part, starts, ends)
                got = _measures(part, local, hashes, first) @ link.measures.astype(np.float64)
                if len(hashes):
                    _, example, back = np.unique(hashes, return_index=True, return_inverse=True)
                    own = link.weights[word_features(part, starts[example], ends[example], hashes[example], _FOLD)].sum(1, dtype=np.float64)[back]
                    counts = np.diff(first)
                    full = np.flatnonzero(counts)
                    got[full] += np.add.reduceat(own, first[full]) / counts[full]
                f[i:j] = got
            q = link.probabilities(f)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(q @ np.arange(q.shape[1])), pa.array(q[:, at_least:].sum(1))], names=[*batch.schema.names, "expected_grade", "tail_probability"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, expected_grade double, tail_probability double")
