"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is the sum of a hashed word vector and hashed vectors of its first three, four and five and its last
three bytes, so a word that was never seen is judged by its characters. Texts are cut into windows of 32 words, each
of which shares 8 with the next; both recurrences run over every window, attention pools their states, and a text's score is that of
its highest window, calibrated on documents that were kept from training.

Labels say only that a text is toxic, not where. Training therefore picks windows: at first those whose words speak
most for the label, later those that the network itself finds highest; clean texts give their highest windows and
others at random.

The fit sees a bounded sample: at most ``per_class`` rows of each label, those with the smallest hash of the id, of at
most ``most_chars`` characters. Scoring sees whole texts. Defined results: a null, blank or wordless text is one empty
window and has a score; without labels of both kinds every score is 0.02; repeated rows have equal scores; a null id or
label is no training row; ids are cast to whole numbers for training only; all columns of the scored table are kept, but for one that
has the name of the score; an empty table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import attempt_name, open_input, open_output, shared_dir, written
from tidemark.llm.samples import smallest_hashes
from tidemark.llm.textscan import NON_ALNUM, WordScanner, column_bytes, mix, slices

WINDOW, STRIDE = 32, 24
SIZE = 8  # of a word's input and of each recurrence's state
WORDS, CHARS = 1 << 18, 1 << 16
BLOCK = 2048  # windows that run together


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Five table places for each word: the word itself, its first 3, 4, 5 bytes and its last 3."""
    out = np.empty((len(starts), 5), np.int64)
    out[:, 0] = hashes >> np.uint64(64 - 18)
    last = len(data) - 1
    front = np.zeros(len(starts), np.uint64)
    for k in range(5):
        at = starts + k
        front |= np.where(at < ends, fold[data[np.minimum(at, last)]], 0).astype(np.uint64) << np.uint64(8 * k)
        if k >= 2:
            out[:, k - 1] = WORDS + (mix(front + np.uint64((k + 1) << 56)) >> np.uint64(48)).astype(np.int64)
    back = np.zeros(len(starts), np.uint64)
    for k in range(3):
        at = ends - 1 - k
        back |= np.where(at >= starts, fold[data[np.maximum(at, 0)]], 0).astype(np.uint64) << np.uint64(8 * k)
    out[:, 4] = WORDS + (mix(back + np.uint64(1 << 60)) >> np.uint64(48)).astype(np.int64)
    return out


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of all windows of all rows."""
    counts = np.diff(first)
    per_row = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(counts)), per_row)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = first[:-1][row] + k * STRIDE
    return row, begin, np.minimum(WINDOW, first[1:][row] - begin)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGRU:
    """Parameters: tables E; for each direction input W, b and state U; attention v, readout w, c; calibration a, s."""

    def __init__(self, params: dict | None = None, seed: int = 0):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = params or {
            "E": (rng.standard_normal((WORDS + CHARS, SIZE)) * 0.02).astype(np.float32),
            **{f"{n}{d}": x for d in "fb" for n, x in (("W", small(3 * SIZE, SIZE)), ("b", np.zeros((3 * SIZE, 1), np.float32)), ("U", small(3 * SIZE, SIZE)))},
            "v": small(2 * SIZE), "w": small(2 * SIZE), "c": np.full(1, -1, np.float32), "a": np.ones(1, np.float32), "s": np.zeros(1, np.float32),
        }

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: x.astype(np.float16) if k == "E" else x for k, x in self.p.items()})
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> BiGRU:
        return BiGRU({k: x.astype(np.float32) for k, x in np.load(io.BytesIO(raw)).items()})

    def inputs(self, features: np.ndarray) -> np.ndarray:
        """The input vectors, one column a word, of rows of table places."""
        return np.ascontiguousarray(sum(self.p["E"][features[:, k]] for k in range(5)).T)

    def _run(self, x, d, begin, size, keep):
        p, h, n = self.p, SIZE, len(begin)
        gates = p[f"W{d}"] @ x + p[f"b{d}"]
        state = np.zeros((h, n), np.float32)
        states = np.empty((WINDOW, h, n), np.float32)
        tape = [None] * WINDOW
        padded = size.min(initial=WINDOW) < WINDOW
        last = max(0, x.shape[1] - 1)
        steps = range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1)
        if not keep:
            gates[: 2 * h] *= 0.5
            half = p[f"U{d}"].copy()
            half[: 2 * h] *= 0.5
            g, u = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
            rz, r, z, new = g[: 2 * h], g[:h], g[h : 2 * h], g[2 * h :]
            shortest = size.min(initial=WINDOW)
            for t in steps:
                np.take(gates, np.minimum(begin + t, last), axis=1, out=g, mode="clip")
                np.matmul(half, state, out=u)
                rz += u[: 2 * h]
                np.tanh(rz, out=rz)
                rz *= 0.5
                rz += 0.5
                u[2 * h :] *= r
                new += u[2 * h :]
                np.tanh(new, out=new)
                if shortest <= t:
                    z[:, size <= t] = 1  # past a window's end the state stays
                state = np.subtract(state, new, out=states[t])
                state *= z
                state += new
            return states, None
        for t in steps:
            at = np.minimum(begin + t, last)
            g = np.take(gates, at, axis=1)
            u = p[f"U{d}"] @ state
            rz = _sigmoid(g[: 2 * h] + u[: 2 * h])
            r, z = rz[:h], rz[h:]
            new = np.tanh(g[2 * h :] + r * u[2 * h :])
            out = new + z * (state - new)
            if padded:
                on = size > t
                out = np.where(on, out, state)
            if keep:
                tape[t] = (state, r, z, new, u[2 * h :], size > t)
            states[t] = state = out
        return states, tape

    def forward(self, x, begin, size, keep=False):
        """Logits of windows of word inputs ``x``."""
        if not x.shape[1]:
            return np.full(len(begin), self.p["c"][0], np.float32), None
        runs = {d: self._run(x, d, begin, size, keep) for d in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=1)
        raw = np.einsum("thn,h->tn", states, self.p["v"])
        on = np.arange(WINDOW)[:, None] < size
        raw = np.where(on, raw, -30)
        alpha = np.exp(raw - raw.max(0))
        alpha *= on
        alpha /= np.maximum(alpha.sum(0), 1e-6)
        pooled = np.einsum("tn,thn->hn", alpha, states)
        return self.p["w"] @ pooled + self.p["c"][0], (runs, states, alpha, pooled)

    def logits(self, x, begin, size):
        """Logits of windows in order of their first words; ``x`` may be an index into input vectors: (vectors, index)."""
        vectors, index = x if isinstance(x, tuple) else (x, None)
        n = vectors.shape[1] if index is None else len(index)
        out = [np.zeros(0, np.float32)]
        for i in range(0, len(begin), BLOCK):
            b, s = begin[i : i + BLOCK], size[i : i + BLOCK]
            low, high = int(b[0]), int(min(n, b[-1] + WINDOW))
            out.append(self.forward(vectors[:, low:high] if index is None else vectors[:, index[low:high]], b - low, s)[0])
        return np.concatenate(out)

    def gradients(self, features, begin, size, labels, weights):
        """Gradients of the weighted cross entropy over some windows; E's as (places, values)."""
        p, h = self.p, SIZE
        span = np.minimum(begin[:, None] + np.arange(WINDOW), len(features) - 1)
        own = features[span.reshape(-1)]  # a copy of the words of each window
        x = self.inputs(own)
        begin = np.arange(len(begin)) * WINDOW
        logit, (runs, states, alpha, pooled) = self.forward(x, begin, size, keep=True)
        err = ((_sigmoid(logit) - labels) * weights / len(labels)).astype(np.float32)
        grad = {"c": err.sum(keepdims=True), "w": pooled @ err}
        d_pooled = p["w"][:, None] * err
        d_alpha = np.einsum("thn,hn->tn", states, d_pooled)
        d_raw = alpha * (d_alpha - (alpha * d_alpha).sum(0))
        grad["v"] = np.einsum("tn,thn->h", d_raw, states)
        d_states = alpha[:, None, :] * d_pooled + d_raw[:, None, :] * p["v"][None, :, None]
        d_x = np.zeros_like(x)
        for d, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            tape = runs[d][1]
            d_gates = np.zeros((3 * h, x.shape[1]), np.float32)
            d_u = np.zeros_like(p[f"U{d}"])
            carry = np.zeros((h, len(begin)), np.float32)
            for t in range(WINDOW - 1, -1, -1) if d == "f" else range(WINDOW):
                state, r, z, new, hn, on = tape[t]
                full = d_states[t, part] + carry
                got = np.where(on, full, 0)
                d_new = got * (1 - z) * (1 - new * new)
                d_z = got * (state - new) * z * (1 - z)
                d_r = d_new * hn * r * (1 - r)
                d_uu = np.concatenate([d_r, d_z, d_new * r])
                d_gates[:, begin + t] = np.concatenate([d_r, d_z, d_new])
                d_u += d_uu @ state.T
                carry = got * z + p[f"U{d}"].T @ d_uu + np.where(on, 0, full)
            grad |= {f"U{d}": d_u, f"W{d}": d_gates @ x.T, f"b{d}": d_gates.sum(1, keepdims=True)}
            d_x += p[f"W{d}"].T @ d_gates
        places, back = np.unique(own.reshape(-1), return_inverse=True)
        rows = np.repeat(d_x.T, 5, axis=0)
        values = np.stack([np.bincount(back, rows[:, k], len(places)) for k in range(SIZE)], 1).astype(np.float32)
        return grad, (places, values)


class _Adam:
    def __init__(self, params, rate):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in params.items()}
        self.v = {k: np.zeros_like(x) for k, x in params.items()}

    def step(self, grad, table):
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grad.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)
        at, g = table
        m = self.m["E"][at] = self.m["E"][at] * 0.9 + 0.1 * g
        v = self.v["E"][at] = self.v["E"][at] * 0.999 + 0.001 * g * g
        self.params["E"][at] -= scale * m / (np.sqrt(v) + 1e-7)


def _parts(scanner, data, offsets):
    """Features of the words of some rows, and the rows' first words."""
    starts, ends, first = scanner.split(data, offsets)
    return word_features(data, starts, ends, scanner.hashes(data, starts, ends), _FOLD), first


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 6, seed: int = 0) -> BiGRU:
    """Train on whole texts with 0/1 labels."""
    net, rng = BiGRU(seed=seed), np.random.default_rng(seed)
    if not len(labels) or labels.min() == labels.max():
        net.p["w"][:] = 0
        net.p["c"][:] = -4
        return net
    scanner = WordScanner(NON_ALNUM)
    features, counts = [], []
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        f, first = _parts(scanner, data, np.array([0, len(data)])) if len(data) else (np.zeros((0, 5), np.int64), np.zeros(2, np.int64))
        features.append(f)
        counts.append(len(f))
    features = np.concatenate([*features, np.zeros((1, 5), np.int64)])
    first = np.concatenate([[0], np.cumsum(counts)])
    row, begin, size = windows_of(first)
    train = np.arange(len(labels)) % 5 != 0
    # evidence of each table place: in how many training texts of each label it occurs
    doc = np.repeat(np.arange(len(labels)), counts)
    evidence = np.zeros(WORDS + CHARS, np.float32)
    n1, n0 = max(1, (train & (labels == 1)).sum()), max(1, (train & (labels == 0)).sum())
    for k in range(5):
        pair = np.unique(doc * np.int64(WORDS + CHARS) + features[:-1, k])
        d, at = pair // (WORDS + CHARS), pair % (WORDS + CHARS)
        one, zero = (np.bincount(at[train[d] & (labels[d] == y)], minlength=WORDS + CHARS) for y in (1, 0))
        evidence += np.where(one + zero > 0, np.log((one + 0.5) / (n1 + 1)) - np.log((zero + 0.5) / (n0 + 1)), 0) * np.minimum(1, (one + zero) / 4)
    net.p["E"][:, 0] += np.clip(evidence, -4, 4) / 4
    word = np.append(np.clip(evidence[features[:-1]].sum(1), -12, 12), 0)
    height = np.array([word[b : b + s].max(initial=-12) for b, s in zip(begin, size)])
    adam = _Adam(net.p, 0.01)
    bag = np.flatnonzero(train[row])
    # a small sample goes in smaller steps and more often, so that every fit takes some hundred steps
    batch = 256 if train.sum() > 1500 else 32
    epochs = max(epochs, min(40, -(-240 * batch // (4 * max(1, int(train.sum()))))))
    for epoch in range(epochs):
        order = np.lexsort((-height[bag], row[bag]))
        place = np.arange(len(order)) - np.searchsorted(row[bag][order], row[bag][order])
        picked = bag[order]
        toxic = labels[row[picked]] == 1
        chosen = picked[np.where(toxic, place < 1, (place < 3) | (rng.random(len(picked)) < 2 / np.maximum(1, np.bincount(row, minlength=len(labels))[row[picked]])))]
        y = labels[row[chosen]].astype(np.float32)
        weight = np.where(y == 1, (1 - y).sum() / max(1, y.sum()), 1) * 0.5
        mixed = rng.permutation(len(chosen))
        adam.rate = 0.01 * (1 - 0.9 * epoch / epochs)
        for i in range(0, len(mixed), batch):
            b = mixed[i : i + batch]
            at = chosen[b]
            adam.step(*net.gradients(features, begin[at], size[at], y[b], weight[b]))
        if epoch >= 1:
            x = net.inputs(features)
            height = net.logits(x, begin, size)
    top = np.full(len(labels), -30.0)
    np.maximum.at(top, row, net.logits(net.inputs(features), begin, size))
    z, y = top[~train], labels[~train].astype(float)
    a, s = 1.0, 0.0
    if len(y) and 0 < y.mean() < 1:  # logistic calibration on the texts that were kept back
        zs = (z - z.mean()) / (z.std() + 1e-6)
        w = np.zeros(2)
        design = np.stack([zs, np.ones_like(zs)], 1)
        for _ in range(50):
            q = _sigmoid(design @ w)
            hess = design.T @ (design * (q * (1 - q))[:, None]) + np.eye(2) * 0.5
            w -= np.linalg.solve(hess, design.T @ (q - y) + 0.5 * w)
        a, s = w[0] / (z.std() + 1e-6), w[1] - w[0] * z.mean() / (z.std() + 1e-6)
    net.p["a"][:], net.p["s"][:] = max(a, 1e-3), s
    return net


def train_model(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id", per_class: int = 1500, most_chars: int = 20_000, seed: int = 11) -> str:
    """Fit on a bounded sample of ``labelled`` in one task; the address of the model file, which all executors can read."""
    folder = shared_dir(labelled.sparkSession, "toxicity")
    rows = labelled.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("y"))
    rows = rows.where(f"id is not null and y in (0, 1) and length(coalesce(text, '')) <= {most_chars}")
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id", F.lit(seed)), "id", "text"))
    sample = rows.withColumn("place", place).where(F.col("place") <= per_class).drop("place")
    # a row of nulls, which is skipped: there is a task, and a model, without any sample
    sample = sample.unionAll(rows.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType) for f in sample.schema]))

    def run(batches):
        got = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3))) if r[0] is not None]
        got.sort(key=lambda r: (r[0], r[2], r[1] or ""))
        net = fit([(t or "").encode("utf-8", "replace") for _, t, _ in got], np.array([y for *_, y in got], np.int64))
        path = f"{folder}/{attempt_name('model')}.npz"
        with open_output(path) as out:
            out.write(net.dump())
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return written(sample.repartition(1).mapInArrow(run, "path string"), f"{folder}/fitted").first().path


def with_scores(docs: DataFrame, model: str, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text; a column that has the score's name already is replaced."""
    docs = docs.drop(out_col) if out_col != text_col else docs
    at = docs.columns.index(text_col)

    def run(batches):
        with open_input(model) as f:
            net = BiGRU.load(f.read())
        scanner = WordScanner(NON_ALNUM)
        for batch in batches:
            data, offsets = column_bytes(batch.column(at))
            scores = np.empty(batch.num_rows, np.float64)
            for i, j in slices(offsets):
                part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = scanner.split(part, local)
                hashes, example, back = np.unique(scanner.hashes(part, starts, ends), return_index=True, return_inverse=True)
                vectors = net.inputs(word_features(part, starts[example], ends[example], hashes, _FOLD)) if len(hashes) else np.zeros((SIZE, 0), np.float32)
                row, begin, size = windows_of(first)
                top = np.full(j - i, -np.inf)
                np.maximum.at(top, row, net.logits((vectors, back), begin, size))
                scores[i:j] = top
            scores = _sigmoid(net.p["a"][0] * scores + net.p["s"][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, out_col])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, `{out_col}` double")


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = 1500, seed: int = 11) -> DataFrame:
    """Documents with labels that may be learnt from: crc32 of the id as text, modulo 3, is not 1.

    Ids are chosen before texts are read: at most 2 * ``per_class`` * 2 of them, which is what is broadcast.
    """
    own = labels.where("doc_id is not null and toxic in (0, 1) and crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = smallest_hashes(own, "toxic", "doc_id", 2 * per_class, seed)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
