"""Benchmark decontamination by a prefix-filtered set join.

Each benchmark item is cut into windows of ``window`` consecutive words (a shorter item is one window), and each
window into word shingles. A document contains a window only if it contains all of its shingles, so one
shingle is a necessary prefix; shingles are ordered by how rare they are in the whole corpus and the rarest one is
joined. A hit is a candidate only if the window, placed where the shingle stands, lies inside the document (the
positional and length bounds); it counts if all words of the window then are equal.

The corpus is read twice: to count the benchmark's shingles, and to find the prefix shingles. Both passes
test shingles against a bitmap of bounded size, so neither the benchmark nor the hits go through the driver.

Defined results: a null text has no words; an item without words has no window; an item with a null id marks words
as hit but is in no list; repeated items count once by id; repeated document rows each get a row, ids may be null
or repeated (hits are kept by id and text); very long texts count whole, a slice of them in memory at a time; of shingles that are equally rare
the one with the smallest hash is joined; other columns are ignored; empty tables give n_hit = 0 or no rows. Words are equal if their 64-bit hashes are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written
from tidemark.llm.textscan import _SHINGLE, NON_ALNUM, WordScanner, binary_array, column_bytes, mix, rows_of, slices

#: Words in the shingles that are joined; shorter windows use their own length.
SHINGLE = 3
#: Least and most bits of the bitmap that says which shingles are wanted; beyond it more shingles pass, none is lost.
BITS = (16, 26)


def _tokens(words: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of a row, and the index of the first word of each."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words[:n] * _SHINGLE[8 + width]
    for i in range(1, width):
        h += words[i : n + i] * _SHINGLE[16 + i]
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    return mix(h[at]), at


def _windows(window: int):
    """A mapper from (item_id) and text to (item_id, win, len, words, off, token): each shingle of each window."""

    def run(batches):
        scanner = WordScanner(NON_ALNUM)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in slices(offsets, 1 << 17):
                part = data[offsets[i] : offsets[j]]
                starts, ends, first = scanner.split(part, offsets[i : j + 1] - offsets[i])
                words = scanner.hashes(part, starts, ends)
                out = []
                for r in range(j - i):
                    w = words[first[r] : first[r + 1]]
                    size = min(window, len(w))
                    width = min(SHINGLE, size)
                    for k in range(len(w) - size + 1) if size else ():
                        one = np.ascontiguousarray(w[k : k + size])
                        win = int(mix((one * np.arange(3, 2 * size + 3, 2, dtype=np.uint64) * _SHINGLE[0]).sum(dtype=np.uint64, keepdims=True) + np.uint64(size)).view(np.int64)[0])
                        tokens, at = _tokens(one, np.zeros(size, np.int64), width)
                        out += [(ids[i + r], win, size, one.tobytes(), width, int(o), int(t)) for o, t in zip(at, tokens.view(np.int64))]
                if out:
                    kinds = (batch.column(0).type, pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=["item_id", "win", "len", "words", "width", "off", "token"])

    return run


def _bitmap(tokens: DataFrame) -> np.ndarray:
    """A bitmap of the column ``token``, of bounded size, folded to words by Spark before it is fetched."""
    n = tokens.distinct().count()
    bits = int(np.clip(np.ceil(np.log2(max(1, 16 * n))), *BITS))
    place = F.shiftrightunsigned("token", 64 - bits)
    words = tokens.select(place.alias("p")).groupBy((F.col("p") / 64).cast("int").alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("w")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("i").to_numpy()] = words.column("w").to_numpy()
    return out.view(np.uint8)


def _scan(bits: np.ndarray, widths: list[int]):
    """The words and wanted tokens of each slice of a batch."""
    shift = np.uint64(64 - int(np.log2(8 * len(bits))))

    def run(scanner, data, offsets):
        for i, j in slices(offsets):
            part = data[offsets[i] : offsets[j]]
            starts, ends, first = scanner.split(part, offsets[i : j + 1] - offsets[i])
            words = scanner.hashes(part, starts, ends)
            row = rows_of(first)
            token, at = [], []
            for width in widths:
                t, a = _tokens(words, row, width)
                place = (t >> shift).astype(np.int64)
                keep = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                token.append(t[keep])
                at.append(a[keep])
            yield i, j, first, words, row, np.concatenate([*token, np.zeros(0, np.uint64)]), np.concatenate([*at, np.zeros(0, np.int64)])

    return run


def _count(bits, widths):
    scan = _scan(bits, widths)

    def run(batches):
        scanner = WordScanner(NON_ALNUM)
        for batch in batches:
            got = [t for *_, t, _ in scan(scanner, *column_bytes(batch.column(0)))]
            token, n = np.unique(np.concatenate([*got, np.zeros(0, np.uint64)]), return_counts=True)
            if len(token):
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"])

    return run


def _find(bits, widths, window):
    """A mapper from (doc_id, text) to a row for each document (pos null), and one for each wanted token.

    A token's row has the hashes of the words around it: ``near`` starts at word ``near_at``.
    """
    scan = _scan(bits, widths)

    def run(batches):
        scanner = WordScanner(NON_ALNUM)
        for batch in batches:
            for i, j, first, words, row, token, at in scan(scanner, *column_bytes(batch.column(1))):
                counts = np.diff(first)
                ids = batch.column(0)[i:j]
                key = np.zeros(j - i, np.uint64)
                full = np.flatnonzero(counts)
                if len(words):
                    inner = np.arange(len(words)) - first[row]
                    key[full] = np.add.reduceat(mix(words + inner.astype(np.uint64) * _SHINGLE[1]), first[full])
                key = key.view(np.int64)
                none = pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(key), pa.array(counts), none, none, pa.nulls(j - i, pa.int64()), pa.nulls(j - i, pa.binary())], names=["id", "key", "n_words", "pos", "token", "near_at", "near"])
                for a in range(0, len(at), 20_000):
                    p = at[a : a + 20_000]
                    r = row[p]
                    span = p[:, None] + np.arange(1 - window, window)
                    near = np.where((span >= first[r][:, None]) & (span < first[r + 1][:, None]), words[np.clip(span, 0, len(words) - 1)], 0)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(r)), pa.array(key[r]), pa.array(counts[r]), pa.array(p - first[r]), pa.array(token[a : a + 20_000].view(np.int64)), pa.array(p - first[r] + 1 - window), binary_array(near)], names=["id", "key", "n_words", "pos", "token", "near_at", "near"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (id_col, n_words, n_hit, n_items, items_sha256, contaminated)."""
    spark = docs.sparkSession
    at = shared_dir(spark, "decontam")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    parts = written(items.mapInArrow(_windows(window), "item_id string, win long, len int, words binary, width int, off int, token long"), f"{at}/windows")
    widths = sorted(r[0] for r in parts.select("width").distinct().collect())  # 1 to SHINGLE
    counts = docs.select("text").mapInArrow(_count(_bitmap(parts.select("token")), widths), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rare = parts.select("win", "len", "words", "off", "token").distinct().join(counts, "token", "left")
    prefix = rare.groupBy("win", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "off")).alias("x"), F.first("words").alias("words"))
    prefix = written(prefix.select("win", "len", "words", "x.token", "x.off"), f"{at}/prefix")
    schema = f"id {docs.schema['id'].dataType.simpleString()}, key long, n_words long, pos long, token long, near_at long, near binary"
    found = written(docs.mapInArrow(_find(_bitmap(prefix.select("token")), widths, window), schema), f"{at}/found")
    begin = F.col("pos") - F.col("off")
    fits = (begin >= 0) & (begin + F.col("len") <= F.col("n_words"))
    equal = F.expr("substring(near, cast((pos - off - near_at) * 8 + 1 as int), len * 8) = words")
    hits = found.where("pos is not null").join(prefix, "token").where(fits & equal).select("id", "key", begin.alias("begin"), (begin + F.col("len")).alias("stop"), "win")
    hits = written(hits.distinct(), f"{at}/hits")
    before = F.max("stop").over(Window.partitionBy("id", "key").orderBy("begin", "stop", "win").rowsBetween(Window.unboundedPreceding, -1))
    words = hits.withColumn("new", F.greatest(F.lit(0), F.col("stop") - F.greatest("begin", F.coalesce(before, F.lit(0))))).groupBy("id", "key").agg(F.sum("new").alias("n_hit"))
    named = hits.select("id", "key", "win").distinct().join(parts.where("item_id is not null").select("win", "item_id").distinct(), "win").groupBy("id", "key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    rows = found.where("pos is null").select("id", "key", "n_words")
    for extra in (words, named):
        extra = extra.withColumnsRenamed({"id": "id2", "key": "key2"})
        rows = rows.join(extra, rows["id"].eqNullSafe(extra["id2"]) & (rows["key"] == extra["key2"]), "left").drop("id2", "key2")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
