"""Ranked lexical search by the Best Position Algorithm.

The corpus is read once for a forward index: for each document its length and its counts of the query terms. Spark sums the corpus
statistics over all of it. The index is then gone through in shards of bounded size, each inside one task: a shard's
postings are sorted by impact within each term (its impact lists), and a document's row of the forward index gives direct access
to its impact and position in every list. For an item all its lists are read downwards together; each document
that comes up is scored at once by direct access, and its positions in all lists are marked as seen. A list's best position is the end of
its contiguous seen positions, which direct accesses push further down than sorted reading alone. The sum of the impacts just below the
best positions bounds the score of every document not yet seen; reading stops as soon as that is strictly below the kth score, so ties
are whole. The shards' best are merged by a window; Spark keeps k rows of an item in each task before it exchanges them.

Items are a stated query set, gone through in blocks of about ``BLOCK_TERMS`` terms; each block reads the corpus once. Terms are equal if
their 64-bit hashes are. Impacts and scores are 64-bit integers.

Defined results: a null or wordless text is no document of the statistics and in no result; an item without terms has no rows; items that
repeat an id and text count once, items of equal id and different texts have their own ranks; rows that repeat a document are documents of
their own; equal scores rank by id, a null id last; very long texts count whole; other columns are ignored, whatever their
names; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written
from tidemark.llm.textscan import NON_ALNUM, WordScanner, column_bytes, ragged_array, rows_of, slices

#: Terms of the items that are searched at a time, about; a longer item is a block of its own.
BLOCK_TERMS = 1 << 18
#: A shard ends with the document that reaches one of these.
SHARD_DOCUMENTS, SHARD_POSTINGS = 1 << 14, 1 << 21
#: Positions of each list that are read in the first step, and the most in a later one; a step is twice as long as that before it.
FIRST_STEP, MOST_STEP = 8, 1024


def _rows(batch_column, kind) -> list[np.ndarray]:
    """The rows of a binary column as arrays."""
    data, offsets = column_bytes(batch_column)
    return [data[a:b].view(kind) for a, b in zip(offsets[:-1], offsets[1:])]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (item_id, text) to (item_id, terms, times): the distinct terms of each item, and how often it has each."""
    scanner = WordScanner(NON_ALNUM)
    for batch in batches:
        data, offsets = column_bytes(batch.column(1))
        for i, j in slices(offsets):
            part = data[offsets[i] : offsets[j]]
            starts, ends, first = scanner.split(part, offsets[i : j + 1] - offsets[i])
            words = scanner.hashes(part, starts, ends)
            found = [np.unique(words[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
            begin = np.concatenate([[0], np.cumsum([len(t) for t, _ in found])])
            terms, times = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(np.diff(begin)), ragged_array(terms, begin), ragged_array(times.astype(np.int64), begin)], names=["item_id", "n", "terms", "times"])


def _forward(vocabulary: np.ndarray):
    """A mapper from (id, text) to (id, n, terms, tf) of each document with a term; terms are places in the sorted vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = WordScanner(NON_ALNUM)
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                part = data[offsets[i] : offsets[j]]
                starts, ends, first = scanner.split(part, offsets[i : j + 1] - offsets[i])
                words, counts = scanner.hashes(part, starts, ends), np.diff(first)
                place = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                known = vocabulary[place] == words
                key, tf = np.unique(rows_of(first)[known] * len(vocabulary) + place[known], return_counts=True)
                begin = np.searchsorted(key, np.arange(j - i + 1) * len(vocabulary))
                rows = [batch.column(0)[i:j], pa.array(counts), ragged_array((key % len(vocabulary)).astype(np.int32), begin), ragged_array(tf.astype(np.int32), begin)]
                yield pa.RecordBatch.from_arrays(rows, names=["id", "n", "terms", "tf"]).filter(pa.array(counts > 0))

    return run


def _document_counts(size: int):
    """A mapper from (terms) to (term, df) of a task's documents."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(column_bytes(batch.column(0))[0].view(np.int32), minlength=size)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df[term])], names=["term", "df"])

    return run


def term_weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges that start at ``begin`` and have ``size`` places."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Shard:
    """The impact lists of some documents, and their forward index."""

    def __init__(self, ids: pa.Array, n: np.ndarray, begin: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, documents: int, words: int):
        self.begin, self.term = begin, term
        self.order = np.empty(len(n), np.int64)  # by id, nulls last
        self.order[pc.sort_indices(ids).to_numpy()] = np.arange(len(n))
        self.ids = ids
        m = 25 + (75 * n * documents) // words
        doc = np.repeat(np.arange(len(n)), np.diff(begin))
        tf = tf.astype(np.int64)
        self.impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        by = np.lexsort((-self.impact, term))
        self.list_doc, self.list_impact = doc[by], self.impact[by]
        self.list_begin = np.searchsorted(term[by], np.arange(len(weights) + 1))
        self.position = np.empty(len(term), np.int64)
        self.position[by] = np.arange(len(term)) - self.list_begin[term[by]]
        self.slot = np.full(len(weights), -1, np.int64)
        self.read = 0

    def best(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents of the shard, with their scores above 0, best first."""
        begin, size = self.list_begin[terms], np.diff(self.list_begin)[terms]
        used = size > 0
        terms, times, begin, size = terms[used], times[used], begin[used], size[used]
        place = np.concatenate([[0], np.cumsum(size + 1)])  # a place is never seen behind each list
        seen, met = np.zeros(place[-1], bool), np.zeros(len(self.begin) - 1, bool)
        at, depth, step = np.zeros(len(terms), np.int64), 0, FIRST_STEP
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.slot[terms] = np.arange(len(terms))
        while len(terms):
            # sorted access, all lists together
            here = np.clip(size - depth, 0, step)
            new = np.unique(self.list_doc[_spans(begin + depth, here)])
            new = new[~met[new]]
            met[new] = True
            self.read += len(new)
            depth, step = depth + step, min(2 * step, MOST_STEP)
            # direct access to every list of the documents that came up
            length = self.begin[new + 1] - self.begin[new]
            rows, owner = _spans(self.begin[new], length), np.repeat(np.arange(len(new)), length)
            of = self.slot[self.term[rows]]
            rows, owner, of = rows[of >= 0], owner[of >= 0], of[of >= 0]
            seen[place[of] + self.position[rows]] = True
            score = np.zeros(len(new), np.int64)
            np.add.at(score, owner, times[of] * self.impact[rows])
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, score])
            if len(docs) > k:
                top = np.lexsort((self.order[docs], -scores))[:k]
                docs, scores = docs[top], scores[top]
            # best positions: the first one not seen, in each list
            for i in np.flatnonzero(at < size):
                at[i] += np.argmin(seen[place[i] + at[i] : place[i + 1]])
            below = at < size
            bound = int((times[below] * self.list_impact[begin[below] + at[below]]).sum())
            if bound == 0 or len(docs) >= k and bound < scores.min():
                break
        self.slot[terms] = -1
        top = np.lexsort((self.order[docs], -scores))
        top = top[scores[top] > 0]
        return docs[top], scores[top]


def _shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, words: int) -> Iterator[Shard]:
    held: list[tuple] = []

    def shard() -> Shard:
        n, sizes, term, tf = (np.concatenate([h[k] for h in held]) for k in range(1, 5))
        return Shard(pa.concat_arrays([h[0] for h in held]), n, np.concatenate([[0], np.cumsum(sizes)]), term, tf, weights, documents, words)

    for batch in batches:
        term, tf = (column_bytes(batch.column(k))[0].view(np.int32) for k in (2, 3))
        begin, n = column_bytes(batch.column(2))[1] // 4, batch.column(1).to_numpy()
        i = 0
        while i < len(n):
            docs, postings = sum(len(h[1]) for h in held), sum(len(h[3]) for h in held)
            full = int(np.searchsorted(begin, begin[i] + SHARD_POSTINGS - postings))
            j = max(i + 1, min(len(n), i + SHARD_DOCUMENTS - docs, full))
            held.append((batch.column(0)[i:j], n[i:j], np.diff(begin[i : j + 1]), term[begin[i] : begin[j]], tf[begin[i] : begin[j]]))
            if docs + j - i >= SHARD_DOCUMENTS or postings + begin[j] - begin[i] >= SHARD_POSTINGS:
                yield shard()
                held = []
            i = j
    if held:
        yield shard()


def _search(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, words: int, k: int):
    """A mapper from the forward index to (item, doc_id, score): for each shard and item the k best documents."""

    def run(batches):
        for shard in _shards(batches, weights, documents, words):
            found = [shard.best(terms, times, k) for terms, times in items]
            item = np.repeat(np.arange(len(found)), [len(d) for d, _ in found])
            docs, scores = (np.concatenate([x[c] for x in found]) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(item), shard.ids.take(pa.array(docs)), pa.array(scores)], names=["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item: (item_col, rank, id_col, score), rank from 1."""
    spark = docs.sparkSession
    at = shared_dir(spark, "ranked")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = docs.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    asked = written(asked.mapInArrow(_items, f"item_id {kinds[1]}, n long, terms binary, times binary").where("n > 0"), f"{at}/items")
    blocks = max(1, -(-(asked.agg(F.sum("n")).first()[0] or 0) // BLOCK_TERMS))
    out = None
    for b in range(blocks):
        # bounded: about BLOCK_TERMS terms, and what one item has beyond
        block = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b).orderBy("item_id", "terms").toArrow().combine_chunks()
        terms, times = _rows(block.column("terms"), np.uint64), _rows(block.column("times"), np.int64)
        vocabulary = np.unique(np.concatenate([*terms, np.zeros(0, np.uint64)]))
        if not len(vocabulary):
            continue
        index = written(docs.mapInArrow(_forward(vocabulary), f"id {kinds[0]}, n long, terms binary, tf binary"), f"{at}/index{b}")
        documents, words = (int(x or 0) for x in index.agg(F.count("*"), F.sum("n")).first())
        counts = index.select("terms").mapInArrow(_document_counts(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
        weights = term_weights(df, documents)
        queries = [(np.searchsorted(vocabulary, t), c) for t, c in zip(terms, times)]
        queries = [(t[weights[t] > 0], c[weights[t] > 0]) for t, c in queries]
        found = index.mapInArrow(_search(queries, weights, documents, words, k), f"item long, doc_id {kinds[0]}, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k)
        named = _named(spark, block, kinds[1])
        best = best.join(named, "item").select(F.col("item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc_id").alias(id_col), "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], f"`{item_col}` {kinds[1]}, rank int, `{id_col}` {kinds[0]}, score long")
    return out


def _named(spark, block: pa.Table, kind: str) -> DataFrame:
    """(item, item_id) of a block's items."""
    numbers = pa.table({"item": pa.array(np.arange(len(block))), "item_id": block.column("item_id")})
    return spark.createDataFrame(numbers).select("item", F.col("item_id").cast(kind).alias("item_id"))
