"""Line dedup with DataFrame and SQL functions only.

Documents are cut into lines; a line's key is the line without blanks at its ends, A-Z in lower case. Keys are hashed to 128
bits, the distinct documents of each key are counted, and the lines of keys that reach the threshold are dropped by their position.
What is left is put together in order.

Keys of many documents: pairs of key and document are counted in two steps, by pair and then by key, so a frequent key is spread.
Of the keys over the threshold at most ``HOT_KEYS`` can each have more than that part of all pairs; these are broadcast, the others
are joined, so no task holds the lines of a hot key. Texts go through one exchange at most, with the positions that they lose.

Defined results: a null or empty text is one empty line, kept, as keys of fewer than ``least_chars`` code points are never dropped; a
document is a pair of id and text, so repeated rows count once and share their fate, and null ids with different texts are different
documents; very long texts are cut whole; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with more than one in HOT_KEYS of the pairs counted is hot; so there are fewer than HOT_KEYS of them.
HOT_KEYS = 4096


def _hash128(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def _document(id_col: str, text_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), _hash128(F.col(text_col)).alias("h")).alias("doc")


def line_keys(docs: DataFrame, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, pos, key) of every line whose key is long enough; doc is struct(id, hash of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # lower() is quick and the same where all is ASCII
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    lines = docs.select(_document(id_col, text_col), F.posexplode(F.split(folded, "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= max(1, least_chars))
    return lines.select("doc", "pos", _hash128(F.col("line")).alias("key"))


def frequent_keys(lines: DataFrame, least_documents: int) -> DataFrame:
    """(key, n) of the keys found in at least so many documents."""
    return lines.select("key", "doc").distinct().groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least_documents)


def without_common_lines(docs: DataFrame, least_documents: int = 10, least_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: (id_col, kept, n_lines, n_dropped); kept is the text without common lines."""
    at = shared_dir(docs.sparkSession, "lines")
    lines = written(line_keys(docs, least_chars, id_col, text_col), f"{at}/keys")
    frequent = written(frequent_keys(lines, least_documents), f"{at}/frequent")
    pairs = frequent.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_KEYS > pairs
    hot, cold = F.broadcast(frequent.where(is_hot).select("key")), frequent.where(~is_hot).select("key")
    dropped = lines.join(hot, "key", "left_semi").unionByName(lines.join(hot, "key", "left_anti").join(cold, "key", "left_semi"))
    gone = written(dropped.groupBy("doc").agg(F.collect_set("pos").alias("gone")), f"{at}/gone").withColumnRenamed("doc", "where")
    # cut before the join: behind it the lines are a column, read by position in constant time
    rows = docs.select(F.col(id_col).alias("id"), _document(id_col, text_col), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    rows = rows.join(gone, rows["doc"] == gone["where"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i))), "\n")
    n_dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return rows.select(F.col("id").alias(id_col), kept.alias("kept"), F.size("lines").cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))
