"""A training-data pipeline over ``documents``: each stage works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, lshforest, mixing, tokens, toxicity
from tidemark.llm.files import shared_dir, written

#: SQL can express neither the trained network nor the token shards; tests/llm/test_pipeline.py compares every stage with brute force.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.7, by a network that is trained on the labelled ones among them.

    Null, empty and wordless texts have a score and so do very long ones, by their highest window; repeated rows have equal scores
    and share their fate; rows with a null id are scored and never learnt from; without labels of both kinds nothing is dropped; an
    empty table gives no rows; further columns stay, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train_model(toxicity.training_rows(docs, labels))
    name = _free(docs, "_toxicity")
    return toxicity.with_scores(docs, model, out_col=name).where(F.col(name) < 0.7).select(*docs.columns)


def _unit_keys(docs: DataFrame, name: str, folder: str) -> DataFrame:
    """``docs`` with a whole number for each pair of id and text: the id, or a hash below zero where an id is null or has several texts."""
    h = F.xxhash64("text")
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(h).alias("a"), F.max(h).alias("b")).where("a <> b")
    # written, so that Spark knows how small it is
    several = written(several.select(F.col("doc_id").alias("_several"), F.lit(True).alias("_is")), f"{folder}/several")
    rows = docs.join(several, docs["doc_id"] == several["_several"], "left")
    hashed = -1 - F.xxhash64(docs["doc_id"], docs["text"]).bitwiseAND(F.lit((1 << 62) - 1))
    key = F.when(docs["doc_id"].isNotNull() & F.col("_is").isNull(), docs["doc_id"].cast("long")).otherwise(hashed)
    return rows.select(*[docs[c] for c in docs.columns], key.alias(name))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 0.8): that with the smallest id.

    A document is a pair of id and text, so of rows that repeat one, one stays; rows with a null id, and ids with several texts, are
    documents of their own and lose to one with an id of its own only if they are near it. Null, empty and wordless texts are near nothing
    and stay, once for each id; very long texts count whole; an empty table gives no rows; further columns stay, whatever their names.
    """
    key, folder = _free(docs, "_unit"), shared_dir(spark, "verdicts")
    rows = _unit_keys(docs, key, folder)
    verdicts = lshforest.near_duplicates(rows, id_col=key, width=5, percent=80)
    units = verdicts.groupBy(F.col("component_id").alias("c"), F.col(key).alias("u")).agg(F.count("*").alias("n"))
    units = written(units, f"{folder}/units")
    # keys of ids come before hashes, smallest first
    kept = units.groupBy("c").agg(F.min(F.struct((F.col("u") < 0).alias("hashed"), "u"))["u"].alias("k"))
    judged = units.join(kept, "c").select("u", (F.col("u") == F.col("k")).alias("first"), "n")
    gone = written(judged.where("not first").select("u"), f"{folder}/gone")
    again = written(judged.where("first and n > 1").select("u"), f"{folder}/again")
    left = rows.join(gone, rows[key] == gone["u"], "left_anti")
    once = left.join(again, left[key] == again["u"], "left_anti")
    repeated = left.join(again, left[key] == again["u"], "left_semi").dropDuplicates([key])
    return once.unionByName(repeated).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window (ten words) of a benchmark item.

    Rows are judged by id and text, so repeated rows share their fate and a null id is judged like others; null, empty and wordless texts
    hold nothing and stay; very long texts count whole; items without words are nothing; empty tables drop nothing; further columns
    stay, whatever their names.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), "text")
    verdicts = decontam.contamination(keyed, benchmark, id_col="k")
    gone = verdicts.where("contaminated").select(F.col("k.doc_id").alias("_id"), F.col("k.h").alias("_h")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_h"]), "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in target weights: whole documents, each taken at most twice, dealt by shard in the shard's order.

    Texts without words (null, empty, blank) add nothing to a mix and are left out; a null source is one; null and repeated ids are rows of
    their own; very long texts are taken whole or not at all; an empty table gives no rows; further columns stay, whatever their names.
    """
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids in training order; one row for each sequence, with the ids of its documents.

    A null or empty text is its end mark alone; very long texts fill several sequences; repeated rows and null ids are documents of their
    own; further columns are ignored, whatever their names; an empty table gives no sequences.
    """
    index = tokens.materialise(docs)
    return tokens.read_back(index).select("slot", "shard", "record", "n_tokens", "tokens_read", "tokens_crc32", "doc_ids")


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("token output", write_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
