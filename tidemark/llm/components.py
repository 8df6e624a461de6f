"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import written


def _print_of(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, at: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of long): root is the smallest node reachable.

    Each round makes every node point at the smallest neighbour of its neighbourhood; rounds are
    logarithmic in the longest chain. Minima are taken with map-side combining, so a node with very many
    links is no single task's work. Both steps of a round turn one link into one link, so tables never grow;
    each round's table is written to the folder ``at``. Null ends and self links are ignored; an empty table
    gives an empty result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b").distinct()
    edges = written(edges, f"{at}/0")
    seen = _print_of(edges)
    for k in range(1, most_rounds + 1):
        if not seen[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        least = F.col("v") == F.col("m")
        small = large.join(low, "u").select(F.when(least, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small, f"{at}/{k}")
        now = _print_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    return written(edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))).alias("e")).select("e.*").distinct(), f"{at}/roots")


def joined_components(roots: DataFrame, links: DataFrame, at: str) -> DataFrame:
    """``roots`` as they are after further links: only the groups that these join are worked on."""
    known = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    for end in ("a", "b"):
        links = links.join(known, links[end] == known["_n"], "left").withColumn(end, F.coalesce("_r", end)).drop("_n", "_r")
    moved = connected_components(links, at)
    kept = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return written(kept.union(moved.join(roots, "node", "left_anti").select("node", "root")), f"{at}/joined")
