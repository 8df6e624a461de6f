"""A Merkle manifest of a dataset: a nested-struct rollup of ranked rows, and a proof for every row.

Each row is a leaf, the SHA-256 of its fields. Inside a group (a language) leaves are ranked by id; the rank's base-8 digits
name a leaf's run at every level. Ranks are cut into blocks of 8 ** ``DIGITS`` leaves: inside a block the digit columns are
grouped away one after another, each grouping nesting its child structs in the parent's, after one exchange by block. The
blocks' digests are the leaves of the next round, until a group is one node, its subroot; the subroots are one more tree,
whose top is the root. Going down again, a block meets the path above it by grouping on the block's number; successive explodes
of its nested structs then give every child its siblings. Nothing is joined to emit proofs, and no task holds more than a block.

Ranks come from a range sort: a row's place in its partition plus the rows before it, so a group may hold any share of all rows.

Defined results: null fields are ``-``; a null id ranks first, a null group is a group, first; rows of equal id rank by their
leaf, and repeated rows are leaves of their own; texts count whole, whatever their length; other columns are ignored, whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written

#: Consecutive nodes under one parent, and the levels of a block: blocks have FANOUT ** DIGITS leaves.
FANOUT, DIGITS = 8, 3
BLOCK = FANOUT**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 (lowercase hex) of the fields: ``-`` for a null, else the UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return _hash(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def ranked(rows: DataFrame, at: str) -> DataFrame:
    """(g, key, digest, info) with the rank inside g by key, digest, from 0, and the count n of g."""
    order = ["g", "key", "digest", "seq"]
    # seq parts rows that are alike, so that a row repeated without end is dealt to many tasks
    placed = rows.withColumn("seq", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.select("g", "digest", "info", F.monotonically_increasing_id().alias("place")), f"{at}/placed")
    part = F.shiftright("place", 33).alias("part")
    runs = placed.groupBy("g", part).agg(F.count("*").alias("c"), F.min("place").alias("first"))
    whole = Window.partitionBy("g")
    before = F.sum("c").over(whole.orderBy("part")) - F.col("c") - F.col("first")
    # a row for each group of each partition; written, so that Spark knows its size
    runs = written(runs.select(F.col("g").alias("g2"), "part", F.sum("c").over(whole).alias("n"), before.alias("shift")), f"{at}/runs")
    placed = placed.withColumn("p", part)
    met = placed.join(runs, placed["g"].eqNullSafe(runs["g2"]) & (placed["p"] == runs["part"]))
    return met.select("g", "n", (F.col("place") + F.col("shift")).alias("rank"), "digest", "info")


def _blocks(nodes: DataFrame) -> DataFrame:
    """(g, n, block, node) from (g, n, rank, digest, info): each block's nodes nested in its top node, struct(digest, kids)."""
    digits = [(F.floor(F.col("rank") / FANOUT**k) % FANOUT).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    block = F.floor(F.col("rank") / BLOCK).cast("long").alias("block")
    rows = nodes.select("g", "n", block, *digits, F.struct("digest", "info").alias("node")).repartition("g", "block")
    for k in range(DIGITS):
        keys = ["g", "n", "block", *[f"d{j}" for j in range(k + 1, DIGITS)]]
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(f"d{k}", "node"))).alias("x"))
        kids = F.transform("x", lambda x: x["node"])
        joined = F.array_join(F.transform("x", lambda x: x["node"]["digest"]), "")
        # a level at which the group is one node already adds nothing
        digest = F.when(F.col("n") > FANOUT**k, _hash(joined)).otherwise(F.get("x", F.lit(0))["node"]["digest"])
        rows = rows.select(*keys, F.struct(digest.alias("digest"), kids.alias("kids")).alias("node"))
    return rows


def _grown(leaves: DataFrame, at: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks of (g, key, digest, info), lowest first, and (g, digest) of each group's top."""
    nodes = ranked(leaves, at)
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    while not rounds or most > 1:
        rounds.append(written(_blocks(nodes), f"{at}/blocks{len(rounds)}"))
        n = F.ceil(F.col("n") / BLOCK).cast("long").alias("n")
        nodes = rounds[-1].select("g", n, F.col("block").alias("rank"), F.col("node.digest").alias("digest"), F.col("block").alias("info"))
        most = -(-most // BLOCK)
    return rounds, nodes.select("g", "digest")


def _unfolded(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(g, n, path, told, digest, info) of a round's leaves: the path to the root, nearest first, from (g, block, path, told) above."""
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    one = blocks.select("g", "block", "n", "node", none(above, "path"), none(above, "told"))
    two = above.select("g", "block", none(blocks, "n"), none(blocks, "node"), "path", "told")
    value = lambda c: F.first(c, ignorenulls=True).alias(c)
    rows = one.unionByName(two).groupBy("g", "block").agg(*map(value, ("n", "node", "path", "told")))
    for k in reversed(range(DIGITS)):
        kids = rows.select("g", "n", "path", "told", F.transform("node.kids", lambda x: x["digest"]).alias("run"), F.posexplode("node.kids").alias("i", "node"))
        before = F.array_join(F.slice("run", F.lit(1), F.col("i")), "")
        after = F.array_join(F.slice("run", F.col("i") + 2, F.lit(FANOUT)), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        path = F.when(F.col("n") > FANOUT**k, F.concat(step, "path")).otherwise(F.col("path"))
        rows = kids.select("g", "n", path.alias("path"), "told", "node")
    return rows.select("g", "n", "path", "told", "node.digest", "node.info")


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, path, told, digest, info) of every leaf, from (g, path, told) of each group's top."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(rounds))):
        rows = _unfolded(rounds[k], above)
        above = rows.select("g", F.col("info").alias("block"), "path", "told") if k else rows
    return above


def proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", presented: dict[str, Column] | None = None) -> DataFrame:
    """One row for each row of ``docs``: (id_col, leaf, subroot, root, path, folded_root, verified).

    path lists (before, after), the joined digests of the siblings on both sides, from the leaf's run to the root.
    ``presented`` replaces fields in the record that is held against the manifest: folded_root is what that record and the
    path give, and verified says whether it is the root.
    """
    at = shared_dir(docs.sparkSession, "merkle")
    named = {c: F.col(f"`{c}`") for c in {*fields, group_col, id_col}}
    leaf, told = leaf_digest(*[named[c] for c in fields]), leaf_digest(*[(named | (presented or {}))[c] for c in fields])
    leaves = docs.select(named[group_col].alias("g"), named[id_col].alias("key"), leaf.alias("digest"), F.when(told != leaf, told).alias("other"))
    leaves = written(leaves, f"{at}/leaves").select("g", "key", "digest", F.struct("key", "other").alias("info"))
    rounds, subroots = _grown(leaves, f"{at}/rows")
    group = F.col("g")
    upper, roots = _grown(subroots.select(F.lit(0).alias("g"), group.alias("key"), "digest", group.alias("info")), f"{at}/groups")
    no_path = F.lit([]).cast("array<struct<before:string,after:string>>").alias("path")
    tops = _down(upper, roots.select("g", no_path, F.struct(F.col("digest").alias("root"), F.lit("").alias("subroot")).alias("told")))
    tops = tops.select(F.col("info").alias("g"), "path", F.struct("told.root", F.col("digest").alias("subroot")).alias("told"))
    rows = _down(rounds, tops)
    folded = F.aggregate("path", F.coalesce("info.other", "digest"), lambda held, x: _hash(F.concat(x["before"], held, x["after"])))
    rows = rows.select(F.col("info.key").alias(id_col), F.col("digest").alias("leaf"), "told.subroot", "told.root", "path", folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return _hash(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""))
