"""Mixing sources to target weights, with DataFrame and SQL functions only.

Every source's documents are laid on a line of words, once for each time that the source may be read, in an order of its
own. The line up to the source's target is cut into blocks of equal width; a document is whole in the block in which it
begins. A splitting tree over the output shards divides the sources' block quotas: at each node half of the node's blocks,
drawn without replacement, go left, so the split is multivariate hypergeometric and the quotas stay exact. A source's blocks,
permuted again, are dealt to the shards by those counts, and each shard is read in an order of its own. ``mixed_rows``
gives the documents dealt by shard and in that order, so a writer leaves a file for each shard.

The document that reaches over the target is taken whole, and one document of the last reading is left out if that
brings the source nearer to its target.

Orders come from MD5 of id and text, so reruns agree on any cluster. The documents are read once for sizes and hashes; what
follows works on that small table. Running sums are taken inside buckets of a source and added up over buckets: no task
holds a whole source, nor all sources: their ranks and sums are taken inside range partitions and added up over those. The
tree holds a row for each block; there are at most ``blocks`` << MOST_LEVELS and one for each source, and a node of many
blocks is split by counts of the draws' first digits, so that only the blocks of one beginning are sorted together.

Defined results: a null or blank text has size 0 and is never taken; a null source is a source, sorted last; null and
repeated ids are rows of their own, repeated rows too; very long texts are taken whole like others; other columns are
ignored by ``mixed_documents`` and kept by ``mixed_rows``, whatever their names (but for names that begin with _mix); an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import shared_dir, written

WORD = r"[^\x20\x09-\x0D]+"
#: A mix of at most WORDS_ONE words is one shard; four times as many words make twice as many shards, up to 2 ** MOST_LEVELS.
WORDS_ONE, MOST_LEVELS = 1 << 16, 14
#: Rows of a bucket of running sums, about, and the most hex digits that name a bucket.
BUCKET_ROWS, MOST_DIGITS = 256, 4
#: Blocks of a node that are sorted in one task, about.
NODE_ROWS = 1 << 16


def _in_order(rows: DataFrame, order: list[Column], sums: tuple[str, ...], at: str) -> DataFrame:
    """Adds rank, the place in ``order`` from 1, and for each column c of ``sums`` c_before, its sum over the rows before."""
    place = F.monotonically_increasing_id()
    rows = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), at)
    rows = rows.withColumn("part", F.shiftright("place", 33))
    parts = rows.groupBy("part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_{c}") for c in sums])
    # a row for each range partition
    earlier = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("part", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in ("n", *sums)])
    inside = Window.partitionBy("part").orderBy("place")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"rank": F.row_number().over(inside), **{f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums}}).join(shift, "part")
    rows = rows.withColumns({"rank": F.col("rank") + F.col("_n"), **{f"{c}_before": F.col(f"{c}_before") + F.col(f"_{c}") for c in sums}})
    return rows.drop("part", "place", *[f"_{c}" for c in ("n", *sums)])


def target_words(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_percent: int = 150, repeat: int = 2) -> DataFrame:
    """Targets of sources (columns key, source, z): adds w and target.

    Sources by code point, null last, take the weights in turn; targets share ``share_percent`` of all words and
    stop at ``repeat`` times a source's own, what is over being shared again by weight. A task holds a range of the sources.
    """
    at = shared_dir(sizes.sparkSession, "targets")
    rows = _in_order(sizes, [F.asc_nulls_last("source")], (), f"{at}/named").withColumnRenamed("rank", "turn")
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    rows = _in_order(rows.withColumn("w", w.cast("long")).drop("turn"), [F.col("z") / F.col("w"), F.asc_nulls_last("source")], ("z", "w"), f"{at}/ranked")
    words, weight = (x or 0 for x in rows.agg(F.sum("z"), F.sum("w")).first())
    # before and every are in words and in hundredths of words: whole numbers up to the last division
    every, before, rest = F.lit(words * share_percent).cast("long"), F.col("z_before") * repeat, F.lit(weight).cast("long") - F.col("w_before")
    free = (every - before * 100) * F.col("w") <= F.col("z") * repeat * 100 * rest
    turn = rows.where(free).agg(F.min(F.struct("rank", before.alias("before"), rest.alias("rest"))).alias("x")).first().x
    capped = (F.col("z") * repeat).cast("double")
    if turn is None:
        return rows.select("key", "source", "z", "w", capped.alias("target"))
    level = F.lit(float(words * share_percent - turn.before * 100)) / 100 * F.col("w") / turn.rest
    return rows.select("key", "source", "z", "w", F.when(F.col("rank") < turn.rank, capped).otherwise(level).alias("target"))


def _md5(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts]).cast("binary"))


def _named(c: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def _drawn_left(blocks: DataFrame, digits: int) -> DataFrame:
    """``blocks`` (node, key, i, draw) with left: the half of each node's blocks with the smallest draws.

    With digits, the blocks are counted by the first digits of their draw, and ranked among those that begin alike.
    """
    order = ("draw", "key", "i")
    half = lambda n: F.floor((n + 1) / 2)
    if not digits:
        rank = F.row_number().over(Window.partitionBy("node").orderBy(*order))
        return blocks.withColumn("left", rank <= half(F.count("*").over(Window.partitionBy("node"))))
    blocks = blocks.withColumn("b", F.substring("draw", 1, digits))
    counts = blocks.groupBy("node", "b").agg(F.count("*").alias("c"))
    whole = Window.partitionBy("node")
    counts = counts.select("node", "b", (F.sum("c").over(whole.orderBy("b")) - F.col("c")).alias("start"), F.sum("c").over(whole).alias("n"))
    rank = F.row_number().over(Window.partitionBy("node", "b").orderBy(*order))
    return blocks.withColumn("rank", rank).join(counts, ["node", "b"]).withColumn("left", F.col("start") + F.col("rank") <= half(F.col("n")))


def split_tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """Shares of 2 ** ``levels`` shards in exact quotas (columns key, n): rows (shard, key, n) with n > 0.

    A node's left half are the blocks with the smallest hashes of (seed, level, node, key, number).
    """
    nodes = quotas.where("n > 0").select(F.lit(0).cast("long").alias("node"), "key", "n")
    most = nodes.agg(F.sum("n")).first()[0] or 0
    for level in range(levels):
        digits = next(k for k in range(MOST_DIGITS + 1) if k == MOST_DIGITS or NODE_ROWS * 16**k >= most >> level)
        draw = _md5(seed, "split", level, F.col("node"), F.col("key"), F.col("i"))
        blocks = nodes.select("node", "key", F.explode(F.expr("sequence(1L, n)")).alias("i")).withColumn("draw", draw)
        halves = _drawn_left(blocks, digits).groupBy("node", "key").agg(F.count_if("left").alias("a"), F.count_if(~F.col("left")).alias("b"))
        both = F.array(*[F.struct((F.col("node") * 2 + k).alias("node"), "key", F.col(c).alias("n")) for k, c in enumerate("ab")])
        nodes = halves.select(F.explode(both).alias("x")).select("x.*").where("n > 0")
    return nodes.withColumnRenamed("node", "shard")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_percent: int = 150, repeat: int = 2, blocks: int = 64, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, int]:
    """(documents, drawn, shards) of a mix into ``shards`` shards of about ``blocks`` blocks each.

    documents: one row for each row of ``docs``: (id, source, key, size, th, copy, source_size, target); th is the text's
    hash and copy numbers the rows that are alike in id, source and text. drawn: a row for each time that a document is
    taken: (key, id, th, copy, size, epoch, block, shard, order_key); a shard is read by order_key.
    """
    at = shared_dir(docs.sparkSession, "mix")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("th"))
    alike = rows.groupBy("id", "source", "size", "th").agg(F.count("*").alias("m"))
    rows = written(alike.select("id", "source", _named(F.col("source")).alias("key"), "size", "th", F.explode(F.expr("sequence(1L, m)")).alias("copy")), f"{at}/rows")
    sources = target_words(rows.groupBy("key", "source").agg(F.sum("size").alias("z")), weights, share_percent, repeat)
    sources = written(sources.withColumn("t", F.least(F.round("target").cast("long"), F.col("z") * repeat)), f"{at}/sources")
    n, total = rows.count(), sources.agg(F.sum("t")).first()[0] or 0
    digits = next((k for k in range(1, MOST_DIGITS) if BUCKET_ROWS * 16**k >= n), MOST_DIGITS)
    levels = next((k for k in range(MOST_LEVELS) if WORDS_ONE * 4**k >= total), MOST_LEVELS)
    width = max(1, -(-total // (blocks << levels)))

    # a row for each reading of a document, with its hash and the place of its first word on the source's line
    known = sources.where("t > 0").select("key", "z", "t")
    items = rows.where("size > 0").select("key", "id", "th", "copy", "size", F.explode(F.array(*map(F.lit, range(repeat)))).alias("epoch"))
    items = items.withColumn("h", _md5(seed, F.col("epoch"), F.coalesce(F.col("id").cast("string"), F.lit("~")), F.col("th"))).withColumn("b", F.substring("h", 1, digits))
    sums = items.groupBy("key", "epoch", "b").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("start", F.sum("words").over(Window.partitionBy("key", "epoch").orderBy("b")) - F.col("words")).drop("words")
    inside = Window.partitionBy("key", "epoch", "b").orderBy("h", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    items = items.withColumn("upto", F.sum("size").over(inside)).join(sums, ["key", "epoch", "b"]).join(known, "key")
    items = items.withColumn("from", F.col("start") + F.col("upto") - F.col("size") + F.col("epoch") * F.col("z")).where("from < t")
    items = written(items.select("key", "id", "th", "copy", "size", "epoch", "h", "from", "t"), f"{at}/items")

    # over: words beyond the target; the document of the last reading whose size is nearest to that goes, if it helps
    ends = items.groupBy("key").agg((F.max(F.col("from") + F.col("size")) - F.first("t")).alias("over"), F.max("epoch").alias("epoch"))
    far = F.abs(F.col("size") - F.col("over"))
    gone = items.join(ends, ["key", "epoch"]).groupBy("key").agg(F.min(F.struct(far.alias("far"), "h", "copy", "epoch")).alias("x"), F.first("over").alias("over")).where("x.far < over")
    gone = gone.select("key", "x.epoch", "x.h", "x.copy")
    ranks = F.row_number().over(Window.partitionBy("key").orderBy(_md5(seed, "block", F.col("key"), F.col("block")), "block")) - 1
    quotas = sources.select("key", F.ceil(F.col("t") / width).cast("long").alias("n")).where("n > 0")
    blocks_of = quotas.select("key", F.explode(F.expr("sequence(0L, n - 1)")).alias("block")).withColumn("rank", ranks.cast("long"))
    upto = F.sum("n").over(Window.partitionBy("key").orderBy("shard"))
    dealt = split_tree(quotas, levels, seed).withColumn("upto", upto).select("shard", "key", F.explode(F.expr("sequence(upto - n, upto - 1)")).alias("rank"))
    dealt = dealt.join(blocks_of, ["key", "rank"]).select("key", "block", "shard")
    drawn = items.join(gone, ["key", "epoch", "h", "copy"], "left_anti").withColumn("block", F.expr(f"from div {width}")).join(dealt, ["key", "block"])
    order_key = _md5(seed, "order", F.col("shard"), F.col("key"), F.coalesce(F.col("id").cast("string"), F.lit("~")), F.col("th"), F.col("epoch"), F.col("copy"))
    drawn = drawn.select("key", "id", "th", "copy", "size", "epoch", "block", "shard", order_key.alias("order_key"))
    documents = rows.join(sources.select("key", F.col("z").alias("source_size"), "target"), "key")
    return documents, drawn, 1 << levels


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row for each row of ``docs``: (id_col, source, size, source_size, target, taken, places).

    places lists where the document went, as shard:place in the shard's order, joined by commas.
    """
    documents, drawn, _ = mix(docs, id_col=id_col, **options)
    place = F.row_number().over(Window.partitionBy("shard").orderBy("order_key"))
    taken = drawn.withColumn("i", _named(F.col("id"))).select("key", "i", "th", "copy", "size", "shard", place.alias("place")).groupBy("key", "i", "th", "copy")
    taken = taken.agg(F.sum("size").alias("taken"), F.array_sort(F.collect_list(F.struct("shard", "place"))).alias("p"))
    rows = documents.withColumn("i", _named(F.col("id"))).join(taken, ["key", "i", "th", "copy"], "left")
    places = F.array_join(F.transform("p", lambda x: F.concat_ws(":", x["shard"].cast("string"), x["place"].cast("string"))), ",")
    return rows.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce(places, F.lit("")).alias("places"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one whole row for each time that a document is taken.

    Partition k holds shard k, in the shard's order.
    """
    _, drawn, shards = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    drawn = drawn.select(_named(F.col("id")).alias("_mix_i"), F.col("key").alias("_mix_key"), F.col("th").alias("_mix_th"), F.col("copy").alias("_mix_c"), F.col("shard").alias("_mix_shard"), F.col("order_key").alias("_mix_order"))
    same = ["_mix_i", "_mix_key", "_mix_th"]
    rest = [f.name for f in docs.schema if f.name not in (id_col, text_col, source_col) and f.dataType.typeName() not in ("map", "variant")]
    number = F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else "_mix_th"))
    rows = docs.withColumns({"_mix_i": _named(F.col(id_col)), "_mix_key": _named(F.col(source_col)), "_mix_th": F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))}).withColumn("_mix_n", number)
    # the difference keeps the copy's number out of the join keys, so both sides stay dealt by id, source and text
    alike = [rows[c] == drawn[c] for c in same]
    rows = rows.join(drawn, [*alike, rows["_mix_n"] - drawn["_mix_c"] == 0])
    rows = rows.select(*[rows[c] for c in docs.columns], "_mix_shard", "_mix_order")
    return rows.repartitionById(shards, F.col("_mix_shard").cast("int")).sortWithinPartitions("_mix_order").select(*docs.columns)
