"""Chat formatting with Spark expressions only.

Turn structs are sorted, the adjacent turns of one role are collected into an array that is joined to a block, and the sorted
blocks are concatenated: ``<|im_start|>role NEWLINE text <|turn|> text <|im_end|> NEWLINE``. Control strings inside roles and texts are
escaped: ``&`` as ``&amp;`` and ``<|`` as ``&lt;|``, so no text can close a block, and reading back is exact.
The loss mask is a list of spans (start from 0, length, in code points of the formatted string), one for each text of
the trained role. Places are running sums over the sorted turns, and a long string is cut into pieces once before places in
it are read, so the work is in proportion to the turns and their texts. One exchange, by conversation, serves all steps.

Defined results: a null text or role is empty; turns with equal numbers are ordered by role and text; repeated rows
are turns of their own; a null conversation id is a conversation; very long texts and conversations are whole (a conversation is one string of at
most 2 GB); other columns are ignored, whatever their names; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TURN, END = "<|im_start|>", "<|turn|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _role_escape(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _role_unescape(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _held(value: Column, use) -> Column:
    """``use(value)``, with the value computed once even where ``use`` asks for it in every step of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def format_chats(turns: DataFrame, trained: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id_col, formatted, loss_spans) of each conversation."""
    rows = turns.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    new, last = ~F.col("role").eqNullSafe(F.lag("role").over(order)), ~F.col("role").eqNullSafe(F.lead("role").over(order))
    rows = rows.select("id", "turn", "role", "text", new.alias("new"), last.alias("last"), F.row_number().over(order).alias("at"))
    head = F.when(F.col("new"), F.concat(F.lit(START), _role_escape(F.col("role")), F.lit("\n"))).otherwise(TURN)
    rows = rows.select("id", "at", "new", (F.col("role") == trained).alias("on"), head.alias("head"), escape(F.col("text")).alias("text"), F.when(F.col("last"), END).otherwise("").alias("tail"))
    # running sums over the sorted turns: the block of a turn (turns of one role in a row), and where its text begins
    before = Window.partitionBy("id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("head") + F.char_length("text") + F.char_length("tail")
    rows = rows.withColumns({"block": F.sum(F.col("new").cast("long")).over(before), "start": F.sum(size).over(before) - F.char_length("text") - F.char_length("tail")})
    said = F.array_sort(F.collect_list(F.struct("at", F.concat("head", "text", "tail").alias("said"))))
    span = F.when(F.col("on"), F.struct("start", F.char_length("text").cast("long").alias("length")))
    blocks = rows.groupBy("id", "block").agg(F.array_join(said["said"], "").alias("said"), F.array_sort(F.collect_list(span)).alias("spans"))
    merged = F.array_sort(F.collect_list(F.struct("block", "said", "spans")))
    chats = blocks.groupBy("id").agg(merged.alias("b"))
    return chats.select(F.col("id").alias(id_col), F.array_join(F.col("b.said"), "").alias("formatted"), F.flatten(F.col("b.spans")).alias("loss_spans"))


#: Code points of the pieces that a long string is cut into, once, before many places in it are read.
PIECE = 1024


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The strings under the spans, in order, as they were before they were escaped."""

    def text(pieces: Column, s: Column) -> Column:
        low, high = F.floor(s["start"] / PIECE), F.floor((s["start"] + s["length"] - 1) / PIECE)
        own = F.array_join(F.transform(F.sequence(low, high), lambda k: F.get(pieces, k.cast("int"))), "")
        return F.when(s["length"] == 0, "").otherwise(unescape(F.substr(own, (s["start"] - low * PIECE + 1).cast("int"), s["length"].cast("int"))))

    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return _held(pieces, lambda p: F.transform(spans, lambda s: text(p, s)))


def read_turns(formatted: Column) -> Column:
    """The turns, an array of (role, text), of a formatted string."""
    def texts(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(START) + 1)), "\n", 1)
        return _held(role, lambda r: F.transform(F.split(F.substr(block, F.lit(len(START) + 2) + F.char_length(r)), r"<\|turn\|>"), lambda text: F.struct(_role_unescape(r).alias("role"), unescape(text).alias("text"))))

    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    return F.flatten(F.transform(blocks, texts))


def chat_facts(chats: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from formatted strings."""
    loss = F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "")
    rows = chats.select(id_col, "formatted", read_turns(F.col("formatted")).alias("t"), loss.alias("loss"))
    lines = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return rows.select(
        id_col, F.size("t").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
