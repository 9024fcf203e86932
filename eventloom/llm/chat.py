"""Conversations as one training text each, with Spark expressions only: turns are sorted and merged inside arrays.

A text reads, for each run of neighbouring turns of one role, ``<|im_start|>role<|im_mid|>text<|im_next|>text<|im_end|>``:
turns of one role share a block and stay apart inside it, so the turns can be read back as they were. No role or
text can hold a control string, of this template or of common others: a backslash goes in behind the first character
of each one (``</s>`` becomes ``<\\/s>``), and one more where backslashes stand there already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MID, NEXT, END = "<|im_start|>", "<|im_mid|>", "<|im_next|>", "<|im_end|>"
# What begins a control string of the public chat formats, and what follows in each of them.
CONTROL_OPENS = r"[<\[]"
CONTROL_RESTS = r"\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
# Turns of one conversation that are merged in one array; longer conversations are put together from such parts.
PART_TURNS = 64
_SPANS = "array<struct<start:bigint,bytes:bigint>>"


def escape(text: Column) -> Column:
    """The text without any control string; ``unescape`` gives it back."""
    return F.regexp_replace(text, rf"({CONTROL_OPENS})(\\*)({CONTROL_RESTS})", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"({CONTROL_OPENS})\\(\\*)({CONTROL_RESTS})", "$1$2$3")


def _merged(turns: Column) -> Column:
    """struct(parts, at, spans, ...) of sorted turns: what stands between the first turn's block head and the last one's end."""
    def add(seen: Column, turn: Column) -> Column:
        between = (F.when(F.size(seen["parts"]) == 0, "").when(seen["role"] == turn["role"], NEXT)
                   .otherwise(F.concat(F.lit(END + START), turn["role"], F.lit(MID))))
        start = seen["at"] + F.octet_length(between)
        size = F.octet_length(turn["text"]).cast("long")
        span = F.struct(start.alias("start"), size.alias("bytes"))
        return F.struct(turn["role"].alias("role"), (start + size).alias("at"),
                        F.concat(seen["parts"], F.array(F.concat(between, turn["text"]))).alias("parts"),
                        F.when(turn["learnt"], F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"]).alias("spans"))

    none = F.struct(F.lit("").alias("role"), F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"),
                    F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(turns, none, add)


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         learnt: Sequence[str] = ("assistant",), part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans): each conversation as one text, and where the turns lie whose loss counts.

    Turns are ordered by turn, then role, then text; a null turn comes first, a null role or text is empty, a null
    ``conv_id`` is one conversation of its own. Repeated rows are turns of their own. ``loss_spans`` are UTF-8 byte
    offsets and lengths in ``formatted``, one for each turn of a role in ``learnt``, without marks. An empty table
    gives no rows; other columns are ignored. Long conversations meet as merged parts of ``part_turns`` turn numbers
    each; a conversation is one text and has to fit into a row.
    """
    said, by = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_id).alias("conv"), F.floor(F.col(turn) / part_turns).alias("part"),
                        F.struct(F.col(turn).alias("turn"), by.alias("raw"), said.alias("said"), escape(by).alias("role"),
                                 escape(said).alias("text"), by.isin(*learnt).alias("learnt")).alias("t"))
    parts = (rows.groupBy("conv", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
             .select("conv", "part", F.size("turns").cast("long").alias("n"), F.col("turns")[0]["role"].alias("first"),
                     F.element_at("turns", -1)["role"].alias("last"), _merged(F.col("turns")).alias("m"))
             .select("conv", F.struct("part", "n", "first", "last", F.array_join("m.parts", "").alias("body"), F.col("m.at").alias("bytes"),
                                      F.col("m.spans").alias("spans")).alias("p")))
    whole = parts.groupBy("conv").agg(F.sort_array(F.collect_list("p")).alias("ps"))

    def head(p: Column, i: Column) -> Column:
        opened = F.concat(F.lit(START), p["first"], F.lit(MID))
        before = F.get(F.col("ps"), i - 1)
        return F.when(i == 0, opened).when(before["last"] == p["first"], NEXT).otherwise(F.concat(F.lit(END), opened))

    headed = whole.withColumn("heads", F.transform("ps", head))
    # Where each part's body starts: one entry for each part, the last one is the length of all.
    sizes = F.transform("ps", lambda p, i: F.octet_length(F.get(F.col("heads"), i)) + p["bytes"])
    ends = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda seen, size: F.concat(seen, F.array(F.element_at(seen, -1) + size)))
    placed = headed.withColumn("ends", ends)
    spans = F.flatten(F.transform("ps", lambda p, i: F.transform(p["spans"], lambda s: F.struct(
        (F.get(F.col("ends"), i + 1) - p["bytes"] + s["start"]).alias("start"), s["bytes"].alias("bytes")))))
    return placed.select(F.col("conv").alias(conv_id), F.aggregate("ps", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_turns"),
                         F.concat(F.array_join(F.transform("ps", lambda p, i: F.concat(F.get(F.col("heads"), i), p["body"])), ""), F.lit(END)).alias("formatted"),
                         spans.alias("loss_spans"))


def _literal(mark: str) -> str:
    return mark.replace("|", r"\|")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted text as they were."""
    def turns_of(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(START) + 1)), MID, 1)
        texts = F.split(F.substr(block, F.lit(len(START) + len(MID) + 1) + F.length(role)), _literal(NEXT))
        return F.transform(texts, lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")))

    blocks = F.split(formatted, _literal(END))
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns_of))


def read_learnt(formatted: Column, spans: Column) -> Column:
    """array<string>: the texts under the loss mask as they were."""
    whole = formatted.cast("binary")
    return F.transform(spans, lambda s: unescape(F.substr(whole, (s["start"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")))
