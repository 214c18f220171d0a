"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every turn becomes ``### role: text</turn>`` and a line feed. In roles and texts
a backslash, ``#`` and the closing mark are escaped with a backslash (in roles
``:`` too), so no text can hold a mark and removing one backslash before each
escaped character gives the text back.

``expand`` makes one example for every assistant turn: all preceding turns as
context, then that turn, whose text alone is trainable. Turns after the last
assistant turn are context of no reply; they come in one more example without a
target, so that the output holds the whole conversation.

Rows are ordered by turn (null first), then role, then text, so ties and
repeated rows have one order. Null roles and texts count as empty. A null
conv_id is a conversation of its own. Other columns are ignored; an empty table
gives no examples. A conversation is gathered whole, however long its texts, as
its examples hold it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(plain, F.lit("#"), F.lit("\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def expand(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, example, last, trainable, text, loss_start, loss_length):
    one row per example, numbered from 1 in each conversation; the loss mask is
    loss_length code points of the formatted text from loss_start on."""
    said = F.coalesce(F.col(text), F.lit(""))
    by = F.coalesce(F.col(role), F.lit(""))
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"))))
    whole = df.groupBy(F.col(conv).alias("conv_id")).agg(turns.alias("turns"))
    whole = whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.transform("turns", lambda t: F.struct((t["role"] == ASSISTANT).alias("reply"), F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"))).alias("turns"),
    )
    places = F.filter(F.sequence(F.lit(1), F.col("n_turns").cast("int")), lambda i: F.element_at("turns", i)["reply"] | (i == F.col("n_turns")))
    cut = whole.select("conv_id", "n_turns", "turns", F.posexplode(places).alias("example", "cut"))
    target = F.element_at("turns", F.col("cut"))
    piece = lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))
    context = F.array_join(F.transform(F.slice("turns", 1, F.col("cut") - 1), piece), "")
    made = cut.select("conv_id", "n_turns", (F.col("example") + 1).alias("example"), (F.col("cut") == F.col("n_turns")).alias("last"), context.alias("context"), target.alias("target"))
    return made.select(
        "conv_id",
        "n_turns",
        "example",
        "last",
        F.col("target.reply").alias("trainable"),
        F.concat("context", piece(F.col("target"))).alias("text"),
        (F.length("context") + F.length("target.head")).cast("long").alias("loss_start"),
        F.when(F.col("target.reply"), F.length("target.body")).otherwise(0).cast("long").alias("loss_length"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What the formatted examples say of each conversation: its turns, from the
    example that holds them all, and the text under each example's loss mask."""
    small = examples.select(
        "conv_id",
        "example",
        "trainable",
        F.when(F.col("last"), F.col("text")).alias("formatted"),
        F.when(F.col("trainable"), unescape(F.substring(F.col("text"), (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int")))).alias("loss"),
    )
    found = small.groupBy("conv_id").agg(
        F.max("formatted").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("trainable"), F.struct("example", "loss")))).alias("loss"),
    )
    pieces = F.slice(F.split("formatted", "</turn>\n", -1), 1, F.size(F.split("formatted", "</turn>\n", -1)) - 1)
    role = lambda p: F.regexp_extract(p, r"(?s)^### ((?:[^\\:]++|\\.)*+): ", 1)
    turn = lambda p: F.concat(unescape(role(p)), F.lit("\n"), unescape(F.substr(p, F.length(role(p)) + F.lit(len(OPEN) + len(MIDDLE) + 1))), F.lit("\n"))
    told = F.transform("pieces", turn)
    loss = F.array_join(F.transform("loss", lambda x: x["loss"]), "")
    return found.select("conv_id", "formatted", "loss", pieces.alias("pieces")).select(
        "conv_id",
        F.size("pieces").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("loss").cast("long").alias("n_examples"),
    )
