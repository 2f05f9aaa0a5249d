"""Chat formatting by prefix-target expansion, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings. Inside roles and texts `\`, `<` and `[` carry a `\` behind them, so none can occur.
OPEN, MIDDLE, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def _piece(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(MIDDLE), escape(turn["text"]), F.lit(CLOSE))


def prefix_examples(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text", reply_role: str = "assistant") -> DataFrame:
    """One example for every reply: the formatted conversation up to and with it, and the span that is trained.

    Returns conv_id, n_turns of the conversation, example (number), target_turn (place, from 0), text, loss_start and
    loss_chars (code points of the escaped reply inside `text`). A conversation that does not end in a reply has one
    more example without a target (target_turn null, loss_chars 0), so that no turn is lost.

    Turns are ordered by (turn, role, text), nulls first; repeated rows are turns of their own. Null roles and texts
    are empty; null conv_ids form one conversation. No rows give no rows. Other columns are not read.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = (rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
             .withColumn("pieces", F.transform("turns", _piece)))
    last = F.size("turns") - 1
    targets = F.filter(F.sequence(F.lit(0), last),
                       lambda i: (F.get("turns", i)["role"] == reply_role) | (i == last))
    each = (convs.select("conv_id", "turns", "pieces", F.posexplode(targets).alias("example", "at"))
            .withColumn("target", F.get("turns", F.col("at"))))
    trained = F.col("target.role") == reply_role
    text = F.array_join(F.slice("pieces", F.lit(1), F.col("at") + 1), "")
    loss = F.when(trained, F.length(escape(F.col("target.text")))).otherwise(F.lit(0))
    return (each.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "example",
                        F.when(trained, F.col("at")).alias("target_turn"), text.alias("text"),
                        loss.cast("long").alias("loss_chars"))
            .withColumn("loss_start", F.length("text") - len(CLOSE) - F.col("loss_chars")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold: turns of the longest one, and the texts under the loss masks in order."""
    reply = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_chars")))
    per = examples.groupBy("conv_id").agg(
        F.max(F.struct("example", "text")).alias("whole"), F.sum(F.length("text")).alias("formatted_chars"),
        F.sort_array(F.collect_list(F.when(F.col("target_turn").isNotNull(),
                                           F.struct("example", reply.alias("reply"))))).alias("replies"))
    pieces = F.filter(F.split(F.col("whole.text"), CLOSE, -1), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2**30), MIDDLE, 1)).alias("role"),
        unescape(F.substring_index(p, MIDDLE, -1)).alias("text")))
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return per.withColumn("turns", turns).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
               .cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"))
