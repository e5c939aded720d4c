"""Conversations as one formatted text each, with a loss mask, by column expressions only.

Template: each run of turns of one role is ``<s>role[INST]text</s>``; the texts of the run's turns are parted by ``[/INST]``. These four are the control
strings. Where a role or a text spells one, with any number of backslashes behind its first sign, one more backslash is put there; taking one out again
restores it, so the formatted text can be parsed back to the turns. The mask comes as segments whose concatenation is the formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_TAIL = r"(/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 learned_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, n_messages (runs of one role), formatted, segments (array of text and in_loss).

    Turns are sorted by turn (null first), then role and text, so ties and repeated rows have one order; all rows stay. Null roles and texts
    count as empty; a null conversation id is a conversation. An empty table gives no rows; other columns are not looked at.
    """
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chats = df.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    before = lambda i: F.get("turns", i - 1)["role"]
    begins = lambda x, i: (i == 0) | (x["role"] != before(i))

    def parts(x: Column, i: Column) -> Column:
        head = F.concat(F.when(i == 0, F.lit(OPEN)).otherwise(F.lit(CLOSE + OPEN)), escape(x["role"]), F.lit(BODY))
        mark = F.when(begins(x, i), head).otherwise(F.lit(NEXT))
        return F.array(F.struct(mark.alias("text"), F.lit(False).alias("in_loss")),
                       F.struct(escape(x["text"]).alias("text"), (x["role"] == learned_role).alias("in_loss")))

    close = F.array(F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("in_loss")))
    merged = chats.select("conv_id", F.concat(F.flatten(F.transform("turns", parts)), close).alias("segments"),
                          F.size(F.filter("turns", begins)).cast("long").alias("n_messages"))
    return merged.select("conv_id", "n_messages", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of role and text, in order."""
    def turns(message: Column) -> Column:
        body = F.substr(message, F.lit(1), F.length(message) - len(CLOSE))
        role = F.substring_index(body, BODY, 1)
        texts = F.split(F.substr(body, F.length(role) + len(BODY) + 1), r"\[/INST\]")
        return F.transform(texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    messages = F.split(formatted, OPEN)
    return F.flatten(F.transform(F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0))), turns))


def loss_text(segments: Column) -> Column:
    """All text under the mask as it was before escaping, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["in_loss"]), lambda s: unescape(s["text"])), "")
