"""Chat formatting with a grammar round trip, as DataFrame functions.

Grammar of a formatted conversation, a plain sequence of turns:

    user       [INST]text[/INST]
    assistant  <s>text</s>
    system     <<SYS>>text<</SYS>>
    others     [TURN=hex of the role]text[/TURN]

The parser reads the shortest match from left to right and takes one backslash out of every
escaped marker. A text conflicts if it holds a control string: its markers get a backslash behind
their first sign (``[/INST]`` becomes ``[\\/INST]``, ``[\\INST]`` becomes ``[\\\\INST]``), which the
parser undoes exactly. The rendered conversation is parsed again and compared with its source, turn
by turn; one that does not come back stops the job.

Turns of a conversation are ordered by (turn, role, text), nulls first; a null text or role counts
as empty; repeated rows are turns of their own; rows with a null conversation id form one
conversation. A conversation is one string, so its turns meet in one row: that is the result's own
size, and no other grouping is made. Extra columns are ignored; an empty table gives no rows.
Texts of any length are formatted whole; a row holds its conversation a few times over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What opens or closes a turn, behind the first sign and any backslashes.
MARKERS = r"/?INST\]|/?s>|/?SYS>>|TURN=[0-9A-F]*\]|/TURN\]"
ESCAPE = rf"([\[<])(\\*)({MARKERS})"
UNESCAPE = rf"([\[<])\\(\\*)({MARKERS})"
GRAMMAR = r"(?s)\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|<<SYS>>(.*?)<</SYS>>|\[TURN=([0-9A-F]*)\](.*?)\[/TURN\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE), F.lit("$1$2$3"))


def render_turn(role: Column, text: Column) -> Column:
    return (
        F.when(role == "user", F.concat(F.lit("[INST]"), text, F.lit("[/INST]")))
        .when(role == "assistant", F.concat(F.lit("<s>"), text, F.lit("</s>")))
        .when(role == "system", F.concat(F.lit("<<SYS>>"), text, F.lit("<</SYS>>")))
        .otherwise(F.concat(F.lit("[TURN="), F.hex(F.encode(role, "UTF-8")), F.lit("]"), text, F.lit("[/TURN]")))
    )


def parse(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""

    def turn(m: Column) -> Column:
        get = lambda i: F.regexp_extract(m, GRAMMAR, i)
        role = F.when(m.startswith("[INST]"), "user").when(m.startswith("<s>"), "assistant").when(m.startswith("<<SYS>>"), "system").otherwise(F.decode(F.unhex(get(4)), "UTF-8"))
        text = F.when(m.startswith("[INST]"), get(1)).when(m.startswith("<s>"), get(2)).when(m.startswith("<<SYS>>"), get(3)).otherwise(get(5))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(GRAMMAR), F.lit(0)), turn)


def _source(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _join(rendered: Column) -> Column:
    return F.array_join(rendered, "")


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, parsed (array of role and text)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    convs = convs.withColumn("formatted", _join(F.transform("turns", lambda t: render_turn(t["role"], escape(t["text"])))))
    convs = convs.withColumn("parsed", parse(F.col("formatted")))
    same = F.col("parsed") == _source(F.col("turns"))
    return convs.select("conv_id", "formatted", F.when(same, F.col("parsed")).otherwise(F.raise_error(F.lit("a conversation does not come back from its format")).cast(convs.schema["parsed"].dataType)).alias("parsed"))


def chat_digests(turns: DataFrame, **names: str) -> DataFrame:
    """Digests of :func:`format_conversations`, all taken from the parsed output."""
    out = format_conversations(turns, **names)
    listing = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("parsed", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return out.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(listing, 256).alias("turns_sha256"),
        F.struct(F.length(loss).cast("long").alias("n"), F.sha2(loss, 256).alias("h")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.col("loss.n").alias("loss_chars"), F.col("loss.h").alias("loss_sha256"), "formatted_chars")


__all__ = ["chat_digests", "escape", "format_conversations", "parse", "render_turn", "unescape"]
