"""Chat formatting by grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "[INST]" role "\\n" body "[/INST]"  |  "<s>assistant\\n" body "</s>"

The assistant's bodies are under the loss mask. A turn is first rendered with its text as it is and parsed again; only where the
parse differs from the source are the control strings in the text escaped (a backslash after the first character: `[\\INST]`;
one more where backslashes already stand there), and the result is parsed and compared again. Escaping is one to one and leaves no
control string, so the second comparison holds for every text. A control string starts with `[` or `<` and has neither inside,
so none can straddle a text and a mark: a conversation parses as its turns do. The whole conversation is parsed and compared again all
the same, and `round_trip` reports the outcome.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings by who speaks: opening and closing mark.
LOSS_MARKS, OTHER_MARKS = ("<s>", "</s>"), ("[INST]", "[/INST]")
LOSS_ROLE = "assistant"
OPENS, CLOSES = r"\[INST\]|<s>", r"\[/INST\]|</s>"
#: Percent codes keep a role on one line and free of marks.
ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("[", "%5B"), ("<", "%3C"))


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")
    return F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")
    return F.regexp_replace(text, r"<\\(\\*)(/?s>)", r"<$1$2")


def _role_out(role: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), ROLE_CODES, role)


def _role_in(role: Column) -> Column:
    return reduce(lambda c, x: F.replace(c, F.lit(x[1]), F.lit(x[0])), reversed(ROLE_CODES), role)


def parse(formatted: Column) -> Column:
    """array<struct<role, text, loss>>; an entry of nulls stands for anything outside the grammar."""
    pieces = F.split(formatted, CLOSES, -1)

    def turn(piece: Column) -> Column:
        loss = piece.startswith(LOSS_MARKS[0])
        skip = F.when(loss, len(LOSS_MARKS[0])).when(piece.startswith(OTHER_MARKS[0]), len(OTHER_MARKS[0]))
        rest = F.substring(piece, skip + 1, F.length(piece))
        role = F.substring_index(rest, "\n", 1)
        text = unescape(F.substring(rest, F.length(role) + 2, F.length(rest)))
        good = skip.isNotNull() & (F.instr(rest, "\n") > 0) & ~rest.rlike(OPENS)
        return F.when(good, F.struct(_role_in(role).alias("role"), text.alias("text"), loss.alias("loss")))

    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
    return F.when(F.element_at(pieces, -1) == "", turns).otherwise(F.concat(turns, F.array(F.lit(None).cast("struct<role:string,text:string,loss:boolean>"))))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (0-based start and length, in characters of `formatted`, of every body under the loss mask), round_trip.

    Turns are ordered by turn, role, text, nulls first; rows that repeat are turns that repeat. Null role or text: empty. Rows with a null conv_id form one
    conversation. An empty table gives an empty result; other columns are ignored. A conversation's rendering is one string and so lies in one row.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"))
    loss = F.col("role") == LOSS_ROLE
    head = F.concat(F.when(loss, LOSS_MARKS[0]).otherwise(OTHER_MARKS[0]), _role_out(F.col("role")), F.lit("\n"))
    close = F.when(loss, LOSS_MARKS[1]).otherwise(OTHER_MARKS[1])
    same = F.array(F.struct("role", "text", loss.alias("loss")))
    rows = rows.withColumn("head", head).withColumn("close", close)
    rows = rows.withColumn("plain", F.coalesce(parse(F.concat("head", "text", "close")) == same, F.lit(False)))
    rows = rows.withColumn("body", F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))))
    rows = rows.withColumn("piece", F.concat("head", "body", "close"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(
        "conv_id", "role", "text", "piece", loss.alias("loss"), F.row_number().over(order).alias("ord"),
        (F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")).alias("start"),
        F.length("body").cast("bigint").alias("length"),
    )
    turns = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("ord", "piece", "role", "text"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("loss"), F.struct("start", "length")))).alias("loss_spans"),
    )
    turns = turns.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t.piece), ""))
    source = F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"), (t.role == LOSS_ROLE).alias("loss")))
    return turns.select("conv_id", "formatted", "loss_spans", F.coalesce(parse(F.col("formatted")) == source, F.lit(False)).alias("round_trip"))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What reading `formatted` back gives, one row per conversation; one that didn't pass its round trip is an error.

    Null roles and texts are empty, very long conversations are read whole, turns that tie or repeat stand in the order of format_chats(); an empty table gives an
    empty result.
    """
    failed = F.raise_error(F.concat(F.lit("a conversation doesn't read back as its source: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast("string")
    read = formatted.withColumn("formatted", F.when(F.col("round_trip"), F.col("formatted")).otherwise(failed)).withColumn("read", parse(F.col("formatted")))
    whole = F.array_join(F.transform("read", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    masked = F.array_join(F.transform(F.filter("read", lambda t: t.loss), lambda t: t.text), "")
    read = read.select("conv_id", F.size("read").cast("bigint").alias("n_turns"), whole.alias("whole"), masked.alias("masked"), F.length("formatted").cast("bigint").alias("formatted_chars"), "round_trip")
    return read.select(
        "conv_id", "n_turns", F.sha2("whole", 256).alias("turns_sha256"), F.length("masked").cast("bigint").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"), "formatted_chars",
    )


def with_conflict(conversations: DataFrame) -> DataFrame:
    """conversations and conversation -7, whose texts hold the template's own marks."""
    said = "</s>[INST] ok [/INST]"
    kinds = {k: t for k, t in conversations.dtypes}
    extra = conversations.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    names = ["conv_id", "turn", "role", "text"]
    return conversations.select(*names).unionByName(extra.select(*(F.col(c).cast(kinds[c]) for c in names)))
