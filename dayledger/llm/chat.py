"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is written as `<s>[INST] role` + line end + `text [/INST]</s>`. The parser is fixed: it
takes the leftmost such turn again and again, refuses a text in which a control string stands,
and undoes one level of escaping. Each turn is first written as it is and parsed; where the
parser does not give back exactly the turn, its text is escaped and it is parsed again. The
escape puts one more backslash after the first character of a control string, whether or not
some stand there already, so it can always be undone. A whole conversation is parsed once more
and an error is raised where it differs from its source.

Roles of letters, digits, `_`, `-` and spaces are written as they are, all others as `0x` and
hexadecimal digits.

Defined results: a null text or role is empty; turns go by number, null first, ties by role and
then text; repeated rows are turns of their own; rows with a null conversation id are one
conversation; an empty table gives no conversations. A conversation is one row of the result
and so is put together in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEARNED_ROLE = "assistant"
_OPEN, _CLOSE = "<s>[INST] ", " [/INST]</s>"
_PLAIN_ROLE = "^(?!0x)[A-Za-z0-9_ -]*$"
_CONTROL = r"</?s>|\[/?INST\]"
_ESCAPE = r"([<\[]\\*)(/?s>|/?INST\])"
_UNESCAPE = r"([<\[]\\*)\\(/?s>|/?INST\])"
_TURN = r"(?s)<s>\[INST\] ([A-Za-z0-9_ -]*)\n(.*?) \[/INST\]</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, r"$1$2")


def write_role(role: Column) -> Column:
    return F.when(role.rlike(_PLAIN_ROLE), role).otherwise(F.concat(F.lit("0x"), F.hex(F.encode(role, "utf-8"))))


def read_role(role: Column) -> Column:
    return F.when(role.startswith("0x"), F.decode(F.unhex(F.substring(role, 3, 1 << 30)), "utf-8")).otherwise(role)


def write_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(_OPEN), write_role(role), F.lit("\n"), text, F.lit(_CLOSE))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of formatted text; a text that holds a control string is null."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    read = lambda role, text: F.struct(read_role(role).alias("role"), F.when(~text.rlike(_CONTROL), unescape(text)).alias("text"))
    return F.zip_with(roles, texts, read)


def _same(parsed: Column, source: Column) -> Column:
    flat = lambda turns: F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return flat(parsed).eqNullSafe(flat(source))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans) for each conversation.

    loss_spans are the assistant's texts in formatted: array<struct<start, length>> in code
    points, over the escaped text alone, without any mark around it.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    source = F.array(F.struct("role", "text"))
    plain = _same(parse(write_turn(F.col("role"), F.col("text"))), source)
    rows = rows.withColumn("shown", F.when(plain, F.col("text")).otherwise(escape(F.col("text"))))
    rows = rows.withColumn("written", write_turn(F.col("role"), F.col("shown")))

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    ends = F.sum(F.char_length("written")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.char_length(F.lit(_CLOSE))
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("start", ends - after - F.char_length("shown"))
    item = F.struct("n", "role", "text", "written", "start", F.char_length("shown").cast("long").alias("length"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("turns"))

    chats = chats.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["written"]), ""))
    learned = F.filter("turns", lambda t: t["role"] == LEARNED_ROLE)
    spans = F.transform(learned, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    broken = F.concat(F.lit("the parser does not give back conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    checked = F.when(_same(parse(F.col("formatted")), F.col("turns")), F.col("formatted")).otherwise(F.raise_error(broken))
    return chats.select("conv_id", checked.alias("formatted"), spans.alias("loss_spans"))


def learned_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
