"""Op 3: chat formatting with a grammar round trip, by DataFrame functions only.

A turn is rendered as ``<|im_start|>role`` newline ``text<|im_end|>`` newline. The parser is deterministic: turns
begin at the start mark; the role ends at the first newline; the text ends at the end mark; then escapes are undone.
Each turn is first rendered as it is, reparsed and compared with its source. Only where they differ it is escaped, and
compared again; the escape is reversible, so this ends after one step (``faithful`` tells so for each conversation).

Escaping adds a tilde inside each ``<|`` (and each that has tildes already: ``<~|`` becomes ``<~~|``); in roles a
newline becomes ``<~n|``. Undoing takes one tilde away, so texts without ``<|`` and ``<~|`` look as they did.

Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns of their own. Null roles and
texts count as empty; rows of a null conversation id form one conversation. An empty table gives an empty result.
A conversation is one value of the result, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import let

#: The marks of the template.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)\|", r"<~$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<~(~*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.regexp_replace(escaped(role), r"<(~+)n\|", r"<~$1n|"), F.lit("\n"), F.lit("<~n|"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(F.replace(role, F.lit("<~n|"), F.lit("\n")), r"<~(~+)n\|", r"<$1n|"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parsed(output: Column) -> Column:
    """Turns of rendered text as ``role, text`` and, in code points of the output, ``start`` and ``stop`` of the text."""
    pieces = F.slice(F.split(output, r"<\|im_start\|>"), 2, 1 << 30)
    raw = F.transform(pieces, _raw_turn)
    # Where each piece begins: the lengths of those before it and of their start marks
    sizes = F.transform(pieces, lambda p: F.length(p) + len(START))
    return F.zip_with(raw, sums_before(sizes), _placed)


def _sums(values: Column) -> Column:
    """Zero, and the sum up to each value."""
    return F.aggregate(values, F.array(F.lit(0)), lambda all_, n: F.concat(all_, F.array(F.element_at(all_, -1) + n)))


def sums_before(values: Column) -> Column:
    """The sum of the values before each one. Stretches of about the square root of their number are summed up first, as
    an array is copied whenever it grows.
    """

    def cut(values: Column) -> Column:
        n = F.size(values)
        length = F.greatest(F.ceil(F.sqrt(n)), F.lit(1)).cast("int")
        return let(length, lambda k: F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), k), lambda i: _sums(F.slice(values, i + 1, k))))

    def moved(stretches: Column) -> Column:
        offsets = F.slice(_sums(F.transform(stretches, lambda x: F.element_at(x, -1))), 1, F.size(stretches))
        return F.flatten(F.zip_with(stretches, offsets, lambda x, offset: F.transform(F.slice(x, 1, F.size(x) - 1), lambda v: v + offset)))

    return let(let(values, cut), moved)


def _raw_turn(piece: Column) -> Column:
    role = F.substring_index(piece, "\n", 1)
    rest = F.substring(piece, F.length(role) + 2, F.length(piece))
    return F.struct(role.alias("role"), F.substring_index(rest, END, 1).alias("text"))


def _placed(turn: Column, begin: Column) -> Column:
    start = begin + len(START) + F.length(turn.role) + 1
    return F.struct(
        unescaped_role(turn.role).alias("role"),
        unescaped(turn.text).alias("text"),
        start.alias("start"),
        (start + F.length(turn.text)).alias("stop"),
    )


def _same(output: Column, role: Column, text: Column) -> Column:
    """Whether rendered text is read back as the one turn it was made from."""
    turns = parsed(output)
    return (F.size(turns) == 1) & (turns[0].role == role) & (turns[0].text == text)


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, turns, loss_spans, faithful``.

    ``turns`` are read back from ``formatted``. ``loss_spans`` are the (start, stop) of assistant texts in it.
    """
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    plain = rendered(F.col("role"), F.col("text"))
    careful = rendered(escaped_role(F.col("role")), escaped(F.col("text")))
    turns = rows.withColumn("output", F.when(_same(plain, F.col("role"), F.col("text")), plain).otherwise(careful))
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "output"))).alias("source"))
    formatted = ordered.withColumn("formatted", F.array_join("source.output", ""))
    read = formatted.withColumn("turns", parsed(F.col("formatted")))
    same = F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))) == F.transform("source", lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    learned = F.filter("turns", lambda t: t.role == LEARNED_ROLE)
    return read.select("conv_id", "formatted", "turns", F.transform(learned, lambda t: F.struct(t.start.alias("start"), t.stop.alias("stop"))).alias("loss_spans"), same.alias("faithful"))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, with nothing between its parts."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(formatted, s.start + 1, s.stop - s.start))), "")
