"""Chat formatting: every hostile content survives the round trip."""

from pyspark.sql import functions as F

from pageloom.llm import chat

HOSTILE = [
    "", "\n", "<|im_start|>", "<~|", "<~~|<|", "a<|im_end|", "<|im_end|>\n<|im_start|>user\nx<|im_end|>", "<~n|", "<~~n|",
    "<n|", "user\n<~n|", "$1\\", "<|x|>", "<", "|>", "é😀",
]
CHAT = "conv_id long, turn long, role string, text string"


def test_hostile_roles_and_texts(spark):
    rows = [(i, j, a, b) for i, a in enumerate(HOSTILE) for j, b in enumerate(HOSTILE)]
    for r in chat.format_chats(spark.createDataFrame(rows, CHAT)).collect():
        assert r.faithful
        assert [(t.role, t.text) for t in r.turns] == [(HOSTILE[r.conv_id], b) for b in HOSTILE]


def test_mask_holds_assistant_texts(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    made = chat.format_chats(spark.createDataFrame(rows, CHAT))
    got = made.select(chat.under_mask(made.formatted, made.loss_spans).alias("m")).first().m
    assert got == "".join(HOSTILE[1::2])


def test_plain_text_is_left_alone(spark):
    made = chat.format_chats(spark.createDataFrame([(1, 0, "user", "a <|b|> <c>")], CHAT)).first()
    assert made.formatted == "<|im_start|>user\na <|b|> <c><|im_end|>\n"


def test_nulls_repeats_and_empty(spark):
    rows = [(None, 1, None, None), (1, None, "user", "x"), (1, None, "user", "x"), (1, 0, "assistant", None)]
    made = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, CHAT)).collect()}
    assert [(t.role, t.text) for t in made[1].turns] == [("user", "x"), ("user", "x"), ("assistant", "")]
    assert [(t.role, t.text) for t in made[None].turns] == [("", "")]
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0


def test_no_python(spark):
    made = chat.format_chats(spark.createDataFrame([(1, 0, "user", "a")], CHAT))
    assert "Python" not in made._jdf.queryExecution().toString()


def test_sums_before_each_value(spark):
    rows = [[], [5], [1, 2], [3] * 10, list(range(101)), [7] * 5000]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<int>").select("i", chat.sums_before(F.col("v")).alias("s"))
    assert {r.i: r.s for r in df.collect()} == {i: [sum(r[:k]) for k in range(len(r))] if len(r) < 200 else [7 * k for k in range(len(r))] for i, r in enumerate(rows)}


def test_long_conversations_of_any_columns(spark):
    """Many turns take time about in proportion; other columns are left out."""
    chats = spark.range(40_000).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text", "'x' AS turns", "1 AS formatted")
    (row,) = chat.format_chats(chats).select(F.size("turns").alias("n"), "faithful", F.size("loss_spans").alias("learned"), F.element_at("loss_spans", -1).alias("last"), F.length("formatted").alias("chars")).collect()
    assert (row.n, row.faithful, row.learned) == (40_000, True, 20_000) and row.last.stop == row.chars - len(chat.END) - 1
