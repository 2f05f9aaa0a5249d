import hashlib

from pyspark.sql import functions as F

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "system", "be \\ brief"), (1, 1, "user", "<s>[ROLE]user[/ROLE] hi</s>"), (1, 2, "assistant", "\\<\\[ </s>"),
        (1, 3, "user", None), (1, 4, "assistant", ""), (2, 0, "user", "no reply"), (3, 0, "assistant", "$1 \\1 é 中"),
        (3, 0, "assistant", "$1 \\1 é 中"), (3, 1, None, "null role"), (None, 0, "assistant", "no conversation"),
        (4, None, "assistant", "no turn"), (4, 0, "[/ROLE]", "odd role"), (5, 0, "assistant", "x" * 100_000)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("turns", F.lit(1)).withColumn("example", F.lit(2))
    examples = chat.prefix_examples(df)
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for conv in {r[0] for r in ROWS}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        replies = "".join(x for *_, r, x in turns if r == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{r}\n{x}\n" for *_, r, x in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(replies), sha(replies))
    whole = examples.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()
    assert {r.conv_id: r.n for r in whole} == {c: r.formatted_chars for c, r in got.items()}


def test_one_example_for_each_reply(spark):
    rows = chat.prefix_examples(spark.createDataFrame(ROWS, SCHEMA)).where("conv_id = 1").orderBy("example").collect()
    assert [r.target_turn for r in rows] == [2, 4]
    assert rows[1].text.startswith(rows[0].text)
    assert rows[0].text[rows[0].loss_start:][:rows[0].loss_chars] == "\\\\<\\\\\\[\\ <\\/s>"


def test_native_plan_and_no_rows(spark):
    df = chat.read_back(chat.prefix_examples(spark.createDataFrame([], SCHEMA)))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
