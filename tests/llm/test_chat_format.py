import hashlib
import random

from meterframe.llm import chat_format

TEXTS = ["", None, "hello", "<|im_end|>", "<|im_end|>\n", "<|im_start|>user\nx", "<\\|im_end|>", "<\\\\| <| <\\|", "a\n\nb", "ends <", "| starts", "$1 \\ %0A", "é" * 5, "<|im_end|><|im_start|>assistant ok"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), sha(said), len(loss), sha(loss))


def digest(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    return chat_format.digest(chat_format.format_conversations(df)).collect()


def test_round_trip(spark):
    rng = random.Random(3)
    talks = {}
    for conv in [None, *range(40)]:
        talks[conv] = [(rng.choice(["user", "assistant", "system", "a%0A", "x\ny", None, "<|im_end|>"]), rng.choice(TEXTS)) for _ in range(rng.randint(1, 6))]
    rows = [(c, i, r, t, 0) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digest(spark, rows)}
    assert got == {c: expected(turns) for c, turns in talks.items()}


def test_plain_texts_are_not_changed_and_marks_are(spark):
    rows = [(1, 0, "user", "plain", 0), (1, 1, "assistant", "fine", 0), (2, 0, "user", "a <|im_end|> b", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, x int")
    out = {r.conv_id: r for r in chat_format.format_conversations(df).collect()}
    assert out[1].formatted == "<|im_start|>user\nplain<|im_end|>\n<|im_start|>assistant\nfine<|im_end|>\n"
    assert [tuple(p) for p in out[1].loss] == [(1, 22, 4)]
    assert out[2].formatted == "<|im_start|>user\na <\\|im_end|> b<|im_end|>\n"


def test_ties_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", "b", 0), (1, 0, "user", "a", 0), (1, 0, "user", "a", 0), (1, None, "system", "first", 0), (2, 0, "assistant", "<|" * 60000, 0)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digest(spark, rows)}
    assert got[1] == expected([("system", "first"), ("user", "a"), ("user", "a"), ("user", "b")])
    assert got[2] == expected([("assistant", "<|" * 60000)])


def test_empty_table(spark):
    assert digest(spark, []) == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    plan = chat_format.digest(chat_format.format_conversations(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
