import hashlib
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from paperlake.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "a\\<|b", "\\", "<\\|", "<<SYS>> <</SYS>>", "", "x\ny", "<s>\\\\", "😀é"]


def rows_of(spark, turns, extra=False):
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "1 AS formatted", "2 AS loss") if extra else frame


def expected(turns):
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda t: (str(t[0]), t[1], t[2] or "", t[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def check(spark, turns):
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(rows_of(spark, turns, True))).collect()}
    want = expected(turns)
    assert set(got) == set(want)
    for conv, pairs in want.items():
        loss = "".join(t for r, t in pairs if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(pairs)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in pairs).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_round_trip_of_control_strings(spark):
    turns = [(c, i, role, text) for c, text in enumerate(NASTY) for i, role in enumerate(("user", "assistant", "assistant", "a\nb<|"))]
    check(spark, turns)


def test_nulls_ties_repeats_and_null_conversations(spark):
    turns = [(1, 0, "user", None), (1, 0, None, "x"), (1, 1, "assistant", "y"), (1, 1, "assistant", "y"), (None, 5, "assistant", "z"), (2, 0, "user", "q")]
    check(spark, turns)
    assert chat.format_conversations(rows_of(spark, turns).limit(0)).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="<|\\[]/s>INTim_endcotSY\n ", max_size=25), min_size=1, max_size=20))
def test_any_text_comes_back(spark, texts):
    check(spark, [(i % 3, i, ("assistant", "user")[i % 2], t) for i, t in enumerate(texts)])


def test_neighbours_of_one_role_share_a_block(spark):
    turns = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    text = chat.format_conversations(rows_of(spark, turns)).first().formatted
    assert text == "<|im_start|>user\na<|im_cont|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"


def test_no_python_in_the_plan(spark, plan):
    text = plan(chat.digest(chat.format_conversations(rows_of(spark, [(1, 0, "user", "a")]))))
    assert "Python" not in text and "Arrow" not in text


def test_long_conversation(spark):
    check(spark, [(1, i, ("user", "assistant")[i // 2 % 2], f"text {i} " * 20) for i in range(600)])


def test_time_grows_with_the_turns(spark):
    def seconds(n):
        turns = spark.range(n, numPartitions=1).selectExpr("1 AS conv_id", "id AS turn", "IF(id % 3 = 0, 'user', 'assistant') AS role", "repeat('wörd ', 20) AS text")
        start = time.perf_counter()
        row = chat.digest(chat.format_conversations(turns)).first()
        assert row.n_turns == n and row.loss_chars == 100 * (n - len(range(0, n, 3)))
        return time.perf_counter() - start

    seconds(400)
    assert seconds(16_000) < 5 * seconds(4_000)
