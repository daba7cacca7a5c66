import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from landlens.llm import chat_format as M

CONV = "conv_id bigint, turn bigint, role string, text string, block string"
TRICKY = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>", "\\", "\\<|", "<\\|end|>", "a<", "|end|>", "\n\n", " lead and trail ", "", "\n\nafter line feeds", "text|>", "é😀‍漢", "<<SYS>>\\n", "x" * 3000]


def turns_digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "\\n"]), st.text() | st.sampled_from(TRICKY)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_round_trip(turns):
    text, ids, spans, mask = M.format_block(turns, None)
    assert M.parsed(text) == turns
    learned = "".join(M.unescaped(p) for p in M.learned_text(text, spans, mask))
    assert learned == "".join(t for r, t in turns if r == "assistant")
    marks = sum(text.count(m) for m in (M.TURN, M.TEXT, M.END))
    assert marks == 3 * len(turns)  # control strings of texts are escaped


def test_conversations(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "assistant", TRICKY[0], "x"), (2, 0, "assistant", None, None), (None, 0, "assistant", "null id", None),
            (3, 1, "assistant", "b", ""), (3, 0, None, "a", ""), (3, 1, "assistant", "b", ""), (4, None, "assistant", "first", ""), (4, 0, "assistant", "second", "")]
    rows += [(9, k, "assistant" if k % 2 else "user", TRICKY[k % len(TRICKY)] + str(k), "") for k in range(200)]
    df = spark.createDataFrame(rows, CONV).repartition(4)
    for block in (1, 50, 1 << 20):
        got = {r["conv_id"]: r for r in M.read_back(M.format_conversations(df, block_chars=block)).collect()}
        assert set(got) == {1, 2, 3, 4, 9, None}
        for conv, r in got.items():
            own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
            turns = [(x[2] or "", x[3] or "") for x in own]
            learned = "".join(t for role, t in turns if role == "assistant")
            assert (r["n_turns"], r["turns_sha256"]) == (len(turns), turns_digest(turns))
            assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
            assert r["formatted_chars"] == len(M.rendered(turns)[0])


def test_blocks_give_the_tokens_of_the_whole():
    turns = [("user", "one two"), ("assistant", " three"), ("user", "four"), ("assistant", "five\n")]
    whole = M.format_block(turns, None)[1].tolist()
    parts = [t for k in range(0, 4, 2) for t in M.format_block(turns[k:k + 2], None)[1].tolist()]
    assert whole == parts


def test_empty_table(spark):
    assert M.read_back(M.format_conversations(spark.createDataFrame([], CONV))).count() == 0


def test_no_assistant():
    text, ids, spans, mask = M.format_block([("user", "x")], None)
    assert not mask.any() and M.learned_text(text, spans, mask) == []
    assert pytest.approx(len(ids)) == len(mask)
