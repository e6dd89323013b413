import hashlib

from hypothesis import given
from hypothesis import strategies as st

from feedmart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


@given(st.text(alphabet="<>[]|\\/sINSTendtx ", max_size=40))
def test_escape_can_be_undone_and_hides_controls(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))
    whole = f"{chat.START}user{chat.TEXT}{escaped}{chat.END}{chat.START}{escaped}{chat.TEXT}x{chat.END}"
    assert list(chat.read_turns(whole)) == [("user", text), (text, "x")]


def brute(rows):
    """Digests per conversation straight from the rows."""
    out = {}
    first = lambda v: (v is not None, v)
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: [first(x) for x in r])
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_digests_read_back_from_examples(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi <|end|> [INST]"), (1, 2, "assistant", "yes </s>"),
        (1, 3, "user", "more"), (1, 4, "assistant", None), (1, 5, "user", "tail"),
        (2, 0, "user", "alone"), (3, 0, "assistant", ""), (4, None, None, None), (None, 1, "user", "ünïcode 𝒳"),
        (None, 0, "assistant", "first"), (5, 1, "user", "tie b"), (5, 1, "user", "tie a"), (5, 1, "assistant", "tie"),
        (6, 0, "user", "same"), (6, 0, "user", "same"), (7, 0, "assistant", "x" * 200_000), (7, 1, "assistant", "y"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'z' as example", "1 as loss_start", "'q' as TEXT_")
    examples = chat.prefix_target_examples(frame)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(examples).collect()}
    assert got == brute(rows)
    one = [r for r in examples.collect() if r.conv_id == 1]
    assert [r.text[r.loss_start:r.loss_end] for r in sorted(one, key=lambda r: r.example)] == ["yes <\\/s>", "", ""]
    assert all(b.text.startswith(a.text) for a, b in zip(sorted(one, key=lambda r: r.example), sorted(one, key=lambda r: r.example)[1:]))


def test_empty_table(spark):
    examples = chat.prefix_target_examples(spark.createDataFrame([], SCHEMA))
    assert examples.count() == 0 and chat.read_back(examples).count() == 0
