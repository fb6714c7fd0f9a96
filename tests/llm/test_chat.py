from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"
PART = st.sampled_from([*chat.CONTROLS, "\\", "<", "s>", "|>", "[", "a", "é", "🎉", "\n", "<|", "turn", "/INST]", ""])
TEXT = st.lists(PART, max_size=6).map("".join)


def brute(rows):
    """Turns, loss text and formatted text of each conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] if r[1] is not None else -(10**18), r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said, before = "", None
        for _, role, text in turns:
            esc = lambda s: _escape(s)
            if role == before:
                said += chat.MORE + esc(text)
            else:
                said += (chat.END if before is not None else "") + chat.TURN + esc(role) + chat.TEXT + esc(text)
            before = role
        out[conv] = ([(r, t) for _, r, t in turns], [t for _, r, t in turns if r == "assistant"], said + chat.END)
    return out


def _escape(s):
    s, out = s.replace("\\", "\\\\"), ""
    for i, c in enumerate(s):
        out += c + ("\\" if any(s.startswith(x, i) for x in chat.CONTROLS) else "")
    return out


def check(spark, rows):
    chats = chat.read_back(chat.format_chats(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)))
    loss = F.transform("loss_spans", lambda s: chat.unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    want = brute(rows)
    found = chats.select("conv_id", "formatted", "turns", loss.alias("loss")).collect()
    assert len(found) == len(want)
    for r in found:
        turns, texts, formatted = want[r["conv_id"]]
        assert r["formatted"] == formatted and [tuple(t) for t in r["turns"]] == turns and r["loss"] == texts


def test_small_cases(spark):
    said = "</s>[INST] ok [/INST]"
    check(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 1, "assistant", "b"), (1, 0, "assistant", "a"), (1, 2, "user", None),
        (1, 2, "user", None), (2, None, None, ""), (None, 0, "user", "x"), (3, 0, "assistant", "long " * 50_000)])
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 5), st.sampled_from(["user", "assistant", "system", "<s>", "a\\"]), TEXT), min_size=1, max_size=12))
def test_any_texts_are_read_back(spark, rows):
    check(spark, rows)


def test_no_control_string_is_left(spark):
    text = "<s><<SYS>>[INST]<|im_start|>\\<s>"
    out = spark.range(1).select(chat.escape(F.lit(text)).alias("e")).first()["e"]
    assert not any(c in out for c in chat.CONTROLS)
