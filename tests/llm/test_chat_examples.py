"""Chat examples: round trips, masks and the contract's digests by plain Python (SQL: the general test)."""

from hashlib import sha256

from hypothesis import given
from hypothesis import settings
from hypothesis import strategies as st

from citemill.llm import chat_examples as ce
from citemill.llm.queries import QUERIES
from tests.llm.conftest import got

SCHEMA = "conv_id long, turn long, role string, text string, turns string, target int, last string, whole string"
TRICKY = ["</s>[INST] ok [/INST]", "[\\INST]", "<\\\\/s>", "<<SYS>> <</SYS>> [\\[INST]", "[TURN] a[:] b [/TURN]", "\\", "<", "[",
          "<s", "<<s>>", "[[INST]]", "a\nb\r\n", "", None, "日本語 é", "$1 \\1", "<<\\SYS>>", "</s></s>", "[:]", "[\\:]"]
ROLES = ["system", "user", "assistant", "tool", None, "", "[:] [TURN] x", "a</s>"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "l", "w") for r in rows], SCHEMA)


def ordered(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role, text))
    key = lambda t: tuple((v is not None, v if v is not None else 0) for v in t)
    return {c: [(r or "", t or "") for _, r, t in sorted(v, key=key)] for c, v in out.items()}


def brute(rows):
    out = []
    for conv, turns in ordered(rows).items():
        said = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), sha256(whole.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return got(ce.digest(ce.examples(df)), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


MIXED = [(1, 0, "system", "be brief"), (1, 1, "user", "hello"), (1, 2, "assistant", "hi"), (1, 3, "user", "bye"),
         (1, 4, "assistant", "see you"), (1, 5, "user", "still there?"),
         (2, 0, "user", "anyone?"), (None, 0, "user", "who"), (None, 1, "assistant", "me"),
         (3, None, "assistant", None), (3, None, "assistant", None), (3, 0, None, "x"), (3, 0, "user", "b"), (3, 0, "user", "a"),
         (4, 0, "assistant", ""), (5, 2, "assistant", "second"), (5, 1, "assistant", "first")]


def test_mixed(spark):
    assert digest(frame(spark, MIXED)) == brute(MIXED)


def test_every_reply_is_one_example(spark):
    made = ce.examples(frame(spark, MIXED)).where("conv_id = 1").orderBy("target").collect()
    assert [r.target for r in made] == [3, 5, 6] and [r.last for r in made] == [False, False, True]
    assert [r.text[r.loss_start : r.loss_end] for r in made] == ["hi", "see you", ""]
    assert made[0].text == "<s><<SYS>>\nbe brief\n<</SYS>>[INST] hello [/INST] hi </s>"
    assert all(r.text.startswith(made[0].text) for r in made)


def test_control_strings(spark):
    rows = [(i * 100 + j, k, role, text) for i, a in enumerate(TRICKY) for j, b in enumerate(ROLES)
            for k, (role, text) in enumerate([(b, a), ("assistant", a), ("user", a), (b, a)])]
    assert digest(frame(spark, rows)) == brute(rows)
    marks = [m.strip() for pair in ce.MARKS.values() for m in pair if m.strip()]
    for r in ce.examples(frame(spark, [(1, 0, "user", "".join(map(str, TRICKY)))])).collect():
        inner = r.text[len("<s>[INST] ") : -len(" [/INST]")]
        assert not any(m in inner for m in [*marks, ce.BEGIN, "[TURN]", "[/TURN]", "[:]"])


def test_empty(spark):
    assert digest(frame(spark, [])) == []


def test_long_conversation_and_text(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} " * 5) for i in range(300)]
    rows += [(2, 0, "user", "[INST] " * 300_000), (2, 1, "assistant", "ok</s> " * 300_000)]
    assert digest(frame(spark, rows)) == brute(rows)


def test_probe_and_chars(spark):
    rows = QUERIES["op13_prefix_targets"](spark, "/root/testdata/sf0.001").where("conv_id = -1").collect()
    text = "</s>[INST] ok [/INST]"
    assert len(rows) == 1 and rows[0].n_turns == 2 and rows[0].loss_chars == len(text)
    assert rows[0].loss_sha256 == sha256(text.encode()).hexdigest()
    # Three control strings in each text, all parted by one character.
    assert rows[0].formatted_chars == 3 + 15 + len(text) + 3 + 6 + len(text) + 3


def test_native(spark, plan):
    df = ce.digest(ce.examples(frame(spark, MIXED)))
    df.collect()
    shown = plan(df)
    assert "Python" not in shown and "Arrow" not in shown
    assert shown.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.text("[]<>/\\INSTsURYS: \n", max_size=24)), min_size=1, max_size=30))
def test_any_text(spark, turns):
    rows = [(i // 3, i, r, t) for i, (r, t) in enumerate(turns)]
    assert digest(frame(spark, rows)) == brute(rows)
