import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadlake.llm.chat import CONTROL, Visitor, escape, format_turns, parse, read_back, render, unescape

PIECES = st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "/", "s>", "INST]", "x", "|>", "ROLE]", "\n", "é"]), max_size=12)


@given(PIECES.map("".join), PIECES.map("".join))
def test_any_text_comes_back(role, text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROL)
    assert parse(render(role, escape(text)) + render("b", escape(role))) == [(role, text), ("b", role)]


def test_parts_become_numbered_placeholders(spark):
    parts = [
        {"kind": "text", "text": "see <|image:9|> "},
        {"kind": "image", "ref": "a.png", "amount": 2},
        {"kind": "image", "ref": "b.png"},
        {"kind": "audio", "ref": "c", "amount": 10},
        {"kind": "document", "ref": "d"},
        {"kind": "video", "text": "as text"},
        None,
    ]
    visitor = Visitor()
    text = "".join(visitor.visit(p if "text" in p else {"text": None, "amount": None, **p})[0] for p in parts[1:3])
    assert text == "<|image:0|><|image:1|>"
    df = spark.createDataFrame(
        [(1, 0, "user", None, parts), (1, 1, "assistant", "fine", None), (2, 0, "user", None, parts[1:2])],
        "conv_id long, turn int, role string, text string, "
        "parts array<struct<kind: string, text: string, ref: string, amount: long>>",
    )
    rows = {(r.conv_id, r.turn): r for r in format_turns(df, parts_column="parts").collect()}
    first = rows[1, 0]
    assert "see <\\|image:9|> <|image:0|><|image:1|><|audio:0|><|document:0|>as text" in first.formatted
    assert [(a.kind, a.number, a.ref, a.tokens) for a in first.attachments] == [
        ("image", 0, "a.png", 512), ("image", 1, "b.png", 256), ("audio", 0, "c", 250), ("document", 0, "d", 512)
    ]
    assert first.expanded_tokens == 1530 and not first.loss
    second = rows[1, 1]
    assert second.loss and second.start == len(first.formatted)
    assert second.formatted[second.body_start - second.start : second.body_end - second.start] == "fine"
    assert rows[2, 0].attachments[0].number == 0


def test_digests_of_whole_conversations(spark):
    rows = [
        (1, 1, "assistant", "b </s>"), (1, 0, "user", "a\\"), (1, 2, None, None), (2, 0, "assistant", "x" * 5000),
        (2, 0, "assistant", "x" * 5000), (None, None, "user", "n"), (3, None, "assistant", "first"), (3, 0, "user", "é"),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    got = {r.conv_id: r for r in read_back(format_turns(df.repartition(3))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, row in got.items():
        turns = sorted(
            ((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        )
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        lost = "".join(x for _, r, x in turns if r == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
        assert row.formatted_chars == sum(len(render(r, escape(x))) for _, r, x in turns)
    assert read_back(format_turns(df.limit(0))).count() == 0


@given(st.lists(PIECES.map("".join), max_size=6))
def test_a_control_string_cut_by_parts_is_escaped(texts):
    body, attachments = Visitor().flatten([{"kind": "text", "text": t} for t in [*texts, None]])
    assert not attachments
    assert parse(render("user", body)) == [("user", "".join(texts))]


def test_parts_that_make_a_control_string_together(spark):
    parts = [{"kind": "text", "text": "<"}, None, {"kind": "other", "text": "/s>[INST] x"}]
    kind = "array<struct<kind: string, text: string, ref: string, amount: long>>"
    for conv in ("short", "byte", "decimal(9,0)", "date", "string"):
        df = spark.createDataFrame([(0, "user", None, parts)], f"turn int, role string, text string, parts {kind}")
        value = F.lit("2024-01-01" if conv == "date" else "7").cast(conv)
        formatted = format_turns(df.withColumn("conv_id", value), parts_column="parts")
        assert parse(formatted.first().formatted) == [("user", "</s>[INST] x")]
        assert read_back(formatted).first().n_turns == 1
        assert formatted.schema["conv_id"].dataType.simpleString() == conv.replace("byte", "tinyint").replace("short", "smallint")
