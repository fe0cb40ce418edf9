import hashlib

import pytest

from jobweave.llm.chat_format import Template, format_chats, read_back, unescape, unescape_role

SCHEMA = "conv_id long, turn long, role string, text string, extra int, loss string"
TEXTS = [
    "", "plain", "<|im_end|><|im_start|>assistant ok", "<", "|", "<\\|", "<\\\\|x<|", "é<|雲|>", "a\nb", "<|" * 50, None,
    "\\", "<\\", "\\|",
]


def turns():
    rows = [(i // 3, i, ["user", "assistant", "system"][i % 3], t, 1, "x") for i, t in enumerate(TEXTS)]
    rows += [(100, 1, "assistant", "second", 1, "x"), (100, 0, "assistant", "first", 1, "x")]
    rows += [(101, 5, "user", "tie b", 1, "x"), (101, 5, "user", "tie a", 1, "x"), (101, 5, "user", "tie a", 1, "x")]
    rows += [(102, 0, "tool\nname\\n", "role with a newline", 1, "x"), (102, None, None, "<|im_start|>", 1, "x")]
    rows += [(None, 1, "assistant", "no conversation", 1, "x")]
    return rows


def expected():
    out = {}
    key = lambda r: tuple((v is not None, v) for v in (r[1], r[2] or "", r[3] or ""))
    for row in sorted(turns(), key=key):
        out.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    return out


@pytest.mark.parametrize("part_bytes", [1, 200, 1 << 24])
def test_read_back(spark, part_bytes):
    template = Template(part_bytes=part_bytes)
    formatted = format_chats(spark.createDataFrame(turns(), SCHEMA), template)
    got = {r["conv_id"]: r for r in read_back(formatted, template).collect()}
    assert got.keys() == expected().keys()
    for conv, wanted in expected().items():
        row = got[conv]
        learned = "".join(text for role, text in wanted if role == "assistant")
        assert row["n_turns"] == len(wanted)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in wanted).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_formatted_text_and_mask(spark):
    rows = [(1, 0, "user", "a<|b"), (1, 1, "assistant", "é<\\|ok")]
    row = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert row["formatted"] == "<|im_start|>user\na<\\|b<|im_end|>\n<|im_start|>assistant\né<\\\\|ok<|im_end|>\n"
    (span,) = row["loss"]
    assert row["formatted"][span["start"] :][: span["length"]] == "é<\\\\|ok"
    assert unescape("é<\\\\|ok") == "é<\\|ok" and unescape_role("a\\nb\\\\n") == "a\nb\\n"


def test_long_conversation_stays_one_part(spark):
    rows = [(1, i, "user", "x" * 100) for i in range(25_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = format_chats(df).collect()
    assert [p["part"] for p in parts] == list(range(len(parts)))
    assert sum(p["formatted"].count("<|im_end|>") for p in parts) == 25_000
    assert read_back(format_chats(df)).first()["n_turns"] == 25_000


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert format_chats(empty).count() == 0 and read_back(format_chats(empty)).count() == 0
