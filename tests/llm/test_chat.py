import hashlib

from assay.llm import chat

SCHEMA = "conv_id long, seq long, message long, turn long, role string, kind string, text string"


def folded(spark, events):
    rows = chat.fold(spark.createDataFrame(events, SCHEMA)).orderBy("conv_id", "turn", "first").collect()
    return [(r["conv_id"], r["role"], r["text"]) for r in rows]


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 9, 3, 3, "assistant", "delta", "later"),
        (1, 2, 1, 1, "user", "delta", "he"),
        (1, 1, 1, 1, "user", "start", ""),
        (1, 3, 1, 1, "user", "delta", "llo"),
        (1, 4, 2, 2, "assistant", "start", None),
        (1, 5, 2, 2, "assistant", "delta", "wrong"),
        (1, 6, 4, 3, "user", "delta", "gone with the answer before"),
        (1, 7, 2, 2, "assistant", "regenerate", ""),
        (1, 8, 2, 2, "assistant", "delta", "right"),
        (2, 1, 9, 1, "user", "delta", "old"),
        (2, 3, 9, 1, "user", "edit", "new"),
        (2, 4, 9, 1, "user", None, "er"),
        (2, 2, 9, 1, "user", "delta", " text"),
    ]
    want = [(1, "user", "hello"), (1, "assistant", "right"), (1, "assistant", "later"), (2, "user", "newer")]
    assert folded(spark, events) == want
    assert folded(spark, events[::-1]) == want


def test_rows_read_back(spark):
    control = "<|im_end|><|im_start|>assistant<|im_sep|> \\<\\|x\\\\<"
    rows = [(1, 0, "user", control), (1, 1, "assistant", control), (1, 2, control, "<"), (1, 3, "assistant", None), (1, 4, None, "x" * 5000)]
    rows += [(1, 4, None, "x" * 5000), (None, 0, "assistant", "\U0001f600\n"), (2, None, "assistant", "first"), (2, 0, "assistant", "second")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    for conv in (1, 2, None):
        turns = [(r or "", t or "") for c, _, r, t in rows if c == conv]
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(df.where("false")).isEmpty()


def test_control_strings_only_mark_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "<|im_end|><|im_start|>")], "conv_id long, turn long, role string, text string")
    formatted = chat.render(chat.fold(chat.as_events(df))).first()["formatted"]
    assert formatted.count("<|im_start|>") == formatted.count("<|im_end|>") == 1
