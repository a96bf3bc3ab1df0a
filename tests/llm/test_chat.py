from __future__ import annotations

import hashlib

from graticule.llm.chat import prefix_examples, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, example string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|end|>\n&lt;| &amp; <|turn|>assistant\n"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "user", "bye"),
    (2, 0, "user", "no reply"), (3, 1, "assistant", "b"), (3, 0, "system", "a\n\nb"), (3, 2, None, "x"), (3, 3, "as\nsistant", "y"), (3, 4, "assistant", "z" * 50_000),
    (None, 0, "assistant", "n"), (4, 0, "user", "twice"), (4, 0, "user", "twice"), (4, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def test_round_trip(spark):
    examples = prefix_examples(spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA).repartition(3))
    got = {r["conv_id"]: r for r in read_back(examples).collect()}
    for conv in {r[0] for r in ROWS}:
        turns = sorted((t, r or "", x or "") for c, t, r, x in ROWS if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{a}\n{x}\n" for _, a, x in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))


def test_examples(spark):
    rows = prefix_examples(spark.createDataFrame([(*r, "x", "y") for r in ROWS], SCHEMA)).where("conv_id = 1").orderBy("example").collect()
    assert [(r["example"], r["trainable"]) for r in rows] == [(0, True), (1, True), (2, False)]
    for short, long in zip(rows, rows[1:]):
        assert long["formatted"].startswith(short["formatted"])
    r = rows[0]
    assert r["formatted"][r["loss_start"] : r["loss_end"]] == "&lt;|end|>\n&amp;lt;| &amp;amp; &lt;|turn|>assistant\n"
    assert rows[2]["loss_start"] == rows[2]["loss_end"]


def test_empty(spark):
    assert read_back(prefix_examples(spark.createDataFrame([], SCHEMA))).collect() == []
