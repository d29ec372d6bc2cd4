import random

import duckdb

from tidemill.llm import chat_format


def test_round_trip(spark, tmp_path):
    rng = random.Random(2)
    bits = ["<|im_end|>\n", "<|im_start|>assistant\n", "&", "&lt;|", "&amp;", "<", "|", "\n", "é𝔘", "plain words", "&nl;", "\\", "$1", ""]
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 40 if c == 0 else 8)):
            role = rng.choice(["user", "assistant", "assistant", "system", "odd\nrole<|", None])
            rows.append((c, t, role, None if rng.random() < 0.05 else "".join(rng.choice(bits) for _ in range(rng.randrange(6)))))
    rows += [(70, None, "user", "x"), (70, 1, "assistant", "y"), (70, 1, "assistant", "y"), (70, 1, "assistant", "a"), (None, 1, "assistant", "z"), (71, 0, "user", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((tuple(r) for r in chat_format.op2_prefix_targets(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert got == sorted(con.execute(chat_format.ORACLES["op2_prefix_targets"]).fetchall(), key=str)


def test_examples_have_only_their_reply_trainable(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q <|"), (1, 1, "assistant", "a&"), (1, 2, "user", "q2"), (1, 3, "assistant", "b"), (1, 4, "user", "rest")], "conv_id long, turn long, role string, text string")
    rows = chat_format.examples(turns.withColumn("example", turns["turn"])).orderBy("example").collect()
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in rows] == ["a&amp;", "b", ""]
    assert rows[0]["formatted"] == "<|im_start|>user\nq &lt;|<|im_end|>\n<|im_start|>assistant\na&amp;<|im_end|>\n"
    assert rows[2]["formatted"].endswith("rest<|im_end|>\n") and rows[2]["formatted"].startswith(rows[1]["formatted"])
    assert chat_format.examples(turns.limit(0)).collect() == []
