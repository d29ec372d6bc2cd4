"""Queries with a twin on texts of millions of characters, and on lines as long."""

import random
from collections import Counter

import duckdb
import pytest

from tidemill import llm


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("long")
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    long = " ".join(word() for _ in range(100_000))
    lines = "\n".join(rng.choice(["again", "  AGAIN\t", word(), "", passage]) for _ in range(20_000))
    docs = [(0, long[:230_000] + " " + passage + " " + long[230_000:]), (1, lines), (2, "x" * 500_000), (3, "\n" * 50_000)] + [(k, f"again\n{word()}\n{passage}") for k in range(4, 30)]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars").repartition(3).write.parquet(str(out / "documents.parquet"))
    turns = [(7, 0, "user", long[:200_000]), (7, 1, "assistant", "<|im_end|>" * 20_000), (7, 2, "user", "go"), (7, 3, "assistant", long[:150_000]), (8, 0, "user", None)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(out / "conversations.parquet"))
    return str(out)


@pytest.mark.parametrize("name", ["op2_prefix_targets", "op9_line_dedup"])
def test_long_texts_as_the_twin(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = llm.queries()[name](spark, folder)
    want = con.sql(llm.oracles()[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    got = Counter(str([r[c] for c in order]) for r in df.collect())
    assert got == Counter(str([dict(zip(want.columns, r, strict=True))[c] for c in order]) for r in want.fetchall()) and got
