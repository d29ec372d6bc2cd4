import hashlib
import re

import duckdb

from tidemill import catalogue


def ran(spark, folder, name, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return [tuple(r)[1:] for r in catalogue.queries()[name](spark, str(folder)).orderBy("doc_id").collect()]


def test_stored_bodies(spark, tmp_path):
    texts = ["é" * 1000, "é𝔘" * 700, "b" * 50_000, "c" * 50_001]
    assert ran(spark, tmp_path, "stored_bodies", texts) == [(hashlib.sha1(t[:50_000].encode()).hexdigest(), len(t) > 50_000) for t in texts]


def test_title_strip_suffix(spark, tmp_path):
    texts = ["long " * 20 + "title. rest", ". " + "x" * 90, "no suffix " * 9, "short. rest"]
    assert ran(spark, tmp_path, "title_strip_suffix", texts) == [("long " * 20 + "title",), (texts[1],), (texts[2].strip(),), ("short",)]


def test_unblocked_line(spark, tmp_path):
    texts = ["# " + "x" * 200, "y" * 200, " " * 90 + "- z"]
    assert ran(spark, tmp_path, "unblocked_line", texts) == [("\\" + texts[0],), (texts[1],), ("\\" + texts[2],)]


def test_tag_normalise(spark, tmp_path):
    texts = [" ".join(f"Tag_{k % 70} -A/b{k}-" for k in range(150)), "one One"]
    tag = lambda w: re.sub("^[-/]+|[-/]+$", "", re.sub("-*/-*", "/", re.sub("[^a-z0-9/]+", "-", w.lower())))
    assert ran(spark, tmp_path, "tag_normalise", texts) == [(" ".join(dict.fromkeys(tag(w) for w in t.split(" "))),) for t in texts]


def test_tag_normalise_of_odd_rows_is_its_sql(spark, tmp_path):
    rows = [(1, "aİb İstanbul K\u212a"), (2, ""), (3, None), (4, "é -- !"), (5, "/ a/b A-/-b"), (6, "one two one"), (6, "one two one"), (7, "x"), (7, None), (None, "null id"), (8, "a  b\nc ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = duckdb.sql(catalogue.oracles()["tag_normalise"].replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")).fetchall()
    assert sorted(map(tuple, catalogue.queries()["tag_normalise"](spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)


def test_link_facts(spark, tmp_path):
    texts = ["a title of under eighty characters with what has been cut after sixty", "x" * 74]
    assert [r[0] for r in ran(spark, tmp_path, "link_facts", texts)] == [texts[0], None]
