"""Item files by day, and records whose fields change their types."""

import json

from pyspark.sql import functions as F

from tidemill.sources import landed


def test_day_files_in_name_order(spark, tmp_path):
    want = []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "notes"):
        (tmp_path / day / "items").mkdir(parents=True)
        for k, name in enumerate(["0000000000002--b.json", "0000000000001--z_1.json", "0000000000010--a.json"]):
            (tmp_path / day / "items" / name).write_text('{"id": "%d"}' % k if k < 2 else "[1]")
            if day != "notes":
                want.append((day, name, {"0": "0", "1": "1"}.get(str(k))))
        (tmp_path / day / "items" / ".0000000000003--d.json").write_text('{"id": "no"}')
        (tmp_path / day / "items" / "other.json").write_text('{"id": "no"}')
        (tmp_path / day / "0000000000004--beside.json").write_text('{"id": "no"}')
    want = [(d, pos, n, i) for d in sorted({w[0] for w in want}) for pos, (n, i) in enumerate(sorted((w[1], w[2]) for w in want if w[0] == d))]
    got = [(r["day"], r["pos"], r["name"], r["item"]["id"] if r["item"] else None) for r in landed.day_items(spark, str(tmp_path), "id string").orderBy("day", "pos").collect()]
    assert got == want and [x[2] for x in got[:3]] == ["0000000000001--z_1.json", "0000000000002--b.json", "0000000000010--a.json"]
    some = landed.day_items(spark, str(tmp_path), "id string", "2024-01-02", "2024-01-02")
    assert {r["day"] for r in some.collect()} == {"2024-01-02"} and some.count() == 3
    # files of other days are not opened
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        some = landed.day_items(spark, str(tmp_path), "id string", "2024-01-02", "2024-01-02")
        some.collect()
        plan = some._jdf.queryExecution().executedPlan()
        assert plan.collectLeaves().head().metrics().get("numFiles").get().value() == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_stored_items_of_any_type(spark):
    items = [
        {"thread": "t", "from": "a", "to": None, "date": 5, "labels": ["x", 3, None, "y", {"z": 1}], "attachments": [{"name": "f", "mime": "m"}, "no", {"name": 7}, None, []]},
        {"labels": "x", "attachments": {"name": "f"}, "thread": ["t"]}, {}, [1], "text", None, 7,
    ]
    rows = [json.dumps(i) for i in items] + ["{broken", "", None]
    got = [r["s"].asDict(recursive=True) for r in spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string").select("k", landed.stored_item(F.col("x")).alias("s")).orderBy("k").collect()]

    def plain(x):
        try:
            item = json.loads(x)
        except (TypeError, ValueError):
            item = None
        item = item if isinstance(item, dict) else {}
        text = lambda v: v if isinstance(v, str) else None
        listed = lambda v: v if isinstance(v, list) else []
        out = {k: text(item.get(k)) for k in ("thread", "from", "to", "date")}
        return out | {"labels": [v for v in listed(item.get("labels")) if isinstance(v, str)], "attachments": [{"name": text(a.get("name")), "mime": text(a.get("mime"))} for a in listed(item.get("attachments")) if isinstance(a, dict)]}

    assert got == [plain(x) for x in rows]
