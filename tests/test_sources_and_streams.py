import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lamella.sources import documents as S
from lamella.streaming import series


def test_reads_are_total(spark, tmp_path):
    d = tmp_path / "describe"
    d.mkdir()
    (d / "a.json").write_text('{"b":1,"a":2}')
    (d / "bad.json").write_text("{")
    (d / "_manifest.json").write_text("{}")
    docs = S.read_json(spark, str(d))
    assert {(r.id, r.status) for r in docs.collect()} == {("a", "ok"), ("bad", "invalid_json")}
    assert S.read_json(spark, str(tmp_path / "none")).first()["status"] == "missing_input"
    with pytest.raises(ValueError, match="invalid_json"):
        S.require(docs)
    assert docs.where("id = 'a'").select(S.canonical(F.col("text"))).first()[0] == '{"a":2,"b":1}'
    S.write_documents(docs.where("id = 'a'"), str(tmp_path / "out"), stamp="all")
    back = spark.read.json(str(tmp_path / "out"))
    assert tuple(back.select("id", "tier_scope", "value").first()) == ("a", "all", '{"a":2,"b":1}')
    m = S.manifest(docs.where("id = 'a'"), version="1", at="now").first()
    assert m["count"] == 1 and [r.id for r in S.manifest_ids(docs.where("id = 'a'")).collect()] == ["a"]
    twice = docs.where("status = 'ok'").unionByName(docs.where("status = 'ok'").withColumn("id", F.lit("z")))
    hashes = [S.manifest(x, version="1", at="now").first()["content_hash"] for x in (twice, twice.repartition(5, "id"), twice.where("id = 'a'"))]
    assert hashes[0] == hashes[1] != hashes[2] == m["content_hash"]
    _, integrity = S.load_datasets(spark, str(tmp_path), ["describe"], spark.createDataFrame([("a",), ("x",), ("bad",)], "id string"))
    assert {(r.id, r.status) for r in integrity.collect()} == {("a", "ok"), ("x", "missing"), ("bad", "corrupt")}


def test_prune_and_versions(tmp_path):
    for n in ("a.json", "b.json", "_m.json", "c.txt"):
        (tmp_path / n).write_text("1")
    assert S.prune(str(tmp_path), ["a"]).removed == ["b.json"] and (tmp_path / "b.json").exists()
    S.prune(str(tmp_path), ["a"], dry_run=False)
    assert not (tmp_path / "b.json").exists() and (tmp_path / "_m.json").exists()
    assert S.check_version(None, "ab") == "skip" and S.check_version("AB", "ab") == "ok" and S.check_version("cd", "ab") == "drift"
    with pytest.raises(ValueError):
        S.check_version("zz", "ab")
    assert S.Config("r", now="t").timestamp() == "t" and S.Config("r").out == "r" and S.Config("r", "w").out == "w"


def stream_of(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).write.json(str(tmp_path / "in"))
    return spark.readStream.schema(schema).json(str(tmp_path / "in"))


def drain(spark, df, name, mode):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_windows_on_a_stream_and_a_table(spark, tmp_path):
    t = lambda m: dt.datetime(2025, 1, 1, 0, m)
    rows, schema = [(t(1), "a", 1.0), (t(4), "a", 2.0), (t(6), "a", 4.0), (t(6), "b", None)], "ts timestamp, k string, v double"
    batch = spark.createDataFrame(rows, schema)
    args = {"at": "ts", "by": "k", "value": "v", "length": "5 minutes"}
    want = sorted(map(tuple, series.windowed_totals(batch, **args).collect()), key=str)
    got = drain(spark, series.windowed_totals(stream_of(spark, tmp_path, rows, schema), **args), "totals", "complete")
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 3
    assert {(r.k, r.open, r.close) for r in series.candles(batch, **args).collect()} == {("a", 1.0, 2.0), ("a", 4.0, 4.0), ("b", None, None)}


def test_books(spark, tmp_path):
    rows = [("x", 1, "snapshot", 10.0, 1.0), ("x", 2, "delta", 11.0, 1.0), ("x", 3, "delta", 10.0, 0.0), ("x", 1, "delta", 5.0, 1.0), ("y", 1, "delta", 7.0, 2.0)]
    df = stream_of(spark, tmp_path, rows, "key string, seq long, kind string, price double, size double")
    got = {r.key: (r.seq, r.levels, r.best) for r in drain(spark, series.order_books(df), "books", "update").collect()}
    assert got["x"][0] == 3 and got["y"] == (1, 1, 7.0)
    slots = spark.createDataFrame([("k", "1", 1, 5), ("k", "1", 2, 6), ("k", "2", 3, 7)], "key string, slot string, seq long, v long")
    assert {(r.slot, r.v) for r in series.replace_then_append(slots).collect()} == {("1", 6), ("2", 7)}
