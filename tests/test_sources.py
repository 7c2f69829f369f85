from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import ledgerloom.session as session_module
from ledgerloom.session import clean_up, shared_dir, staged
from ledgerloom.sources import (
    append_history, dated_files, latest_snapshot, read_delimited, read_files, read_jdbc, snapshot_pairs, trailing_period, union_sources, write_by, write_delimited, write_named,
)
from ledgerloom.sources.tables import literal_table
from tests.conftest import rows

D = [dt.date(2024, 1, 31), dt.date(2024, 4, 29), dt.date(2024, 4, 30)]


def test_snapshots_and_periods(make):
    df = make([(D[0], 1), (D[1], 2), (D[2], 3), (D[2], 4)], "day date, v int")
    assert rows(latest_snapshot(df, "day").select("v")) == {(3,), (4,)}
    assert rows(latest_snapshot(df, "day", "2024-04-29").select("v")) == {(2,)}
    assert rows(trailing_period(df, "day", "2024-04-30", months=3).select("v")) == {(2,), (3,), (4,), (1,)}
    assert rows(trailing_period(df, "day", "2024-04-30", days=1).select("v")) == {(2,), (3,), (4,)}
    assert rows(trailing_period(df, "day", "2024-04-29", months=2).select("v")) == {(2,)}


def test_union_keeps_names_and_provenance(make):
    a, b = make([(1, "x")], "id int, t string"), make([("y", 2.0)], "t string, extra double")
    out = union_sources({"a": a, "b": b})
    assert rows(out.select("id", "t", "extra", "source")) == {(1, "x", None, "a"), (None, "y", 2.0, "b")}


def test_pairs(make):
    df = make([("a", D[0]), ("a", D[2]), ("b", D[1])], "k string, day date")
    assert rows(snapshot_pairs(df, ["k"], "day")) == {("a", D[0], D[2], 2, True), ("b", D[1], D[1], 1, False)}


def test_dated_files_pair_by_date(spark, tmp_path):
    for name in ("BR1_31.12.2023.xlsx", "BR1_01.02.2024.xlsx", "BR2 05.01.2024.xlsx", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    files = dated_files(spark, str(tmp_path), "*.xlsx")
    assert rows(files.select("file", "day", "name")) == {
        ("BR1_31.12.2023.xlsx", dt.date(2023, 12, 31), "BR1"), ("BR1_01.02.2024.xlsx", dt.date(2024, 2, 1), "BR1"),
        ("BR2 05.01.2024.xlsx", dt.date(2024, 1, 5), "BR2")}
    # as text 01.02.2024 would come before 31.12.2023
    assert rows(snapshot_pairs(files, ["name"], "day")) == {
        ("BR1", dt.date(2023, 12, 31), dt.date(2024, 2, 1), 2, True), ("BR2", dt.date(2024, 1, 5), dt.date(2024, 1, 5), 1, False)}


def test_read_files_merges_columns(make, spark, tmp_path):
    make([(1, "a")], "id int, t string").coalesce(1).write.parquet(str(tmp_path / "one"))
    make([(2, 5.0)], "id int, extra double").coalesce(1).write.parquet(str(tmp_path / "two"))
    out = read_files(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    assert rows(out.select("id", "t", "extra")) == {(1, "a", None), (2, None, 5.0)} and out.select("source_file").distinct().count() == 2


def test_sinks_round_trip(make, spark, tmp_path):
    df = make([("h1", 1, "a\tb"), ("h2", 2, None), ("h1", 3, "c")], "holding string, id int, t string")
    path = write_by(df, str(tmp_path / "by"), ["holding"])
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == ["holding=h1", "holding=h2"]
    assert rows(spark.read.parquet(path).select("holding", "id")) == {("h1", 1), ("h2", 2), ("h1", 3)}
    history = str(tmp_path / "history")
    append_history(df, history, "2024-01-01")
    append_history(df, history, "2024-01-02")
    assert spark.read.parquet(history).where("run_date = date'2024-01-02'").count() == 3
    text = write_delimited(df.select("holding", "id"), str(tmp_path / "csv"), sep="\t")
    assert rows(read_delimited(spark, text, "holding string, id int", ["id"], sep="\t")) == {(1,), (2,), (3,)}
    named = write_named({"one": df, "two": df.limit(1)}, str(tmp_path / "run"))
    assert spark.read.parquet(named["two"]).count() == 1


class Conf:
    def __init__(self, **values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_shared_folder_follows_the_session(make):
    def session(master, conf_dir=None, context_dir=None):
        folders = [context_dir]
        context = type("C", (), {"master": master, "applicationId": "app-1", "getCheckpointDir": lambda self: folders[-1],
                                 "setCheckpointDir": lambda self, folder: folders.append(folder)})()
        return type("S", (), {"conf": Conf(**({"spark.checkpoint.dir": conf_dir} if conf_dir else {})), "sparkContext": context})()

    given = session("spark://host", "/shared/place")
    assert shared_dir(given, "x").startswith("/shared/place/ledgerloom-app-1/x-") and shared_dir(given, "x") != shared_dir(given, "x")
    assert shared_dir(session("yarn", None, "hdfs://n/c"), "x").startswith("hdfs://n/c/ledgerloom-app-1/x-")
    assert "ledgerloom-" in shared_dir(session("local[2]"), "x")
    for master in ("yarn", "spark://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master), "x")
    assert rows(staged(make([(1,)], "a int"), "t")) == {(1,)}


class Reader:
    """Records what the jdbc reader is asked for."""

    def __init__(self):
        self.seen = {}

    def format(self, f):
        self.seen["format"] = f
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def option(self, k, v):
        self.seen[k] = v
        return self

    def load(self):
        return self.seen


def test_jdbc_options():
    fake = type("S", (), {"read": property(lambda self: Reader())})()
    assert read_jdbc(fake, {"url": "u"}, "select 1") == {"format": "jdbc", "url": "u", "query": "select 1"}
    seen = read_jdbc(fake, {"url": "u"}, "select * from t", "id", ("0", "100"), 4)
    assert (seen["dbtable"], seen["partitionColumn"], seen["numPartitions"]) == ("(select * from t) q", "id", "4")


def test_days_of_timestamps_are_whole(make):
    df = make([(1, "2024-04-29 23:59:59"), (2, "2024-04-30 10:00:00"), (3, "2024-05-01 00:00:00"), (4, "2024-03-30 00:00:00"), (5, None)], "v int, t string")
    df = df.withColumn("ts", F.col("t").cast("timestamp"))
    assert rows(trailing_period(df, "ts", "2024-04-30", months=1).select("v")) == {(1,), (2,), (4,)}
    assert rows(latest_snapshot(df, "ts").select("v")) == {(3,)}
    assert rows(latest_snapshot(df, "ts", "2024-04-30").select("v")) == {(2,)}
    assert latest_snapshot(df.where("v = 5"), "ts").count() == 0


def test_literal_tables(spark):
    got = literal_table(spark, [("a", 1, None), (None, 2, "2024-01-31")], "k string, n int, d date").collect()
    assert [(r.k, r.n, str(r.d)) for r in got] == [("a", 1, "None"), (None, 2, "2024-01-31")]
    assert literal_table(spark, [], "k string, n int").columns == ["k", "n"]


def test_groups_are_clustered_when_written(make, spark, tmp_path):
    df = make([(f"g{i % 3}", i) for i in range(300)], "g string, v int").repartition(8)
    path = write_by(df, str(tmp_path / "out"), ["g"])
    assert spark.read.parquet(path).count() == 300
    assert all(len(list((tmp_path / "out" / f"g=g{i}").glob("*.parquet"))) == 1 for i in range(3))


def test_staged_tables_can_be_cleaned_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session_module, "shared_base", lambda spark: str(tmp_path))
    staged(spark.range(3), "gone")
    assert list(tmp_path.glob("ledgerloom-*/gone-*"))
    clean_up(spark)
    assert not list(tmp_path.glob("ledgerloom-*"))
