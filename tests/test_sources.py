from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywake.functions.filters import is_page, not_equal
from tallywake.functions.times import from_epoch, next_midnight, window_start, window_start_epoch
from tallywake.plans import jobs
from tallywake.schemas import LOGIN, MARKET, ORDER, USER_BEHAVIOR
from tallywake.sources.lines import decode_access_log, decode_records, encode_records, read_lines
from tallywake.sources.topics import consumer_options


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_records_by_position(spark):
    rows = decode_records(lines(spark, "34729,create,,1558430842", "34729,pay,sd76,1558430844,more,fields"), ORDER).collect()
    assert [tuple(r)[:4] for r in rows] == [(34729, "create", None, 1558430842), (34729, "pay", "sd76", 1558430844)]
    assert rows[0]["ts"] == datetime(2019, 5, 21, 9, 27, 22)
    ms = decode_records(lines(spark, "u-1,CLICK,wechat,1558430842123"), MARKET).first()
    assert ms["ts"] == datetime(2019, 5, 21, 9, 27, 22, 123000)


@pytest.mark.parametrize("bad", ["12,1.1.1.1,fail", "x,1.1.1.1,fail,1558430842", "12,1.1.1.1,fail,soon", ""])
def test_bad_records(spark, bad):
    df = lines(spark, "12,1.1.1.1,fail,1558430842", bad)
    with pytest.raises(PySparkException, match="malformed line"):
        decode_records(df, LOGIN).select("ip").where("ip = 'none'").collect()
    assert decode_records(df, LOGIN, "DROPMALFORMED").count() == 1
    assert decode_records(df, LOGIN, "PERMISSIVE").count() == 2


def test_access_log(spark, tmp_path):
    good = '83.149.9.216 - frank 17/05/2015:10:05:03 +0000 GET /presentations/a.png?x=1 extra'
    (tmp_path / "access.log").write_text(good + "\n83.149.9.216 - - 17/May/2015 +0000 GET /\nshort line\n")
    df = read_lines(spark, str(tmp_path / "access.log"))
    got = decode_access_log(df, "DROPMALFORMED").collect()
    assert [tuple(r) for r in got] == [
        ("83.149.9.216", "frank", datetime(2015, 5, 17, 10, 5, 3), "GET", "/presentations/a.png?x=1")]
    assert decode_access_log(df, "PERMISSIVE").count() == 3
    with pytest.raises(PySparkException, match="malformed line"):
        decode_access_log(df).collect()


def test_later_filters_stay_above_the_parsing(spark, capsys):
    df = decode_access_log(lines(spark, "a - b 17/05/2015:10:05:03 +0000 GET /")).where("method = 'GET'")
    df.explain()
    plan = capsys.readouterr().out
    assert plan.index("Filter") < plan.index("Generate") and plan.count("split(") == 1


def test_round_trip_of_lines(spark):
    df = lines(spark, "1,2,3,pv,1511658000", "4,5,6,buy,1511658001")
    names = ["user_id", "item_id", "category_id", "behavior", "timestamp"]
    assert encode_records(decode_records(df, USER_BEHAVIOR), names).collect() == df.collect()


def test_topic_options():
    options = consumer_options("host:9092", "clicks", "readers")
    assert options["subscribe"] == "clicks" and options["startingOffsets"] == "latest"
    assert options["kafka.group.id"] == "readers" and "maxOffsetsPerTrigger" not in options


def test_page_filter(spark):
    urls = {"/a": True, "/a.css": False, "/b.js": False, "/c.png": False, "/a.css?v=1": True, "/C.PNG": True,
            "/css": True, "/x.csss": True, "": True}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"] for r in df.where(is_page("url")).collect()} == {u for u, keep in urls.items() if keep}
    asked = df.select("url", F.lit("POST").alias("method")).unionByName(df.select("url", F.lit("GET").alias("method")))
    assert jobs.page_requests(asked).count() == sum(urls.values())


def test_uninstall_filter(spark):
    df = spark.createDataFrame([("UNINSTALL",), ("uninstall",), ("CLICK",)], "behavior string")
    assert df.where(not_equal("behavior", "uninstall")).count() == 1
    assert df.where(not_equal("behavior", "uninstall", ignore_case=False)).count() == 2


def test_window_arithmetic(spark):
    row = spark.range(1).select(
        from_epoch(F.lit(1547718199), "s").alias("ts")).select(
        window_start("ts", "15 seconds").alias("plain"), window_start("ts", "1 hour", "15 minutes").alias("shifted"),
        next_midnight("ts").alias("midnight"), window_start(F.lit(None).cast("timestamp"), "1 hour").alias("none"),
        window_start_epoch(F.lit(1547718199000), 0, 15000).alias("epoch")).first()
    assert row["plain"] == datetime(2019, 1, 17, 9, 43, 15) and row["shifted"] == datetime(2019, 1, 17, 9, 15)
    assert row["midnight"] == datetime(2019, 1, 18) and row["none"] is None and row["epoch"] == 1547718195000
