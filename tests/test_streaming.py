"""Latest rows of a stream: batches, restarts, late rows, expiry, rows without a key."""

import datetime

from pyspark.sql import functions as F

from lotwise.operators import lookup
from lotwise.streaming import ingest, latest

SCHEMA = "k int, v string, t timestamp, n int"


def at(day, hour=0):
    return datetime.datetime(2024, 1, day, hour)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, mark, **options):
    stream = latest.latest_changes(ingest.new_files(spark, folder, SCHEMA, per_run=1), ["k"], ["t", "n"], **options)
    query = stream.writeStream.option("checkpointLocation", mark).trigger(availableNow=True).outputMode("update").foreachBatch(latest.changes_to(out)).start()
    query.awaitTermination()
    return query


def test_batches_and_restarts_equal_the_batch_twin(spark, tmp_path):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    first = [(1, "a", at(1), 1), (2, "b", at(1), 1), (1, "c", at(3), 1), (None, "x", at(9), 1), (3, "d", None, 1)]
    second = [(1, "late", at(2), 9), (2, "e", at(5), 1), (3, "f", at(1), 1), (4, "g", None, None), (2, "tie", at(5), 1)]
    third = [(5, "h", at(7), 1), (1, "i", at(3), 2), (4, "j", None, 3)]
    feed(spark, folder, first)
    run(spark, folder, out, mark)
    feed(spark, folder, second)
    feed(spark, folder, third)
    run(spark, folder, out, mark)  # a new query takes up the state and the files that it hasn't seen
    changes = spark.read.parquet(out)
    got = sorted(map(tuple, latest.folded(changes, ["k"], ["t", "n"]).collect()))
    rows = spark.createDataFrame(first + second + third, SCHEMA).where("k is not null")
    twin = lookup.latest(rows.where("v <> 'tie'"), "k", [F.desc_nulls_last("t"), F.desc_nulls_last("n")])
    assert got == sorted(map(tuple, twin.collect()))
    assert changes.where("v in ('late', 'tie', 'x')").count() == 0 and changes.where("k = 1").count() == 2
    before = changes.count()
    run(spark, folder, out, mark)
    assert spark.read.parquet(out).count() == before
    assert latest.keyless(spark.createDataFrame(first, SCHEMA), ["k"]).count() == 1
    table = latest.compacted(spark, out, str(tmp_path / "table"), ["k"], ["t", "n"])
    assert sorted(map(tuple, table.collect())) == got


def test_state_goes_with_the_watermark(spark, tmp_path):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    options = {"time": "t", "late": "1 day", "keep_days": 2.0}
    for rows in ([(1, "a", at(1), 1), (2, "b", at(9), 1)], [(2, "c", at(20), 1)], [(2, "d", at(21), 1)], [(1, "old again", at(21), 0), (2, "e", at(20), 9)]):
        feed(spark, folder, rows)
        query = run(spark, folder, out, mark, **options)
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    changes = spark.read.parquet(out)
    assert [r["v"] for r in changes.where("k = 1").orderBy("t").collect()] == ["a", "old again"]
    assert {r["v"] for r in latest.folded(changes, ["k"], ["t", "n"]).collect()} == {"old again", "d"}
    assert kept <= 4  # a row and a timer for each of two keys
