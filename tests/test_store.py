import datetime as dt
import tempfile

from pyspark.sql import functions as F

from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, TimestampNTZType

from ledgerline.operators import staging
from ledgerline.sources import raw
from ledgerline.sources.merging import newer_than, sync_columns, upsert, widest
from ledgerline.sources.store import TableStore


def test_upsert_replaces_matched_and_inserts_new(spark):
    tgt = spark.createDataFrame([("1", 10), ("2", 20)], "k string, v int")
    upd = spark.createDataFrame([("2", 21, "x"), ("3", 30, "y")], "k string, v int, extra string")
    got = sorted(tuple(r) for r in upsert(tgt, upd, ["k"]).collect())
    assert got == [("1", 10, None), ("2", 21, "x"), ("3", 30, "y")]          # schema follows the update


def test_newer_than_high_water_mark(spark):
    ts = [dt.datetime(2001, 1, d) for d in (1, 2, 3)]
    src = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id int, _loaded_at timestamp_ntz")
    tgt = src.filter(F.col("id") < 2)
    assert [r.id for r in newer_than(src, tgt).collect()] == [2]
    empty = src.filter(F.lit(False))
    assert newer_than(src, empty).count() == 3                              # empty target: full load


def test_sync_columns_adds_and_drops(spark):
    tgt = spark.createDataFrame([("1", "old")], "k string, gone string")
    upd = spark.createDataFrame([("2", 5)], "k string, added int")
    assert sync_columns(tgt, upd).columns == ["k", "added"]


def test_updates_are_reduced_to_the_latest_row_per_key(spark):
    tgt = spark.createDataFrame([("1", 10, 1)], "k string, v int, _loaded_at int")
    upd = spark.createDataFrame([("1", 20, 3), ("1", 30, 2), ("2", 5, 1), ("2", 6, 1)], "k string, v int, _loaded_at int")
    assert sorted(tuple(r) for r in upsert(tgt, upd, ["k"]).collect()) == [("1", 20, 3), ("2", 6, 1)]


def test_the_mark_is_a_plain_filter(spark):
    src = spark.range(10).withColumn("_loaded_at", F.timestamp_seconds("id"))
    plan = newer_than(src, dt.datetime(1970, 1, 1, 0, 0, 5))._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and "OR" not in plan


def scanned(df):
    """Rows that the scans of an executed frame read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    stack, rows = [plan], 0
    while stack:
        p = stack.pop()
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            rows += p.metrics().apply("numOutputRows").value()
        for i in range(p.children().size()):
            stack.append(p.children().apply(i))
        if "QueryStage" in p.getClass().getSimpleName():
            stack.append(p.plan())
    return rows


def test_the_mark_skips_landed_row_groups(spark):
    """Two deliveries, staged behind the first one's mark: the scan reads the second."""
    path = tempfile.mkdtemp(prefix="ll-land-") + "/events"
    one = dt.datetime(2001, 1, 1)
    rows = spark.range(100_000).select(
        F.col("id").alias("event_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in raw.RAW_SCHEMAS["events"].fields[1:-1]],
        (F.lit(one).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("_loaded_at"))
    raw.land(rows.where("event_id < 90000"), path, files=2, group_bytes=50_000)
    raw.land(rows.where("event_id >= 90000"), path, files=1, group_bytes=50_000)
    mark = one + dt.timedelta(seconds=89_999)
    staged = staging.stg_events(newer_than(raw.read_landed(spark, path, "events"), mark))
    assert staged.count() == 10_000
    assert scanned(staged) < 30_000
    assert staged.schema["_loaded_at"].dataType == TimestampNTZType()


def test_landing_needs_prunable_times(spark):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        raw.land(spark.range(1).withColumn("_loaded_at", F.current_timestamp()), "/nowhere")
        raise AssertionError("landed")
    except ValueError:
        pass
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def test_widest_types():
    cases = [(IntegerType(), LongType(), LongType()), (DecimalType(10, 2), DecimalType(12, 4), DecimalType(12, 4)),
             (DecimalType(10, 2), DecimalType(6, 4), DecimalType(12, 4)), (IntegerType(), DecimalType(5, 2), DecimalType(12, 2)),
             (LongType(), DoubleType(), DoubleType()), (DateType(), TimestampNTZType(), TimestampNTZType()), (IntegerType(), StringType(), StringType()),
             (DecimalType(38, 0), DecimalType(20, 10), DecimalType(38, 10)), (DateType(), LongType(), StringType())]
    for a, b, c in cases:
        assert widest(a, b) == widest(b, a) == c


def store_at(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="ll-store-") + "/wh")


def rows_of(store, table="f", layer="facts"):
    return sorted((tuple(r) for r in store.read(layer, table).collect()), key=str)


def test_write_append_and_marks(spark):
    store = store_at(spark)
    assert store.read("facts", "t") is None and store.mark("facts", "t") is None
    store.write("facts", "t", spark.createDataFrame([("1", 1)], "k string, v int"))
    store.append("facts", "t", spark.createDataFrame([("2", 3)], "k string, v int"))
    assert rows_of(store, "t") == [("1", 1), ("2", 3)]
    store.write("facts", "t", spark.createDataFrame([("9", 9)], "k string, v int"))
    assert rows_of(store, "t") == [("9", 9)]
    for day in (3, 1, 2):
        store.set_mark("facts", "t", dt.datetime(2001, 1, day))
    store.set_mark("facts", "t", None)
    assert store.mark("facts", "t") == dt.datetime(2001, 1, 3)


JAN, FEB, MAR = dt.date(2001, 1, 1), dt.date(2001, 2, 1), dt.date(2001, 3, 1)
SCHEMA = "k string, v int, month date, _loaded_at timestamp_ntz"
T = [dt.datetime(2001, 1, d) for d in range(1, 9)]


def merged(spark, store, rows, schema=SCHEMA):
    store.merge("facts", "f", spark.createDataFrame(rows, schema), ["k"], ["month"])
    return rows_of(store)


def files(store):
    return set(store.read("facts", "f").inputFiles())


def test_merge_rewrites_touched_partitions_only(spark):
    store = store_at(spark)
    merged(spark, store, [("a", 1, JAN, T[0]), ("b", 2, FEB, T[0]), ("c", 3, None, T[0])])
    before = files(store)
    got = merged(spark, store, [("b", 20, FEB, T[1]), ("d", 4, FEB, T[2]), ("d", 5, FEB, T[1])])
    assert [r[:2] for r in got] == [("a", 1), ("b", 20), ("c", 3), ("d", 4)] and store.mark("facts", "f") == T[2]
    assert len(before & files(store)) == 2
    got = merged(spark, store, [("e", 6, None, T[3])])
    assert [r[:2] for r in got] == [("a", 1), ("b", 20), ("c", 3), ("d", 4), ("e", 6)]


def test_empty_increments_change_nothing(spark):
    store = store_at(spark)
    store.merge("facts", "f", spark.createDataFrame([], SCHEMA), ["k"], ["month"])
    assert store.read("facts", "f") is None and store.mark("facts", "f") is None
    merged(spark, store, [("a", 1, JAN, T[0])])
    before = files(store)
    assert [r[:2] for r in merged(spark, store, [])] == [("a", 1)] and files(store) == before and store.mark("facts", "f") == T[0]


def test_merge_takes_other_columns_and_types(spark):
    store = store_at(spark)
    merged(spark, store, [("k1", 1, JAN, T[0]), ("k2", 2, FEB, T[0])])
    got = merged(spark, store, [("k2", 1 << 40, FEB, "w")], "k string, v long, month date, w string")
    assert sorted(map(str, got)) == sorted(map(str, [("k1", 1, None, JAN), ("k2", 1 << 40, "w", FEB)]))
    got = merged(spark, store, [("k3", "text", FEB, "w")], "k string, v string, month date, w string")
    assert {r[0]: r[1] for r in got} == {"k1": "1", "k2": str(1 << 40), "k3": "text"}
    got = merged(spark, store, [("k1", 7, JAN, "w")], "k string, v int, month date, w string")      # a number where text is stored
    assert {r[0]: r[1] for r in got} == {"k1": "7", "k2": str(1 << 40), "k3": "text"}


def test_a_lost_overwrite_is_done_again(spark, monkeypatch):
    """Lost before anything is replaced, or after: the next change starts from the whole staged copy."""
    for lost_after in (False, True):
        store = store_at(spark)
        merged(spark, store, [("k1", 1, JAN, T[0]), ("k2", 2, FEB, T[1])])
        save = TableStore._save

        def lose(self, layer, table, df, partition_by, mode, whole=True):
            if not whole:
                if lost_after:
                    save(self, layer, table, df, partition_by, mode, whole)
                raise OSError("lost")
            save(self, layer, table, df, partition_by, mode, whole)
        with monkeypatch.context() as m:
            m.setattr(TableStore, "_save", lose)
            try:
                merged(spark, store, [("k1", 9, JAN, T[2]), ("k4", 4, JAN, T[2])])
                raise AssertionError("not lost")
            except OSError:
                pass
        assert store.mark("facts", "f") == T[1]
        got = merged(spark, store, [("k1", 9, JAN, T[2]), ("k4", 4, JAN, T[2])])         # the same increment again
        assert [r[:2] for r in got] == [("k1", 9), ("k2", 2), ("k4", 4)] and store.mark("facts", "f") == T[2]
