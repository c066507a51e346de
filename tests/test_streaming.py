import datetime as dt
import json

from pyspark.sql import functions as F

from adfeat.streaming import events as stream

APPS = ("app",)


def message(**change):
    item = {"ad_package_name": "x", "campaign_id": 4, "c_id": 3}
    m = {"sub_pf": "cpi", "event_name": "AD_CpiShow", "package_name": "app", "pos_id": "p", "beyla_id": "u", "params": [item]}
    m.update(change)
    return json.dumps({"message": json.dumps({k: v for k, v in m.items() if v is not ...})})


def item(**change):
    return {k: v for k, v in {"ad_package_name": "x", "campaign_id": 4, "c_id": 3, **change}.items() if v is not ...}


KEPT = [message(), message(pos_id=...), message(event_name="AD_CpiClick", params=[item(), item(campaign_id="77"), item(c_id=0)])]
DROPPED = [
    "{broken", "{}", json.dumps({"message": "{broken"}), json.dumps({"message": 5}), message(sub_pf="web"), message(sub_pf=...),
    message(event_name="AD_Other"), message(package_name="other"), message(beyla_id=""), message(beyla_id=...), message(beyla_id=None),
    message(params=...), message(params=[]), message(params=[item(ad_package_name=""), item(ad_package_name=...)]),
    message(params=[item(campaign_id=0), item(campaign_id=...), item(c_id=...)]),
]


def test_guards(spark):
    raw = spark.createDataFrame([(v,) for v in KEPT + DROPPED], "value string")
    got = sorted(tuple(r) for r in stream.decode_events(raw, APPS).collect())
    assert got == [
        ("AD_CpiClick", "u", "app", "p", "x", "4", "3"), ("AD_CpiClick", "u", "app", "p", "x", "77", "3"),
        ("AD_CpiShow", "u", "app", "", "x", "4", "3"), ("AD_CpiShow", "u", "app", "p", "x", "4", "3"),
    ]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    spark.createDataFrame([(v,) for v in KEPT + DROPPED], "value string").repartition(3).write.text(src)

    def run():
        events = stream.decode_events(spark.readStream.text(src), APPS)
        query = stream.write_buckets(events, out, ckpt, once=True)
        query.awaitTermination()
        return spark.read.text(out)

    first = run()
    batch = stream.decode_events(spark.read.text(src), APPS)
    want = sorted("\t".join(r) for r in batch.collect())
    assert sorted(r.value for r in first.collect()) == want
    buckets = {str(r.bucket) for r in first.select("bucket").distinct().collect()}
    assert all(len(b) == 12 and int(b) % 5 == 0 for b in buckets)
    assert sorted(r.value for r in run().collect()) == want
    spark.createDataFrame([(KEPT[0],)], "value string").write.mode("append").text(src)
    assert run().count() == len(want) + 1


def test_bucket(spark):
    ts = F.lit("2024-01-31 23:59:59").cast("timestamp")
    assert spark.range(1).select(stream.bucket_of(ts).alias("b")).first().b == "202401312355"


def test_rolling_counts(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=37 * i), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "ts timestamp, k int")
    got = {(r.window_end, r.k): r.n for r in stream.rolling_day_counts(df, ["k"]).collect()}
    want = {}
    for t, k in rows:
        hour = t.replace(minute=0)
        for h in range(1, 25):
            key = (hour + dt.timedelta(hours=h), k)
            want[key] = want.get(key, 0) + 1
    assert got == want

    src = str(tmp_path / "events")
    df.write.parquet(src)
    late = spark.createDataFrame([(start + dt.timedelta(days=30), 9)], df.schema)  # moves the watermark past all windows
    source = spark.readStream.schema(df.schema).parquet(src)
    query = (
        stream.rolling_day_counts(source, ["k"], late="1 hour").writeStream.outputMode("append").format("memory")
        .queryName("rolling").option("checkpointLocation", str(tmp_path / "ckpt")).start()
    )
    try:
        query.processAllAvailable()
        late.write.mode("append").parquet(src)
        query.processAllAvailable()
        final = {(r.window_end, r.k): r.n for r in spark.table("rolling").collect()}
        # chained windows emit once both watermarks have passed
        late.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).write.mode("append").parquet(src)
        query.processAllAvailable()
        final = {(r.window_end, r.k): r.n for r in spark.table("rolling").collect()}
    finally:
        query.stop()
    assert {k: v for k, v in final.items() if k[1] != 9} == want


def test_a_flush_that_is_replayed_repeats_nothing(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    spark.createDataFrame([(v,) for v in KEPT], "value string").write.text(src)

    def run():
        stream.write_buckets(stream.decode_events(spark.readStream.text(src), APPS), out, ckpt, once=True).awaitTermination()
        return sorted(r.value for r in spark.read.text(out).collect())

    first = run()
    # the sink has the batch, but the stream stopped before it noted so: the batch is run again
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (tmp_path / "ckpt" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run() == first
    spark.createDataFrame([(KEPT[0],)], "value string").write.mode("append").text(src)
    assert len(run()) == len(first) + 1


def test_rolling_state_survives_a_restart_and_drops_late_rows(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    start = dt.datetime(2024, 1, 1)

    def deliver(hours, key):
        df = spark.createDataFrame([(start + dt.timedelta(hours=h, minutes=5), key) for h in hours], "ts timestamp, k int")
        df.coalesce(1).write.mode("append").parquet(src)
        source = spark.readStream.schema(df.schema).parquet(src)
        stream.write_rolling(source, ["k"], out, ckpt, late="2 hours").awaitTermination()

    deliver([0, 1, 2], 1)
    deliver([10, 11, 12], 1)  # the watermark is 10:05 now
    deliver([3, 9], 2)  # late: both hours have passed
    deliver([10], 3)  # late, but its hour is still open
    deliver([24 * 40], 9)
    deliver([24 * 90], 9)
    rows = [(r.window_end, r.k, r.n) for r in spark.read.parquet(out).where("k < 9").collect()]
    assert len(rows) == len(set(rows))
    want = {}
    for h, k in [(h, 1) for h in (0, 1, 2, 10, 11, 12)] + [(10, 3)]:
        for end in range(h + 1, h + 25):
            key = (start + dt.timedelta(hours=end), k)
            want[key] = want.get(key, 0) + 1
    assert {(t, k): n for t, k, n in rows} == want
