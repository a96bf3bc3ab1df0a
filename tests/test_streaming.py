import pytest

from graticule.streaming.resample import stream_resample

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_batch_and_columns(spark):
    df = spark.read.parquet(EVENTS)
    out = stream_resample(df, "ts", "D", "count", ["value"], group_cols=["event_type"])
    assert out.columns == ["event_type", "ts", "value"]
    assert out.agg({"value": "sum"}).first()[0] == df.count()


def test_calendar_buckets_are_refused(spark):
    with pytest.raises(ValueError, match="MS"):
        stream_resample(spark.read.parquet(EVENTS), "ts", "MS", "mean", ["value"])


def test_filters_accept_streams(spark, tmp_path):
    import graticule as g

    df = spark.read.parquet(EVENTS)
    stream = spark.readStream.schema(df.schema).parquet(EVENTS.replace(".parquet", ".parq*"))
    kept = g.get(g.dim_slice(stream, "ts", "2024-01-05", "2024-01-20"), event_type=["click", "view"])
    query = (
        kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    want = df.filter("ts >= '2024-01-05' AND ts <= '2024-01-20' AND event_type IN ('click', 'view')").count()
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "o")).count() == want
