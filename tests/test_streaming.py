"""D-1 over a streaming source matches the batch operator."""
import tempfile

from restock import schemas
from restock.operators import features as Fe
from restock.streaming import daily_sales_stream
from restock.operators.plan import new_plan_id


def test_stream_daily_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="restock-stream-")
    from restock.sources import tpch
    hist = tpch.sales_history(spark, "/root/testdata/sf0.001")
    hist.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(hist.schema).parquet(src + "/in")
    q = (daily_sales_stream(stream).writeStream.outputMode("append").format("memory")
         .queryName("daily_stream_test").option("checkpointLocation", src + "/ck").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM daily_stream_test")
    exp = Fe.daily_sales(spark.read.parquet(src + "/in"))
    # append mode emits a day once the watermark (newest date - 2 days) reaches it
    newest = exp.agg({"date": "max"}).first()[0]
    import datetime as dt
    exp = exp.where(exp.date <= newest - dt.timedelta(days=2))
    assert got.count() > 0
    cols = ["date", "warehouse_id", "sku_id", "quantity_sold"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, exp.select(cols).collect()))


def test_plan_id_format():
    import datetime as dt
    assert new_plan_id(dt.datetime(2024, 1, 2, 3, 4, 5), "abcdef12") == "PLAN-20240102-030405-abcdef12"
