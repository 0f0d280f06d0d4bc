from basketlens.schemas import RAW_ORDERS
from basketlens.streaming import ingest_raw_files


def test_incremental_ingest_is_exactly_once(spark, tmp_path):
    src = tmp_path / "drop"
    src.mkdir()
    head = "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at," \
           "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
    (src / "a.csv").write_text(head + "o1,c1,delivered,2018-01-01 10:00:00,,,,\n")
    out, ck = str(tmp_path / "orders"), str(tmp_path / "ck")
    ingest_raw_files(spark, str(src), RAW_ORDERS, out, ck).awaitTermination()
    (src / "b.csv").write_text(head + "o2,c2,shipped,2018-02-01 11:00:00,,,,\n")
    ingest_raw_files(spark, str(src), RAW_ORDERS, out, ck).awaitTermination()
    ingest_raw_files(spark, str(src), RAW_ORDERS, out, ck).awaitTermination()
    rows = sorted((r.order_id, r.order_status) for r in spark.read.parquet(out).collect())
    assert rows == [("o1", "delivered"), ("o2", "shipped")]
