"""Raw CSV files in, every table and extract out: columns, sums that must agree, rows read back."""

import csv
import glob
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketlens.functions.lexicon import lexicon_frame
from basketlens.plans import export
from basketlens.plans.model import Model
from basketlens.schemas import RAW_SCHEMAS
from basketlens.sources import files

ORDERS = [(f"o{i}", f"c{i % 13}", "delivered" if i % 5 else "shipped", f"2018-{1 + i % 9:02d}-{1 + i % 27:02d} 0{i % 9}:15:00")
          for i in range(40)]
ROWS = {
    "customers": [(f"c{i}", f"p{i % 7}", 1000 + i, ["São Paulo", "rio"][i % 2], ["sp", "rj"][i % 2]) for i in range(13)],
    "orders": [(*o, "", "", "", "") for o in ORDERS],
    "order_items": [(f"o{i}", 1, f"x{i % 3}", "s1", "2018-01-02 10:00:00", f"{10 + i}.50", "1.20") for i in range(39)],
    "products": [(f"x{i}", ["cama", "", "livros"][i], 5, 9, 1, 100, 10, 10, 10) for i in range(3)],
    "translations": [("cama", "bed")],
    "order_reviews": [(f"r{i}", f"o{i}", 1 + i % 5, "", ["", 'a, "bad"\nline', "good qualidade"][i % 3],
                       "2018-02-01 00:00:00", "2018-02-02 00:00:00") for i in range(30)],
}

# Columns of the outputs.
COLUMNS = {
    "executive_kpis": "total_customers active_customers churned_customers churn_rate_pct revenue average_historical_clv "
                      "average_customer_lifespan_days revenue_at_risk churn_definition_days",
    "sentiment_distribution": "value_tier sentiment_label customers segment_customers sentiment_pct",
    "negative_review_themes": "value_tier complaint_theme mention_count negative_review_count",
    "segment_summary": "value_tier customers revenue avg_clv avg_recency_days",
}


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    raw, out = tmp_path_factory.mktemp("raw"), str(tmp_path_factory.mktemp("out"))
    for table, rows in ROWS.items():
        with open(raw / f"{table}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(RAW_SCHEMAS[table].names)
            w.writerows(rows)
    model = Model.from_raw(spark, str(raw))
    frames = export.outputs(model, lexicon_frame(spark, [("good", 2.0), ("bad", -2.0)]))
    export.write_outputs(frames, out)
    return model, frames, out


def test_raw_files_are_read_whole(written):
    model, _, _ = written
    for frame, table in ((model.raw_customers, "customers"), (model.raw_orders, "orders"), (model.raw_items, "order_items"),
                         (model.raw_products, "products"), (model.raw_translations, "translations"),
                         (model.raw_reviews, "order_reviews")):
        assert frame.count() == len(ROWS[table]), table
    assert model.raw_reviews.where("review_id = 'r1'").first().review_comment_message == 'a, "bad"\nline'
    assert model.persons.count() == 7


def test_columns_and_rows_of_every_output(spark, written):
    _, frames, out = written
    for name, (df, _) in frames.items():
        table = spark.read.parquet(f"{out}/processed/{name}")
        extract = spark.read.schema(df.schema).option("header", True).option("multiLine", True).csv(
            f"{out}/exports/extract_{name}")
        assert table.columns == df.columns and table.count() == extract.count() > 0, name
    for name, columns in COLUMNS.items():
        assert frames[name][0].columns == columns.split(), name


def test_extracts_keep_their_order(written):
    _, _, out = written
    (path,) = glob.glob(f"{out}/exports/extract_segment_summary/part-*.csv")
    with open(path, newline="") as f:
        revenue = [float(r["revenue"]) for r in csv.DictReader(f)]
    assert revenue == sorted(revenue, reverse=True)


def test_sums_of_tiers_states_and_cohorts_agree(spark, written):
    _, _, out = written

    def total(name, column):
        return spark.read.parquet(f"{out}/processed/{name}").agg({column: "sum"}).first()[0]

    people = spark.read.parquet(f"{out}/processed/rfm_segmentation").count()
    assert people == total("segment_summary", "customers") == total("churn_by_segment", "customers")
    assert people == total("churn_by_region", "customers") == total("executive_kpis", "total_customers")
    assert total("segment_summary", "revenue") == total("churn_by_region", "historical_revenue")
    assert total("segment_summary", "revenue") == total("executive_kpis", "revenue")
    cohorts = spark.read.parquet(f"{out}/processed/cohort_retention_long")
    first = cohorts.where("months_since_first_purchase = 0")
    assert first.agg({"active_customers": "sum"}).first()[0] == people
    assert cohorts.agg({"revenue": "sum"}).first()[0] == total("segment_summary", "revenue")


def test_a_model_keeps_the_lines_that_do_not_fit(spark, tmp_path):
    bad = {"orders": "o99,c1,delivered,yesterday,,,,", "order_items": "o1,one,x1,s1,,1.00,1.00", "customers": "c99,p1"}
    for table, rows in ROWS.items():
        with open(tmp_path / f"{table}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow(RAW_SCHEMAS[table].names)
            w.writerows(rows)
            f.write(bad[table] + "\r\n" if table in bad else "")
    model = Model.from_raw(spark, str(tmp_path), split_to=str(tmp_path / "split"))
    assert {t: [r.line for r in df.collect()] for t, df in model.rejects.items()} == {t: [bad[t]] if t in bad else [] for t in ROWS}
    assert model.raw_orders.count() == len(ROWS["orders"]) and model.raw_customers.count() == len(ROWS["customers"])
    assert model.raw_reviews.where("review_id = 'r1'").first().review_comment_message == 'a, "bad"\nline'
    assert model.orders.count() == len(ROWS["orders"])


def test_orders_stored_by_person(spark, tmp_path):
    """One file a bucket but for the bucket of a person with half of all rows; the table serves another session's catalog too."""
    orders = spark.range(3000).select(F.col("id").alias("order_id"),
                                      F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("person"))
    path = str(tmp_path / "t")
    got = files.write_bucketed(orders, "stored_a", path, "person", "order_id", buckets=8, sort_by=("order_id",))
    per_bucket = Counter(re.search(r"_(\d{5})\.c", f)[1] for f in glob.glob(f"{path}/part-*.parquet"))
    assert sorted(got.collect()) == sorted(orders.collect()) and len(per_bucket) == 8
    assert sorted(per_bucket.values())[-2] <= 2 < max(per_bucket.values())
    again = files.attach_bucketed(spark, "stored_b", path, orders.schema, "person", 8, sort_by=("order_id",))
    counted = again.groupBy("person").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert {r.person: r["count"] for r in counted.collect()} == Counter(r.person for r in orders.collect())
    for name in ("stored_a", "stored_b"):
        spark.sql(f"DROP TABLE {name}")


def test_counts_observed_while_tables_are_written(spark, tmp_path):
    tables = {"a": spark.range(1000).repartition(7), "b": spark.range(5).where("id > 9")}
    assert files.write_observed(tables, str(tmp_path)) == {"a": 1000, "b": 0}
    assert spark.read.parquet(f"{tmp_path}/a").count() == 1000
