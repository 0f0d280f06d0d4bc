"""Hand-written edge fixtures (FIXTURES.md section 5), checked against brute force."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter

from basketlens.functions.dates import elapsed_days
from basketlens.operators import churn, clean, ranking, revenue, sentiment, themes
from basketlens.schemas import RAW_ORDER_ITEMS, RAW_TRANSLATIONS
from basketlens.sources import files

ORDERS = "order_id long, customer_unique_id long, order_status string, order_purchase_timestamp timestamp_ntz, order_revenue decimal(18,2)"


def orders_df(spark, rows):
    return spark.createDataFrame(
        [(i, p, s, ts, Decimal(str(v))) for i, (p, s, ts, v) in enumerate(rows)], ORDERS)


def test_read_raw_csv_quirks(spark, tmp_path):
    path = tmp_path / "items.csv"
    body = ('﻿order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\r\n'
            'o1,1,"p,1",s1,2018-01-02 10:00:00,10.50,1.20\r\n'
            'o2,2,"p ""2""\nline",,,,0.00\r\n')
    path.write_bytes(body.encode("utf-8"))
    rows = files.read_raw(spark, str(path), RAW_ORDER_ITEMS, multi_line=True).orderBy("order_id").collect()
    assert rows[0].order_id == "o1" and rows[0].product_id == "p,1"
    assert rows[0].shipping_limit_date == datetime(2018, 1, 2, 10)
    assert rows[0].price == Decimal("10.50")
    assert rows[1].product_id == 'p "2"\nline'
    assert rows[1].seller_id is None and rows[1].price is None and rows[1].freight_value == Decimal("0.00")


def test_split_raw_good_rows_and_rejects_are_all_lines(spark, tmp_path):
    head = ",".join(f.name for f in RAW_ORDER_ITEMS.fields)
    (tmp_path / "in").mkdir()
    good = ['o1,1,"p,1",s1,2018-01-02 10:00:00,10.50,1.20', "o2,2,,,,,", "o3,3,p,s,,0.00,"]
    bad = ["o4,x,p,s,,1.00,1.00", "o5,1,p,s,2018-13-45 10:00:00,1.00,1.00", "o6,1,p", "o7,1,p,s,,1.00,1.00,9", "o8,1,p,s,,ten,1.00"]
    for k, lines in enumerate([good[:2] + bad[:3], bad[3:] + good[2:]]):
        (tmp_path / "in" / f"f{k}.csv").write_text("\n".join([head, *lines]) + "\n")
    rows, rejects = files.split_raw(spark, str(tmp_path / "in"), RAW_ORDER_ITEMS, str(tmp_path / "out"))
    assert rows.schema.names == RAW_ORDER_ITEMS.names and sorted(r.order_id for r in rows.collect()) == ["o1", "o2", "o3"]
    got = rejects.collect()
    assert sorted(r.line for r in got) == sorted(bad)
    assert {r.file.rsplit("/", 1)[1] for r in got} == {"f0.csv", "f1.csv"}


def test_split_raw_keeps_both_files_open_so_that_no_task_sorts_its_rows(spark, tmp_path, monkeypatch):
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (seen.append(spark.conf.get(name)), write(w, *a, **k))[1])
    path = tmp_path / "items.csv"
    path.write_text("\n".join([",".join(f.name for f in RAW_ORDER_ITEMS.fields), "o1,1,p,s,,1.00,1.00", "o2,x,p,s,,1.00,1.00"] * 3))
    before = spark.conf.get(name)
    rows, rejects = files.split_raw(spark, str(path), RAW_ORDER_ITEMS, str(tmp_path / "out"))
    # of the three headers Spark skips the first
    assert rows.count() == 3 and rejects.count() == 5
    assert seen == ["2"] and spark.conf.get(name) == before


def test_split_raw_with_newlines_in_fields(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(",".join(f.name for f in RAW_ORDER_ITEMS.fields) + '\no1,1,"a\nb",s,,1.00,\no2,1,p,s,,bad,\n')
    rows, rejects = files.split_raw(spark, str(path), RAW_ORDER_ITEMS, str(tmp_path / "out"), multi_line=True)
    assert [r.product_id for r in rows.collect()] == ["a\nb"] and [r.line.strip() for r in rejects.collect()] == ["o2,1,p,s,,bad,"]


def test_write_extract_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    files.write_extract(df, str(tmp_path / "x"), single_file=True)
    back = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert sorted((r.k, int(r.v)) for r in back.collect()) == [("a", 1), ("b", 2)]


def test_standardize_city(spark):
    df = spark.createDataFrame([(1, 1, 0, "  São Paulo ", "sp"), (2, 1, 0, "ÉVORA", "rj"), (3, 2, 0, "ﬁrenze", "mg"),
                                (4, 2, 0, None, None), (5, 3, 0, "guarujá☃", "sp")],
                               "customer_id long, customer_unique_id long, customer_zip_code_prefix int, "
                               "customer_city string, customer_state string")
    got = {r.customer_id: (r.customer_city, r.customer_state) for r in clean.standardize_customers(df).collect()}
    assert got == {1: ("sao paulo", "SP"), 2: ("evora", "RJ"), 3: ("firenze", "MG"), 4: (None, None), 5: ("guaruja", "SP")}


def test_products_clean_fallbacks(spark):
    p = spark.createDataFrame([(1, "beleza", 3), (2, None, 4), (3, "novo", 5)],
                              "product_id long, product_category_name string, product_name_lenght int")
    t = spark.createDataFrame([("﻿beleza", "beauty\r")], RAW_TRANSLATIONS)
    got = {r.product_id: (r.product_category_name, r.product_category_english, r.product_name_length)
           for r in clean.products_clean(p, t).collect()}
    assert got == {1: ("beleza", "beauty", 3), 2: ("unknown", "unknown", 4), 3: ("novo", "novo", 5)}
    sql = {r.product_id: (r.product_category_name, r.product_category_english)
           for r in clean.products_clean(p, t, flavour="sql").collect()}
    assert sql[2] == (None, "unknown")


def test_orders_clean_zero_fill_and_unknown_customer(spark):
    o = spark.createDataFrame([(1, 10, "delivered", datetime(2018, 3, 5)), (2, 99, "delivered", datetime(2018, 3, 6))],
                              "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz")
    c = spark.createDataFrame([(10, 7)], "customer_id long, customer_unique_id long")
    i = spark.createDataFrame([(3, 1, Decimal("5.00"), Decimal("1.00"))],
                              "order_id long, order_item_id int, price decimal(12,2), freight_value decimal(12,2)")
    left = {r.order_id: r for r in clean.orders_clean(o, c, i).collect()}
    assert left[1].order_revenue == Decimal("0.00") and left[1].order_items == 0
    assert left[2].customer_unique_id is None
    assert {r.order_id for r in clean.orders_clean(o, c, i, how="inner").collect()} == {1}


def test_customer_location_flavours(spark):
    cust = spark.createDataFrame([(1, 7, "zeta", "AA"), (2, 7, "alpha", "ZZ")],
                                 "customer_id long, customer_unique_id long, customer_city string, customer_state string")
    o = spark.createDataFrame([(1, 1, 7, "delivered", datetime(2018, 1, 1))],
                              "order_id long, customer_id long, customer_unique_id long, order_status string, "
                              "order_purchase_timestamp timestamp_ntz")
    py = clean.customers_clean(cust, o).first()
    assert (py.customer_city, py.customer_state) == ("zeta", "AA")
    sq = clean.customers_dim(cust, o).first()
    assert (sq.customer_city, sq.customer_state, sq.total_orders) == ("alpha", "AA", 1)


def test_reviews_dedup(spark):
    r = spark.createDataFrame([(1, 10, 3, ""), (1, 11, 5, "ok"), (2, 99, 1, "x")],
                              "review_id long, order_id long, review_score int, review_comment_message string")
    o = spark.createDataFrame([(10,), (11,)], "order_id long")
    got = [tuple(x) for x in clean.reviews_dedup(r, o).collect()]
    assert got == [(1, 10, 5, "ok")]


def test_elapsed_days_is_24h_floor(spark):
    a = datetime(2018, 1, 1, 12)
    df = spark.createDataFrame([(a, a + timedelta(days=180, hours=23)), (a, a + timedelta(days=181)),
                                (a + timedelta(hours=13), a + timedelta(days=181))], "s timestamp_ntz, e timestamp_ntz")
    assert [r.d for r in df.select(elapsed_days("e", "s").alias("d")).collect()] == [180, 181, 180]


def _brute_trend(rows, churn_days):
    pdf = pd.DataFrame(rows, columns=["p", "s", "ts", "v"])
    d = pdf[pdf.s == "delivered"]
    v = d.groupby("p").ts.agg(["min", "max"])
    out = []
    for me in pd.date_range(d.ts.min(), d.ts.max(), freq="ME"):
        el = v[v["min"] <= me]
        ch = ((me - el["max"]).dt.days > churn_days)
        out.append((me.to_period("M").to_timestamp().date(), len(el), int(ch.sum()),
                    round(ch.mean() * 100 + 1e-9, 2) if len(el) else 0.0))
    return out


def test_churn_trend_time_of_day_matches_brute_force(spark):
    t0 = datetime(2017, 1, 31, 15, 30)
    rows = [(1, "delivered", t0, 10), (1, "delivered", t0 + timedelta(days=40), 5),
            (2, "delivered", datetime(2017, 2, 28, 16, 0), 7),       # after the month-end time of day
            (3, "delivered", datetime(2017, 3, 1, 1, 0), 3), (3, "shipped", datetime(2017, 12, 1), 9),
            (4, "delivered", datetime(2017, 5, 20), 2), (4, "delivered", datetime(2017, 11, 30, 15, 30), 2),
            (5, "delivered", datetime(2017, 12, 31, 15, 0), 1)]
    got = [(r.month, r.known_customers, r.churned_customers, r.churn_rate_pct)
           for r in churn.churn_trend(orders_df(spark, rows), churn_days=30).orderBy("month").collect()]
    assert got == _brute_trend(rows, 30)


def _brute_asof(rows, persons, churn_days):
    pdf = pd.DataFrame(rows, columns=["p", "s", "ts", "v"])
    d = pdf[pdf.s == "delivered"].copy()
    d["m"] = d.ts.dt.to_period("M").dt.to_timestamp()
    out = []
    for m in sorted(d.m.unique()):
        known = churned = 0
        for p in persons:
            prior = d[(d.p == p) & (d.m <= m)]
            if prior.empty:
                continue
            known += 1
            last = prior.ts.max().normalize()
            if (m + pd.offsets.MonthEnd(0) - last).days > churn_days:
                churned += 1
        out.append((pd.Timestamp(m).date(), known, churned))
    return out


def test_churn_trend_asof_lapse_and_return(spark):
    rows = [(1, "delivered", datetime(2017, 1, 5), 1), (1, "delivered", datetime(2017, 9, 1), 1),
            (2, "delivered", datetime(2017, 2, 1), 1), (3, "delivered", datetime(2017, 4, 30), 1),
            (1, "delivered", datetime(2017, 9, 20), 1), (9, "delivered", datetime(2017, 6, 1), 1)]
    persons = spark.createDataFrame([(1,), (2,), (3,)], "customer_unique_id long")
    got = [(r.month_start, r.known_customers, r.churned_customers)
           for r in churn.churn_trend_asof(orders_df(spark, rows), persons, churn_days=60).orderBy("month_start").collect()]
    assert got == _brute_asof(rows, [1, 2, 3], 60)


def test_return_windows_same_timestamp(spark):
    t = datetime(2018, 5, 1, 9)
    rows = [(1, "delivered", t, 1), (1, "delivered", t, 1), (2, "delivered", t, 1), (2, "delivered", t + timedelta(days=45), 1),
            (3, "delivered", t, 1), (4, "delivered", t, 1), (4, "delivered", t + timedelta(days=100), 1)]
    r = revenue.return_windows(orders_df(spark, rows)).first()
    assert r.returning_customers == 3
    assert (r.returned_within_30_days_pct, r.returned_within_60_days_pct, r.returned_within_90_days_pct) == (33.33, 66.67, 66.67)
    b = revenue.return_rate_all_customers(orders_df(spark, rows)).first()
    assert (b.delivered_customers, b.returned_within_90_days, b.returned_within_90_days_pct) == (4, 2, 50.0)


def test_top_customers_ties_and_ranks(spark):
    rows = [(p, "delivered", datetime(2018, 1, p), v) for p, v in [(1, 50), (2, 50), (3, 40), (4, 40), (5, 10)]]
    persons = spark.createDataFrame([(1, "A", "x"), (2, "B", "x"), (3, "A", "x"), (4, "A", "x"), (5, "B", "x")],
                                    "customer_unique_id long, customer_state string, customer_city string")
    got = [(r.customer_unique_id, r.revenue_rank, r.state_revenue_rank)
           for r in ranking.top_customers(orders_df(spark, rows), persons, n=3).collect()]
    assert sorted(got) == [(1, 1, 1), (2, 1, 1), (3, 3, 2)]


def test_monthly_revenue_zero_month_and_gap(spark):
    rows = [(1, "delivered", datetime(2018, 1, 3), 10), (1, "delivered", datetime(2018, 2, 3), 0),
            (2, "delivered", datetime(2018, 4, 3), 5), (2, "delivered", datetime(2018, 5, 3), 6)]
    got = [(r.revenue_month.month, r.prior_month_revenue, r.mom_revenue_growth_pct, r.running_revenue)
           for r in revenue.monthly_revenue(orders_df(spark, rows)).orderBy("revenue_month").collect()]
    assert got == [(1, None, None, Decimal("10.00")), (2, Decimal("10.00"), -100.0, Decimal("10.00")),
                   (4, Decimal("0.00"), None, Decimal("15.00")), (5, Decimal("5.00"), 20.0, Decimal("21.00"))]


def test_review_labels(spark):
    df = spark.createDataFrame([
        (1, "bad text", 5, -0.2), (2, "", 5, 0.0), (3, "", 3, 0.0), (4, "", 1, 0.0), (5, "meh", None, 0.01),
        (6, "fine", 3, 0.05), (7, "hmm", 3, -0.05), (8, "ok", 4, 0.0)],
        "review_id long, review_comment_message string, review_score int, polarity double")
    got = {r.review_id: r.sentiment_label for r in sentiment.label_reviews(df).collect()}
    assert got == {1: "Mixed Negative", 2: "Positive", 3: "Negative", 4: "Negative", 5: "Negative",
                   6: "Positive", 7: "Negative", 8: "Positive"}


def test_customer_label_tie_is_negative(spark):
    df = spark.createDataFrame([(1, 7, 70, 5, 0.5, "Positive"), (2, 7, 71, 1, -0.5, "Negative")],
                               "review_id long, customer_unique_id long, customer_id long, review_score int, "
                               "polarity double, sentiment_label string")
    r = sentiment.customer_sentiment(df).first()
    assert (r.sentiment_label, r.customer_id, r.avg_review_score, r.avg_vader_compound) == ("Negative", 70, 3.0, 0.0)


def test_polarity_negation_and_booster(spark):
    lex = spark.createDataFrame([("good", "2.0"), ("bad", "-1.5")], "token string, valence string") \
        .selectExpr("token", "cast(valence as decimal(10,4)) valence")
    df = spark.createDataFrame([(1, "Good!"), (2, "not good"), (3, "very bad"), (4, ""), (5, None), (6, "nothing here")],
                               "review_id long, review_comment_message string")
    got = {r.review_id: r.polarity for r in
           sentiment.lexicon_polarity(df, lex, ["not"], ["very"]).collect()}

    def norm(s):
        return round(s / (s * s + 15) ** 0.5, 4)
    assert got == {1: norm(2.0), 2: norm(2.0 * -0.74), 3: norm(-1.5 - 0.293), 4: 0.0, 5: 0.0, 6: 0.0}


def test_theme_counts_equal_regex(spark):
    texts = ["o preço, preço! caro-caro; precoce valor2 valor", "atraso: entrega_rapida entrega.", "decepção decepcionado"]
    df = spark.createDataFrame([(i, 7, t, "Negative") for i, t in enumerate(texts)],
                               "review_id long, customer_unique_id long, review_comment_message string, sentiment_label string")
    rfm = spark.createDataFrame([(7, "VIP")], "customer_unique_id long, value_tier string")
    got = {r.complaint_theme: (r.mention_count, r.negative_review_count)
           for r in themes.negative_review_themes(df, rfm).collect()}
    text = " ".join(texts)
    for theme, words in themes.COMPLAINT_THEMES.items():
        exp = sum(len(re.findall(rf"\b{re.escape(w)}\b", text)) for w in words)
        assert got[theme] == (exp, 3)


def test_theme_phrases_equal_regex(spark):
    """Keywords of several words, with signs, overlapping each other and themselves, and of no word character."""
    words = {"late": ["came late", "late late", "late", "very  late", "late-night"], "odd": ["c++", ".net", "50%", "a.b", "é", "-", "¿por qué"],
             "none": ["absent phrase"]}
    texts = ["it came late, came  late; came late-night late late late", "c++ and c++x, x.net .net 50% 150% a.b aab a.b.",
             "é né é_ ré é, ¿por qué? x¿por qué", "came\nlate", "", None, "very  late very late a - b a-b --", "latecame late_ late9 ²late"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_id long, review_comment_message string")
    got = {r.review_id: r.theme_mentions for r in themes.theme_mentions(df, words).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [sum(len(re.findall(rf"\b{re.escape(w)}\b", t or "")) for w in ws) for ws in words.values()], t
    with pytest.raises(ValueError):
        themes.theme_mentions(df, {"x": [""]})


def test_polarity_against_a_token_loop(spark):
    """A larger lexicon (several tokens a slot), repeated ids, tokens of all languages, distances one to three."""
    rng = random.Random(3)
    entries = {f"w{i}": Decimal(rng.randint(-40, 40)) / 10 for i in range(300)} | {"é": Decimal("1.5"), "b\"'\\": Decimal(2)}
    lex = spark.createDataFrame([(t, str(v)) for t, v in entries.items()] + [("twice", "1.0"), ("twice", "0.5"), (None, "1.0")],
                                "token string, valence string").selectExpr("token", "cast(valence as decimal(10,4)) valence")
    entries["twice"] = Decimal("1.5")
    neg, boo, pool = ["not", "no"], ["very", "so"], [*entries, "not", "no", "very", "so", "plain", "x1"]
    texts = [" ".join(rng.choice(pool) + rng.choice(["", ",", "!"]) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "review_id long, review_comment_message string")
    want = Counter()
    for i, text in enumerate(texts):
        toks = [t for t in re.split(r"[^\w]+", text.strip().lower()) if t]
        s = Decimal(0)
        for k, t in enumerate(toks):
            if (v := entries.get(t)) is None:
                continue
            before = [toks[k - d] if k >= d else None for d in (1, 2, 3)]
            boost = sum(Decimal(str(w)) * Decimal("0.293") for b, w in zip(before, (1.0, 0.95, 0.9)) if b in boo)
            v += (v > 0) * boost - (v < 0) * boost
            s += v * (Decimal("-0.74") if set(before) & set(neg) else 1)
        want[i // 2, round(float(s) / (float(s) ** 2 + 15) ** 0.5, 4) + 0.0] += 1
    assert Counter((r.review_id, r.polarity) for r in sentiment.lexicon_polarity(df, lex, neg, boo).collect()) == want
    with pytest.raises(ValueError):
        sentiment.lexicon_polarity(df, lex, lexicon_limit=10)
    none = sentiment.lexicon_polarity(df, lex.limit(0)).collect()
    assert len(none) == 200 and {r.polarity for r in none} == {0.0}


def test_as_of_modes_latest_order_not_delivered(spark):
    from basketlens.operators import rfm
    rows = [(1, "delivered", datetime(2018, 1, 10, 12), 10), (2, "delivered", datetime(2018, 1, 1, 8), 5),
            (3, "shipped", datetime(2018, 2, 1, 9), 1)]
    o = orders_df(spark, rows)
    py = {r.customer_unique_id: r.recency_days for r in rfm.customer_metrics(o).collect()}
    assert py == {1: 1, 2: 10}            # latest delivered + 1 day, 24 h days
    sq = {r.customer_unique_id: r.recency_days
          for r in rfm.customer_metrics(o, as_of="all_orders").collect()}
    assert sq == {1: 22, 2: 31}           # latest date of any order, calendar days


def test_unknown_tier_in_themes_and_null_keys_dropped(spark):
    df = spark.createDataFrame([(1, 7, "atraso", "Negative"), (2, 8, "frete frete", "Mixed Negative"),
                                (3, 8, "valor", "Positive")],
                               "review_id long, customer_unique_id long, review_comment_message string, sentiment_label string")
    rfm = spark.createDataFrame([(7, "VIP")], "customer_unique_id long, value_tier string")
    got = {(r.value_tier, r.complaint_theme): (r.mention_count, r.negative_review_count)
           for r in themes.negative_review_themes(df, rfm).collect()}
    assert got[("Unknown", "delivery")] == (2, 1) and got[("VIP", "delivery")] == (1, 1)
    assert got[("VIP", "price")] == (0, 1) and len(got) == 10
    ch = spark.createDataFrame([(1, None, "VIP", True, Decimal("1"), Decimal("1")),
                                (2, "SP", None, False, Decimal("2"), Decimal("0"))],
                               "customer_unique_id long, customer_state string, value_tier string, is_churned boolean, "
                               "historical_clv decimal(18,2), estimated_revenue_at_risk decimal(20,6)")
    assert [r.value_tier for r in churn.churn_by_segment(ch).collect()] == ["VIP"]
    assert [r.customer_state for r in churn.churn_by_region(ch).collect()] == ["SP"]


def test_elapsed_days_ignores_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2021, 3, 13, 12), datetime(2021, 3, 14, 12)),
                                    (datetime(2021, 3, 13, 2, 30), datetime(2021, 3, 14, 2, 29, 59, 999999)),
                                    (datetime(2021, 11, 6, 12), datetime(2021, 11, 7, 11, 59))],
                                   "s timestamp_ntz, e timestamp_ntz")
        assert [r.d for r in df.select(elapsed_days("e", "s").alias("d")).collect()] == [1, 0, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
