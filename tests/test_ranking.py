"""Exact distributed ranks: permutation, qcut equal to pandas, NTILE sizes."""

import random
from collections import Counter
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketlens.operators import ranking, selection
from basketlens.plans import extracts


def _frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60))
def test_row_number_is_permutation_and_ordered(spark, values):
    df = ranking.global_row_number(_frame(spark, values), [F.col("v").desc(), F.col("id").asc()],
                                   out="rn", total="n", num_partitions=5)
    got = sorted((r.rn, r.v, r.id, r.n) for r in df.collect())
    assert [g[0] for g in got] == list(range(1, len(values) + 1))
    assert all(g[3] == len(values) for g in got)
    expect = sorted(enumerate(values), key=lambda t: (-t[1], t[0]))
    assert [(g[2], g[1]) for g in got] == expect


@pytest.mark.parametrize("n", [2, 3, 5, 6, 7, 11, 99, 250])
def test_qcut_matches_pandas(spark, n):
    values = [(i * 7919) % 13 for i in range(n)]
    df = ranking.quantile_scores(_frame(spark, values), [("s", F.col("v"), False)], "id", method="qcut")
    got = {r.id: r.s for r in df.collect()}
    ranks = pd.Series(values).rank(method="first")
    exp = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert [got[i] for i in range(n)] == exp.tolist()


def test_qcut_single_row(spark):
    df = ranking.quantile_scores(_frame(spark, [3]), [("s", F.col("v"), True)], "id", method="qcut")
    assert [r.s for r in df.collect()] == [1]


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 23])
def test_ntile_sizes(spark, n):
    df = ranking.quantile_scores(_frame(spark, [1] * n), [("s", F.col("v"), False)], "id", method="ntile")
    got = sorted(r.s for r in df.collect())
    q, rem = divmod(n, 5)
    exp = [b + 1 for b in range(min(n, 5)) for _ in range(q + (1 if b < rem else 0))]
    assert got == exp


@pytest.mark.parametrize("method", ["qcut", "ntile"])
@pytest.mark.parametrize("descending", [False, True])
def test_scores_with_nulls_and_ties_match_the_sorted_list(spark, method, descending):
    values = [None if i % 4 == 0 else (i * 31) % 6 for i in range(47)]
    specs = [("s", F.col("v"), descending), ("same", F.lit(1), False)]
    got = {r.id: (r.s, r.same) for r in ranking.quantile_scores(_frame(spark, values), specs, "id", method=method).collect()}

    def scores(key):
        order, n = sorted(range(47), key=key), 47
        label = (lambda r: max(1, -(-5 * r // (n - 1)))) if method == "qcut" else \
            (lambda r: next(b + 1 for b in range(5) if r < (b + 1) * (n // 5) + min(b + 1, n % 5)))
        return {i: label(r) for r, i in enumerate(order)}

    by_value = scores(lambda i: ((values[i] is None) == descending, (values[i] or 0) * (-1 if descending else 1), i))
    by_id = scores(lambda i: i)
    assert got == {i: (by_value[i], by_id[i]) for i in range(47)}


def _sorted_pairs(rows, descending):
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else ""))
    order.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=descending)
    return order


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind,make", [
    ("long", lambda r: r.choice([r.randint(-2**62, 2**62), 5, 5, None])), ("int", lambda r: r.randint(0, 3)),
    ("decimal(28,2)", lambda r: Decimal(r.choice([r.randint(-10**9, 10**9), 10**20 + r.randint(0, 3), 7])) / 100),
    ("double", lambda r: r.choice([r.gauss(0, 1e-9), r.gauss(0, 1e9), 0.5, 0.5, None]))])
def test_selected_pairs_equal_the_sorted_list(spark, monkeypatch, kind, make, descending):
    """Ranks found through several passes of coarse histograms, in values and then in ids of one value."""
    monkeypatch.setattr(selection, "BINS", 4)
    monkeypatch.setattr(selection, "READ_OUT", 3)
    rng = random.Random(kind)
    ids = [f"{'ab'[k % 2]}{k * 7919 % 1000:04x}-{'é' * (k % 3)}" for k in range(300)] + [None]
    rows = [(make(rng), i) for i in ids]
    df = spark.createDataFrame(rows, f"v {kind}, id string").cache()
    ranks = [1, 2, 61, 150, 151, 299, 301, 302, 0]
    got, same = selection.select_ranks(df, [(F.col("v"), descending), (F.lit(1), False)], "id", [ranks, [150]])
    order = _sorted_pairs(rows, descending)
    assert got == [order[r - 1] if 1 <= r <= 301 else (None, None) for r in ranks]
    assert same == [(1, _sorted_pairs([(1, i) for i in ids], False)[149][1])]


def test_selected_pairs_by_number_ids_in_few_passes(spark):
    """One value shared by all rows: ids are cut by histograms, not read out."""
    df = spark.range(50_000).select((F.col("id") * 3 - 70_000).alias("id"), F.lit(2).alias("v"))
    assert selection.select_ranks(df, [(F.col("v"), True)], "id", [[1, 12_345, 50_000]]) == [
        [(2, -70_000), (2, 3 * 12_344 - 70_000), (2, 3 * 49_999 - 70_000)]]


def test_scatter_bins_are_bounded(spark):
    rfm = spark.range(5000).select((F.col("id") * F.col("id") % 977).alias("frequency"),
                                   (F.col("id") * 1.37).cast("decimal(28,2)").alias("monetary"),
                                   F.when(F.col("id") % 2 == 0, "VIP").alias("value_tier"))
    got = extracts.rfm_scatter_bins(rfm, bins=8).collect()
    assert len(got) <= 8 * 8 * 2 and sum(r.customers for r in got) == 5000
    per = Counter()
    for r in got:
        per[r.monetary_bin] += r.customers
    assert len(per) == 8 and max(per.values()) - min(per.values()) <= 2
