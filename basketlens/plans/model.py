"""Lazily built modelled tables, shared by the analyses (one Spark plan per use).

``orders`` and ``rfm`` are the reused nodes; ``rfm`` is materialised by the
checkpoints of its exact rankings, so later joins re-read it instead of
re-ranking.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from basketlens.operators import churn, clean, facts, rfm as rfm_ops, sentiment, themes as theme_ops
from basketlens.schemas import RAW_SCHEMAS
from basketlens.sources import files, testdata as td

MULTI_LINE = {"order_reviews"}   # the only raw file with newlines inside fields


@dataclass
class Model:
    spark: SparkSession
    raw_customers: DataFrame
    raw_orders: DataFrame
    raw_items: DataFrame
    raw_products: DataFrame
    raw_translations: DataFrame
    raw_reviews: DataFrame
    persons: DataFrame            # SQL-flavour customer dimension (one row per person)
    churn_days: int = churn.CHURN_DAYS
    #: The reviews with a function of their texts applied where these are read (default: to ``raw_reviews``).
    prepared_reviews: Callable[[Callable[[DataFrame], DataFrame]], DataFrame] | None = None
    rejects: dict[str, DataFrame] = field(default_factory=dict)   # lines that did not fit, by raw table

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Model":
        return cls(spark=spark,
                   raw_customers=td.raw_customers(spark, sf_dir),
                   raw_orders=td.raw_orders(spark, sf_dir),
                   raw_items=td.raw_order_items(spark, sf_dir),
                   raw_products=td.raw_products(spark, sf_dir),
                   raw_translations=td.translations(spark),
                   raw_reviews=td.raw_reviews(spark, sf_dir),
                   persons=td.raw_persons(spark, sf_dir),
                   prepared_reviews=lambda prepared: td.raw_reviews(spark, sf_dir, prepared))

    @classmethod
    def from_raw(cls, spark: SparkSession, folder: str, names: dict[str, str] | None = None,
                 split_to: str | None = None) -> "Model":
        """The raw CSV files of ``folder``; ``names`` maps a table of ``RAW_SCHEMAS`` to its file (``<table>.csv``).

        With ``split_to`` every file is parsed once into that folder, good rows and rejected lines
        apart; the model stands on the good rows and has the rejects by table in ``rejects``.
        """
        raw, rejects = {}, {}
        for t, schema in RAW_SCHEMAS.items():
            path = f"{folder.rstrip('/')}/{(names or {}).get(t, t + '.csv')}"
            if split_to is None:
                raw[t] = files.read_raw(spark, path, schema, multi_line=t in MULTI_LINE)
            else:
                raw[t], rejects[t] = files.split_raw(spark, path, schema, f"{split_to.rstrip('/')}/{t}",
                                                     multi_line=t in MULTI_LINE)
        persons = clean.customers_dim(clean.standardize_customers(raw["customers"]), raw["orders"])
        return cls(spark=spark, raw_customers=raw["customers"], raw_orders=raw["orders"], raw_items=raw["order_items"],
                   raw_products=raw["products"], raw_translations=raw["translations"],
                   raw_reviews=raw["order_reviews"],
                   persons=persons.where("customer_unique_id is not null"), rejects=rejects)

    @cached_property
    def customers(self) -> DataFrame:
        return clean.standardize_customers(self.raw_customers)

    @cached_property
    def products(self) -> DataFrame:
        return clean.products_clean(self.raw_products, self.raw_translations)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.orders_clean(self.raw_orders, self.customers, self.raw_items)

    @cached_property
    def customers_clean(self) -> DataFrame:
        return clean.customers_clean(self.customers, self.orders)

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm_ops.rfm_segmentation(self.orders, self.customers_clean)

    @cached_property
    def churn(self) -> DataFrame:
        return churn.customer_churn_clv(self.rfm, self.churn_days)

    @cached_property
    def sales_fact(self) -> DataFrame:
        return clean.sales_fact(self.raw_orders, self.customers, self.raw_items, self.products)

    def labeled_reviews(self, lexicon: DataFrame, negators: list[str] = (), boosters: list[str] = (),
                        themes: dict[str, list[str]] | None = None) -> DataFrame:
        """T1, T2 and the theme counts of T5, with the customer keys of I3.

        All that is wanted of a text is found where it is read; no text is in
        the result or in a shuffle on the way to it.
        """
        def found(texts: DataFrame) -> DataFrame:
            scored = sentiment.lexicon_polarity(texts, lexicon, negators, boosters)
            return theme_ops.theme_mentions(scored, themes).drop("review_comment_message")

        reviews = self.prepared_reviews(found) if self.prepared_reviews else found(self.raw_reviews)
        return facts.reviews_with_customer(sentiment.label_reviews(reviews), self.orders, (
            "review_id", "order_id", "review_score", "polarity", "has_comment", "sentiment_label", theme_ops.MENTIONS))

    def with_stored_orders(self, table: str, path: str, buckets: int) -> "Model":
        """The same model over orders stored by person (I14): analyses by person then shuffle no orders."""
        stored = files.write_bucketed(self.orders, table, path, "customer_unique_id", "order_id", buckets,
                                      sort_by=("order_purchase_timestamp",))
        model = replace(self)
        model.__dict__["orders"] = stored
        return model
