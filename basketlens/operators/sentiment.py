"""Review sentiment.

T1 re-aims the reference's per-row analyser as a job over whole tables that
never moves a text: the lexicon becomes a hash table inside the plan, and a
review's tokens are looked up and folded where the review is read.  Negation
and boosting follow the published VADER rules (Hutto & Gilbert, ICWSM 2014): a
negator among the three preceding tokens scales the valence by -0.74; a
booster adds 0.293 (damped by 0.95 / 0.9 at distances two and three); the sum
s is normalised as s / sqrt(s^2 + 15) and rounded to 4 decimals.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.numeric import half_up_ratio, pct
from basketlens.functions.text import normalize_review_text, tokens

PERSON = "customer_unique_id"

# Fixed values from the published VADER paper.
NEGATION_SCALAR = -0.74
BOOSTER_INCREMENT = 0.293
BOOSTER_DAMPING = (1.0, 0.95, 0.9)
NORMALIZATION_ALPHA = 15

# Review and customer labels of the reference.
POSITIVE, NEGATIVE, MIXED = "Positive", "Negative", "Mixed Negative"

VALENCE, SUM = "decimal(10,4)", "decimal(28,8)"


def _lexicon_table(lexicon: DataFrame, limit: int) -> tuple[Column, int]:
    """The lexicon as one constant, an array of small maps, and the array's length.

    A token's map stands at its hash modulo the length, so a lookup costs the
    same for any lexicon (Spark scans a map's keys one by one).
    """
    words = (lexicon.where(F.col("token").isNotNull()).groupBy("token")
             .agg(F.sum(F.col("valence").cast(VALENCE)).cast(VALENCE).alias("valence")))
    rows = words.select("token", F.col("valence").cast("string"), F.xxhash64("token").alias("h")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the lexicon has more than {limit} tokens, too many for a table inside the plan")
    slots = 1 << max(0, len(rows) - 1).bit_length()
    maps: list[dict] = [{} for _ in range(slots)]
    for r in rows:
        if r.valence is not None:
            maps[r.h % slots][r.token] = r.valence
    return F.from_json(F.lit(json.dumps(maps)), f"array<map<string,{VALENCE}>>"), slots


def lexicon_polarity(reviews: DataFrame, lexicon: DataFrame, negators: list[str] = (),
                     boosters: list[str] = (), text_col: str = "review_comment_message",
                     lexicon_limit: int = 200_000) -> DataFrame:
    """Add normalised text, ``has_comment`` and ``polarity`` in [-1, 1] (0 for empty text or no lexicon word).

    ``lexicon``: ``(token string, valence decimal)``; valences of a repeated
    token add up, and more than ``lexicon_limit`` tokens are an error, as the
    lexicon travels with the plan.  Each row is scored by itself: no shuffle,
    no join, any number of rows under one id.  Whole texts are processed.
    """
    table, slots = _lexicon_table(lexicon, lexicon_limit)
    base = (reviews.withColumn(text_col, normalize_review_text(text_col))
            .withColumn("has_comment", F.length(text_col) > 0)
            .withColumn("_toks", tokens(text_col)))
    neg, boo = list(negators) or [None], list(boosters) or [None]
    toks = F.col("_toks")

    def found(t: Column, i: Column) -> Column:
        slot = F.get(table, F.pmod(F.xxhash64(t), F.lit(slots)).cast("int"))
        return F.struct(i.alias("i"), F.try_element_at(slot, t).alias("v"))

    def is_in(c: Column, words) -> Column:
        return F.coalesce(c.isin(*words), F.lit(False))

    def scaled(x: Column) -> Column:
        before = [F.get(toks, x.i - k) for k in (1, 2, 3)]
        boost = sum(F.when(is_in(c, boo), F.lit(w)).otherwise(F.lit(0.0)) for c, w in zip(before, BOOSTER_DAMPING))
        boost = (boost * BOOSTER_INCREMENT).cast("decimal(10,6)")
        signed = x.v + F.when(x.v > 0, boost).when(x.v < 0, -boost).otherwise(F.lit(0))
        negated = is_in(before[0], neg) | is_in(before[1], neg) | is_in(before[2], neg)
        return F.when(negated, signed * F.lit(NEGATION_SCALAR).cast("decimal(3,2)")).otherwise(signed)

    hits = F.filter(F.transform(toks, found), lambda x: x.v.isNotNull())
    total = F.aggregate(F.col("_hits"), F.lit(0).cast(SUM), lambda acc, x: (acc + scaled(x)).cast(SUM))
    s = F.col("_s")
    compound = F.round(s / F.sqrt(s * s + NORMALIZATION_ALPHA), 4)
    scored = (base.withColumn("_hits", hits).withColumn("_s", total.cast("double"))
              .withColumn("polarity", F.coalesce(compound, F.lit(0.0))))
    return (scored.withColumn("polarity", F.when(F.col("polarity") == 0, F.lit(0.0)).otherwise(F.col("polarity")))
            .drop("_toks", "_hits", "_s"))   # no negative zero


def label_reviews(scored: DataFrame, polarity_col: str = "polarity",
                  text_col: str = "review_comment_message") -> DataFrame:
    """Ordered hybrid label from polarity and stars (NULL stars make every star test false).

    Whether there is a comment is read from ``has_comment`` where T1 has added
    it, so that the text can be dropped before any shuffle.
    """
    c, s = F.col(polarity_col), F.col("review_score")
    has = (F.col("has_comment") if "has_comment" in scored.columns
           else F.length(F.coalesce(F.col(text_col), F.lit(""))) > 0)
    label = (F.when(has & (s >= 4) & (c < 0), MIXED)
             .when((c >= 0.05) | (~has & (s >= 4)), POSITIVE)
             .when((c <= -0.05) | (s <= 2), NEGATIVE)
             .when(s >= 4, POSITIVE)
             .otherwise(NEGATIVE))
    return scored.withColumn("has_comment", has).withColumn("sentiment_label", label)


def customer_sentiment(labeled: DataFrame, polarity_col: str = "polarity") -> DataFrame:
    """One row per person; Mixed wins, then Negative on a tie with Positive.

    ``customer_id`` is the smallest of the person's ids (deterministic
    replacement of "first seen").
    """
    comp_units = (F.col(polarity_col) * 10000).cast("decimal(20,0)")
    g = (labeled.filter(F.col(PERSON).isNotNull()).groupBy(PERSON)
         .agg(F.min("customer_id").alias("customer_id"),
              F.count("review_id").alias("review_count"),
              F.sum("review_score").alias("_ss"), F.count("review_score").alias("_ns"),
              F.sum(comp_units).alias("_cs"), F.count(polarity_col).alias("_nc"),
              F.count_if(F.col("sentiment_label") == MIXED).alias("mixed_negative_reviews"),
              F.count_if(F.col("sentiment_label") == NEGATIVE).alias("negative_reviews"),
              F.count_if(F.col("sentiment_label") == POSITIVE).alias("positive_reviews")))
    label = (F.when(F.col("mixed_negative_reviews") > 0, MIXED)
             .when(F.col("negative_reviews") >= F.col("positive_reviews"), NEGATIVE)
             .otherwise(POSITIVE))
    return (g.withColumn("avg_review_score", half_up_ratio("_ss", "_ns", 1, 2))
            .withColumn("avg_vader_compound", half_up_ratio("_cs", "_nc", 1, 0) / 10000)
            .withColumn("sentiment_label", label)
            .select(PERSON, "customer_id", "review_count", "avg_review_score", "avg_vader_compound",
                    "mixed_negative_reviews", "negative_reviews", "positive_reviews", "sentiment_label"))


def customer_sentiment_rfm(sentiment: DataFrame, rfm: DataFrame) -> DataFrame:
    """T4: customer sentiment + RFM columns (left join on person)."""
    r = rfm.select(PERSON, "value_tier", "recency_days", "frequency", "monetary", "customer_state")
    return sentiment.join(r, PERSON, "left")


def sentiment_distribution(csr: DataFrame) -> DataFrame:
    """Per tier and label: customers, tier total, % (null tiers dropped, D19); by tier, most customers first."""
    g = (csr.filter(F.col("value_tier").isNotNull() & F.col("sentiment_label").isNotNull())
         .groupBy("value_tier", "sentiment_label")
         .agg(F.countDistinct(PERSON).alias("customers")))
    # tiers x labels rows: a window over them costs nothing, a second branch would score every review again
    return (g.withColumn("segment_customers", F.sum("customers").over(Window.partitionBy("value_tier")))
            .withColumn("sentiment_pct", pct("customers", "segment_customers"))
            .orderBy("value_tier", F.col("customers").desc(), "sentiment_label"))


def negative_concentration(csr: DataFrame) -> DataFrame:
    """Per tier: negative, mixed and dissatisfied shares; most dissatisfied first."""
    g = (csr.filter(F.col("value_tier").isNotNull()).groupBy("value_tier")
         .agg(F.countDistinct(PERSON).alias("customers"),
              F.count_if(F.col("sentiment_label") == NEGATIVE).alias("negative_customers"),
              F.count_if(F.col("sentiment_label") == MIXED).alias("mixed_negative_customers"),
              F.count_if(F.col("sentiment_label") == POSITIVE).alias("positive_customers")))
    return (g.withColumn("negative_pct", pct("negative_customers", "customers"))
            .withColumn("mixed_negative_pct", pct("mixed_negative_customers", "customers"))
            .withColumn("dissatisfied_pct",
                        pct(F.col("negative_customers") + F.col("mixed_negative_customers"), "customers"))
            .orderBy(F.col("dissatisfied_pct").desc(), "value_tier"))
