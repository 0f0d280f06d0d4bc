"""T5: complaint themes in negative reviews per value tier.

The reference concatenates all text of a tier into one string and counts
whole-word regex matches of each keyword.  Here every review counts its own
matches where it is read, for keywords of one or several words; one number
per theme then meets the person and the tier, and no text is shuffled or
gathered in one place.  A match never spans two reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.text import whole_word_count
from basketlens.operators.sentiment import MIXED, NEGATIVE

PERSON = "customer_unique_id"

# Complaint themes and keywords of the reference.
COMPLAINT_THEMES = {
    "quality": ["quality", "qualidade", "defeito", "quebrado", "danificado"],
    "delivery": ["delivery", "entrega", "entregue", "atraso", "atrasado", "frete"],
    "price": ["price", "preco", "preço", "caro", "valor"],
    "expectations": ["expectations", "expectativa", "esperava", "decepcion", "decepção"],
    "service": ["service", "servico", "serviço", "atendimento", "suporte"],
}

MENTIONS = "theme_mentions"


def theme_mentions(reviews: DataFrame, themes: dict[str, list[str]] | None = None,
                   text_col: str = "review_comment_message") -> DataFrame:
    """Add ``theme_mentions``: per theme, in the order of ``themes``, the whole-word occurrences of its keywords.

    The text is expected in lower case (T1 leaves it so); a null text counts 0.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def mentions(words: list[str]) -> Column:
        return sum((whole_word_count(text, w) for w in words), F.lit(0)).cast("long")

    return reviews.withColumn(MENTIONS, F.array(*[mentions(words) for words in (themes or COMPLAINT_THEMES).values()]))


def negative_review_themes(labeled: DataFrame, rfm: DataFrame,
                           themes: dict[str, list[str]] | None = None,
                           text_col: str = "review_comment_message") -> DataFrame:
    """Negative and mixed reviews per tier (null tier -> 'Unknown'): mentions per theme, zeros included, most first.

    Uses the column that ``theme_mentions`` has added (for the same
    ``themes``), or counts in ``text_col``.
    """
    themes = themes or COMPLAINT_THEMES
    neg = labeled.filter(F.col("sentiment_label").isin(NEGATIVE, MIXED))
    if MENTIONS not in neg.columns:
        neg = theme_mentions(neg, themes, text_col)
    # map-side sums per person: what meets the tiers is one row a person
    per_person = neg.groupBy(PERSON).agg(F.count(F.lit(1)).alias("n"),
                                         *[F.sum(F.col(MENTIONS)[i]).alias(f"_{i}") for i in range(len(themes))])
    sums = (per_person.join(rfm.select(PERSON, "value_tier"), PERSON, "left")
            .groupBy(F.coalesce("value_tier", F.lit("Unknown")).alias("value_tier"))
            .agg(F.sum("n").alias("negative_review_count"),
                 *[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(themes))]))
    per_theme = F.array(*[F.struct(F.lit(t).alias("complaint_theme"), F.col(f"_{i}").alias("mention_count"))
                          for i, t in enumerate(themes)])
    return (sums.select("value_tier", F.explode(per_theme).alias("x"), "negative_review_count")
            .select("value_tier", "x.*", "negative_review_count")
            .orderBy("value_tier", F.col("mention_count").desc(), "complaint_theme"))
