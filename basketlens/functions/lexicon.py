"""Invented demonstration lexicon for the polarity job (T1) on the test tables.

The reference scores text with a third-party lexicon that it does not ship;
a real deployment passes its own ``(token, valence)`` table.  These words
were picked because they occur in the generated ``documents`` prose.
"""

# Fixed values (invented test lexicon, negators and boosters).
DEMO_LEXICON = [
    ("that", -1.9), ("with", 1.5), ("this", 0.7), ("from", -0.8), ("was", -1.1),
    ("sich", -2.3), ("für", 1.8), ("pour", 2.1), ("avec", 1.2), ("para", 0.9),
    ("con", -0.6), ("ción", 1.4),
]
DEMO_NEGATORS = ["not", "nicht", "pas", "no"]
DEMO_BOOSTERS = ["very", "is", "est", "ist", "es"]

# Fixed values (invented theme list whose words occur in the test prose).
DEMO_THEMES = {
    "quality": ["the", "der"],
    "delivery": ["with", "mit", "avec", "con"],
    "price": ["für", "pour", "para"],
    "expectations": ["that", "qui", "que"],
    "service": ["ción", "für"],
}


def lexicon_frame(spark, entries=None):
    rows = entries or DEMO_LEXICON
    return spark.createDataFrame([(t, str(v)) for t, v in rows], "token string, valence string") \
        .selectExpr("token", "cast(valence as decimal(10,4)) as valence")
