"""Documents of awkward shapes, as every operator must take them."""

LONG = " ".join(f"word{i % 997} of{i}" for i in range(9000))
PASSAGE = "seven silver foxes crossed the frozen river before the morning bells began to ring again"
ROWS = [
    (1, f"Well then. {PASSAGE} and so on.", "en"),
    (2, f"Other words here: {PASSAGE.upper()}!", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, LONG, "en"),
    (6, "same text for everyone\nsame text for everyone\nnot this one ###", "en"),
    (6, "same text for everyone\nsame text for everyone\nnot this one ###", "en"),
    (7, "same text for everyone\nsame text for everyone\nnot this one ###", None),
    (None, "a row without an id but with mail to some.one@example.org or +1 (555) 010-9999", "en"),
    (9, "ÉCOLE école 日本語 🙂 naïve façade 1.2.3.4 4111 1111 1111 1111", "fr"),
    (10, " \t\n\x0b ", "en"),
    (11, "b" * 5000, "en"),
    (12, "one two three four five six seven eight nine ten eleven twelve one two three four five", "en"),
]


def documents(spark, rows=ROWS):
    """With columns whose names the operators use inside."""
    rows = [(*r, "s", "x", 1) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, size int")


def empty(spark):
    return documents(spark, [])
