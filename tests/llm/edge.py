"""Awkward rows every operator has to take: nulls, empty and very long texts, ties, repeats, clashing columns."""

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 3000

ROWS = [
    (5, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (5, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "b"),
    (4, "", "en", "a"),
    (2, None, None, None),
    (9, "   \n\t ", "de", "a"),
    (8, "one two", "fr", "c"),
    (7, "ONE two", "fr", "c"),
    (6, LONG, "en", "a"),
    (10, "é ñ ü 😀 \x00   ß", "de", "b"),
    (None, "no id here at all", "en", "b"),
    (11, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and 4111 1111 1111 1111", None, "c"),
]

SCHEMA = "doc_id long, text string, lang string, source string"


def table(spark, rows=ROWS):
    """The rows with extra columns named like the operators' own."""
    df = spark.createDataFrame(rows, SCHEMA)
    extra = "row block key name kept topic tokens rank level ids n_chars component_id"
    return df.selectExpr("*", *[f"CAST('x{k}' AS STRING) AS {c}" for k, c in enumerate(extra.split())])


def empty(spark):
    return table(spark).limit(0)
