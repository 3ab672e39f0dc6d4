"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows."""

LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "word"),
    (5, LONG),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (8, "The quick brown fox jumps over the lazy dog near the river bank today.\nand a second line that is long enough"),
    (None, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (None, None),
    (9, "straße ΣΑΣ İstanbul 日本語 😀 <|endoftext|> é"),
    (10, "The quick brown fox jumps over the lazy dog near the river bank today.\r\n  AND A SECOND LINE THAT IS LONG ENOUGH\t"),
]
SCHEMA = "doc_id long, text string"


def documents(spark, rows=ROWS):
    """The rows with columns whose names operators use themselves."""
    taken = ["ids", "kept", "score", "block", "h1", "place", "n_lines", "lang_pred", "fingerprint", "row", "__text__x"]
    schema = SCHEMA + ", lang string, " + ", ".join(f"{c} string" for c in taken)
    langs = ["en", None, "de"]
    return spark.createDataFrame([(i, t, langs[n % 3], *taken) for n, (i, t) in enumerate(rows)], schema).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA + ", lang string")
