"""Small documents with all that may go wrong, and their schema."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and then runs back home", "en", "a", 1),
    (2, "the quick brown fox jumps over the lazy dog and then runs back home", "en", "b", 1),
    (3, "The QUICK brown fox jumps over the lazy dog and then runs back home", None, "a", 1),
    (4, None, "en", "a", None),
    (5, "", "fr", None, 0),
    (6, " \t\n ", "fr", "a", 3),
    (7, "one", "de", "a", 3),
    (7, "one", "de", "a", 3),
    (8, LONG, "en", "a", len(LONG)),
    (None, "a text without an id", "en", "a", 20),
    (9, "été Ünï ☃ 🦊 words beyond ascii 中文 text", "es", "a", 30),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """Columns with names the operators use themselves."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in ("fp", "root", "tokens", "_hash", "rank", "rate", "key", "chunk", "word", "keep", "_row_hash", "items")})
