"""Documents with every oddity: nulls, empty and very long texts, repeated rows, extra columns of clashing names."""

LONG = "word " * 40_000 + "tail"
ROWS = [
    (1, "plain words here", "en", "a", 16),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "a text without id", "en", None, 17),
    (5, LONG, "en", "a", len(LONG)),
    (1, "plain words here", "en", "a", 16),
    (7, " \t\n ", None, "b", 4),
    (8, "é漢字😀 \u0000 ÿ", "xx", "b", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, more=()):
    return spark.createDataFrame([*ROWS, *more], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(frame, *names):
    """The frame with string columns of these names."""
    from pyspark.sql import functions as F

    for name in names:
        frame = frame.withColumn(name, F.lit("mine"))
    return frame
