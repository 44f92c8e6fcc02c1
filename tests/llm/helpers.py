"""Small tables with the awkward rows that every operator has to take."""

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(n, t()) for n, t in (
    ("doc_id", T.LongType), ("text", T.StringType), ("lang", T.StringType), ("source", T.StringType), ("n_chars", T.LongType),
    # names that the operators use themselves
    ("fp", T.StringType), ("size", T.StringType), ("row", T.StringType), ("g", T.StringType), ("k", T.StringType),
    ("target", T.StringType), ("score", T.StringType), ("host", T.StringType), ("cm_id", T.StringType))])


def documents(spark, rows, extra=True):
    """rows: (doc_id, text[, lang[, source]])."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((*r, None if r[1] is None else len(r[1]), *["clash"] * 9))
    df = spark.createDataFrame(full, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(30_000))
EDGES = [(1, "one two three four five six", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " \t\n\x0b\x0c\r ", "fr", "b"),
         (5, LONG, "en", "b"), (6, "one two three four five six", "en", "a"), (6, "one two three four five six", "en", "a"),
         (None, "one two three four five six", "en", None), (7, "é中   𝒳 word", None, "b"), (8, "!!! ...", "en", "a")]


def collected(df, *keys):
    return sorted(df.collect(), key=lambda r: tuple((r[k] is None, r[k]) for k in keys))
