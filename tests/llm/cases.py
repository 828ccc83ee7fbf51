"""Rows that every operator on documents must survive, and shared checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet, " * 20_000
ROWS = [
    (1, "The cat sat on the mat and the dog sat by the door.", "en", "a"),
    (2, "The cat sat on the mat and the dog sat by the door.", "en", "a"),  # exact copy
    (2, "The cat sat on the mat and the dog sat by the door.", "en", "a"),  # repeated row
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \n\t\n ", "de", "b"),
    (6, LONG, "en", "b"),
    (None, "a row without an id", "en", None),
    (None, None, None, None),
    (7, "Ünïcode \U0001f600 words and A-Z mixed İ ſ", "fr", "c"),
    (8, "one", "en", "c"),
]


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


CLASHING = (
    "id", "id_null", "text_hash", "hash", "h", "w", "row", "got", "_row", "size", "key", "_b", "b",
    "code", "component", "n", "word", "words", "start", "stop", "line", "copy", "target", "taken", "score",
)


def with_clashes(df: DataFrame) -> DataFrame:
    """The same rows with columns named like the operators' own intermediate ones."""
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


def rows_of(df: DataFrame, *cols: str) -> list[tuple]:
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
