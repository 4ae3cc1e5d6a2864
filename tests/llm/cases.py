"""Rows that operators must survive: nulls, empty and long texts, ties, repeated rows, extra columns."""

LONG = "word " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rep long, size int"


def hard_rows(texts=()):
    plain = [None, "", " \n\t", "one", "Équipe naïve à l'école", LONG, "x" * 30_000, "a\x00b \x1c c\x85d", "日本語 😀😀 ΟΔΟΣ", *texts]
    rows = [(n, text, "en" if n % 2 else None, None if n % 3 else "s", None, 0.5, n, 1) for n, text in enumerate(plain)]
    return rows + [rows[3], rows[3], (None, "no id here", None, None, None, None, None, None)]


def hard_docs(spark, texts=()):
    return spark.createDataFrame(hard_rows(texts), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
