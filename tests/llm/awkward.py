"""Rows that operators must take without a crash."""

LONG = "the of and " * 60_000
CLASHES = (
    "node t n s l k p q h m low high band component doc item words seeds token times score place "
    "row_number_ held_out rank host path rule text_ label best draw id v g"
).split()


def documents(spark, rows=None):
    """(doc_id, text, lang, source, n_chars) and columns that clash with the operators' own."""
    if rows is None:
        rows = [
            (1, "Ein Text, der die Wörter der Sprache hat und nicht endet.", "de"),
            (2, None, "en"),
            (3, "", "en"),
            (4, " \t\n ", None),
            (5, "one", "en"),
            (6, "one", "en"),
            (6, "one", "en"),
            (None, "the words of a row without an id", "en"),
            (None, None, None),
            (7, LONG, "en"),
            (8, "123 456 !!", "en"),
            (9, "漢字 and émigré 😀 \x1c \x85 end", None),
        ]
    rows = [(*r, "src", 0, *["x"] * len(CLASHES)) for r in rows]
    columns = ", ".join(f"{c} string" for c in CLASHES)
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {columns}"
    return spark.createDataFrame(rows, schema).repartition(3)


def table(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
