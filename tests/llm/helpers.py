"""Small tables with nulls, empty and long texts, repeats, and columns whose names clash."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, digest string, place int, n int, k1 int, lo int, text_sha256 string"


def docs(spark, rows):
    """rows: (doc_id, text[, source[, lang]])"""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", 0, "u", "d", 1, 2, 3, 4, "h") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=str)
