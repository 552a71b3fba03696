"""Documents that several test modules use."""

#: Names that operators use themselves.
CLASHING = (
    "size kept taken target row_key fingerprint component_id score start n_tokens n_words n_hit words host path part "
    "source_size host_rate path_rate evidence _source _chunk _range _copies _doc text_hash"
).split()


def documents(spark, rows, extra=True):
    """(doc_id, text, lang, source) rows as a documents table with columns of clashing names."""
    full = [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]
    df = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.selectExpr("*", *(f"'other' AS `{c}`" for c in CLASHING)) if extra else df


EDGE = [
    (1, "one two three", "en", "a"),
    (1, "one two three", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n\x0b\x0c\r ", "en", None),
    (None, "four five", "en", "b"),
    (None, None, None, None),
    (5, "wörd  ñandú x y ét <|endoftext|> İstanbul 'll can't", "es", "b"),
    (6, "long line of words here " * 20_000, "en", "hot"),
    (7, "a" * 50_000, "en", "hot"),
    (8, "one two three", "en", "hot"),
]
