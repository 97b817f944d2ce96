"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards quietly bake fresh bread for every hungry guest in town"


def docs(spark, texts, sources=None, ids=None):
    rows = [(ids[i] if ids else i, t, "en", sources[i] if sources else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows."""
    rows = [
        (0, PROSE, "en", "a", 10),
        (0, PROSE, "en", "a", 10),
        (1, PROSE, None, None, None),
        (2, None, "en", "a", None),
        (3, "", "en", "b", 0),
        (4, " \n\t ", "en", "b", 4),
        (None, "a null id has a text of its own and some more words follow here", "fr", "c", 3),
        (5, "é" * 50 + " ß\u00a0x\u2003y " + PROSE.upper(), "de", "c", 3),
        (6, (PROSE + "\n") * 400, "en", "d", 3),
        (7, "one", "en", "d", 3),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def cluttered(df):
    """Further columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    names = "row host k1 k2 lines size chunk shard slot page_id url html line words score kept tokens piece start length label grams component block spans item _id _k1 id own key doc stays same template".split()
    return df.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(names) if c not in df.columns))
