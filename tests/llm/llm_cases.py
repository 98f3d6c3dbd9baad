"""Small tables with the awkward cases every operator has to handle."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 8000

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(spark, *texts):
    """Null and empty texts, a null id, a very long text, repeated rows, and then ``texts``."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "a row without an id"), (5, LONG), (6, "twice the same"), (6, "twice the same")]
    rows += [(10 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def saved(spark, tmp_path, **tables):
    """A folder of tables as the queries read them."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
