"""Small corpora with the awkward cases every operator has to survive."""

from pyspark.sql import Row

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, ids=None, sources=None, extra=False):
    """documents rows; ``extra`` adds columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    if not extra:
        return spark.createDataFrame(rows, DOC)
    names = ["_r", "fp", "score", "size", "copies", "ids", "th", "_d", "b", "rank", "`odd name`"]
    schema = DOC + ", " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([r + ("x",) * len(names) for r in rows], schema)


def saved(tmp_path, **tables):
    """Write the tables as a driver folder and return its path."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plain(rows):
    return sorted((tuple(r) if isinstance(r, Row) else r for r in rows), key=repr)
