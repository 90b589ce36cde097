import pytest
from pyspark.sql import Row

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """(rows -> documents): rows of (doc_id, text) or (doc_id, text, source);
    with columns of the operators' own names besides."""
    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC).repartition(3)
        if extra:
            for name in ("score", "digest", "size", "copies", "key", "kind", "start", "n", "row", "labels"):
                df = df.withColumn(name, df["lang"])
        return df
    return make


def collected(df, *names) -> list[Row]:
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
