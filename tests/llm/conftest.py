import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (id, text[, language])."""

    def make(texts, extra=()):
        rows = []
        for i, row in enumerate(texts):
            row = row if isinstance(row, tuple) else (i, row)
            rows.append((*row, *[None] * (3 - len(row)), None, len(row[1]) if row[1] is not None else None))
        df = spark.createDataFrame(rows, DOC).repartition(3)
        # columns whose names an operator might use itself
        for name in extra:
            df = df.selectExpr("*", f"'{name}' AS `{name}`")
        return df

    return make
