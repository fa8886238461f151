import pytest
from samples import edge_rows

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, spans string, bucket int, "
          "score double, word string, id bigint, key bigint, lang_pred string, count bigint, n bigint")


@pytest.fixture(scope="session")
def rows():
    return edge_rows()


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 1, "x", 2, 0.5, "w", 3, 4, "p", 5, 6)
                                  for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return _frame(spark, rows).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return _frame(spark, [])
