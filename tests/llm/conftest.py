import pytest

from gridlake.llm.shared import ship_package


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


DOCS = "doc_id long, text string, lang string, source string, score double, held_out boolean, id long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text, lang, source); with further columns whose names the operators use themselves."""
    def make(rows):
        return spark.createDataFrame([(i, t, lang, s, 0.5, True, 7) for i, t, lang, s in rows], DOCS).repartition(3)
    return make
