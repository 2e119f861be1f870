import pytest

from cases import TEXTS


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows, with columns that are named like the operators' own."""
    extra = "words string, n_words string, node string, block string, size string, copies string, carried string"
    schema = f"doc_id long, text string, source string, other long, {extra}"
    return spark.createDataFrame([(i, t, s, o, *["x"] * 7) for i, t, s, o in TEXTS], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("1 = 0")
