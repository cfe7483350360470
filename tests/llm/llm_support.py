import pytest

SF_SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, n_lines string, component_id string, score string, anchor string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A frame of (doc_id, text) with further columns whose names clash with those of results."""

    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in rows], SCHEMA).repartition(parts)

    return make
