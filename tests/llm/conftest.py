import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table from texts; extra columns bear names that operators use."""

    def build(texts, first=0, **columns):
        rows = [(first + k, t, None, "s", len(t or "")) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
