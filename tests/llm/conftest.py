import pytest

from tests.conftest import SF001


@pytest.fixture(scope="session")
def sf():
    return SF001


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text, lang) as a documents frame with clashing further columns."""
    from bondliq.llm.common import let_workers_import

    let_workers_import(spark)

    def make(rows, parts=3):
        full = [(d, t, lang, "s", 7, 1.0, "k") for d, t, lang in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score double, node string").repartition(parts)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Null, empty, blank, very long, tied and repeated texts, and a null id."""
    long_text = " ".join(f"word{i % 900}" for i in range(30_000))
    return [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, long_text, "en"), (5, "same words here again", "en"),
            (5, "same words here again", "en"), (6, "same words here again", "de"), (None, "no id at all", "en"),
            (7, "x" * 50_000, "fr"), (8, "café \U0001f600 naïve a@b.co", "fr"), (9, "<|endoftext|> a  b \n ", None)]
