import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples, dealt over partitions."""
    def build(rows, parts=3):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, len(text) if text is not None else None))
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return build
