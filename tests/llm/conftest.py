import pytest

# Columns that clash with names the operators use themselves.
CLASH = "score double, node long, text_key long, k1 long, n long, kept boolean"
CLASH_VALUES = (1.5, 1, 2, 3, 4, True)


@pytest.fixture
def documents(spark):
    """documents-like frame from (doc_id, text) rows, with clashing extra columns."""

    def make(rows):
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
        full = [(i, t, "en", "src0", None if t is None else len(t), *CLASH_VALUES) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


def words(rng, n, vocabulary=2_000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
