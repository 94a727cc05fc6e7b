import pandas as pd
import pytest

#: Clashing names that operators use inside.
EXTRA = {"n": 1, "rank": 2, "_bucket": 3, "start": 4, "mix_slot": 5, "id": 6, "row": 7, "_base": 8, "_all": 9, "score": 10, "size": 11}
LONG = "wort " * 40_000 + "x" * 60_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, extra columns of clashing names."""
    same = "the quick brown fox jumps over the lazy dog near the river bank today and then it rests"
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, same, "en", "a", len(same)), (3, same, "en", "a", len(same)), (4, same + ".", "en", None, None),
        (5, LONG, "de", "a", len(LONG)), (None, "no id but a@b.co", "en", "b", 3), (6, " \n\t ", "fr", "", 4), (7, "é" * 3 + " 中文 🎉 +1 (555) 123-4567", "es", "b", 9), (8, "one two", "en", "b", 7),
    ]
    pdf = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).assign(**EXTRA), "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in EXTRA))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
