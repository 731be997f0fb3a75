import pytest

LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
PASSAGE = (
    "Once more the old clerk wrote down each entry of the day, and nobody asked about it. "
    "The ledger had been kept that way for thirty years, said the owner, and it would stay. "
    "A visitor had to wait until every line was read aloud, checked, signed and blotted dry. "
    "Then the lamp went out and the last cart left the yard."
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with nulls in every column, empty and very long texts, ties and repeated rows, and columns that clash."""
    rows = [
        (1, None, "en", "s", 0),
        (2, "", None, "s", None),
        (3, " \n\t ", "en", None, 3),
        (4, LONG, "en", "s", len(LONG)),
        (5, "one two", "en", "s", 7),
        (6, "One TWO", "en", "s", 7),
        (7, PASSAGE, "en", "s", None),
        (7, PASSAGE, "en", "s", None),
        (8, "Quite another start of things today. " + PASSAGE + " An end of its own, with words that nobody else has.", "en", "s", 1),
        (9, PASSAGE + "\nmore", "de", "t", 1),
        (None, "text of nobody", "en", "s", 14),
        (10, "Ünïcödé ▁ marks  and 😀 \x00 controls", "xx", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = {c: "x" for c in ("n", "h", "node", "set", "shard", "slot", "line", "votes", "idx", "words", "start", "_doc", "item_id", "page_id")}
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(v) for c, v in extra.items()})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
