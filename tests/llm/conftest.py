import pytest

SMALL = "/root/testdata/sf0.01"

# Names that the operators use inside.
CLASHES = ["fp", "component", "component_id", "key", "hash", "spans", "size", "block", "text_hash", "row", "id", "rule_kept", "n_words", "start", "bucket", "at", "_head"]
WORDS = "the quick brown fox jumps over a lazy dog while seven green birds sing near old stone bridges today".split()


def prose(i: int, n: int = 60) -> str:
    return " ".join(WORDS[(i * 7 + k * (i + 3) + k * k) % len(WORDS)] + ("" if k % 9 else str(i)) for k in range(n)) + "."


ODD = [
    (1, prose(1), "en", "a", 10),
    (2, prose(1), "en", "a", 10),  # a copy
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \n\t ", "en", None, 4),
    (6, prose(6, 30_000), "de", "b", 7),  # very long
    (7, "x" * 200_000, "de", "b", 7),  # one very long word
    (8, prose(8), "en", "a", 1),
    (8, prose(9), "fr", "c", 1),  # a repeated key
    (9, prose(10) + ' token = "abcdef0123456789abcdef0123456789"', "en", "a", 3),
    (10, prose(11), None, "c", None),
    (10, prose(11), None, "c", None),  # a repeated row
    (None, prose(12), "en", "a", 2),
    (None, prose(13), "en", None, 2),
    (11, "one", "en", "a", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, copies, repeated keys and rows, clashing columns."""
    wide = SCHEMA + "".join(f", {c} string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("z" for _ in CLASHES)) for r in ODD], wide).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
