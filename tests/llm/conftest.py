import pytest

from cardtide.llm.queries import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ", shard string, score string, part string, key string, kept string, text_hash string, size string"
AWKWARD = [
    "", None, " ", "\n\n\n", "a", "word " * 30000, "x" * 200000, "é" * 50, "\u0000nul \u0001 ퟿ \U0001f600 end",
    "+" * 3000, "@" * 3000, "1" * 5000, "1." * 3000, "- " * 3000, "All rights reserved.", "cc by cc-by CC  BY", "<p>a<b>",
    "Licensed under the MIT License. " * 200, "same line\n" * 500, "tab\tvt\x0bff\x0ccr\rnl\nnbsp x y",
]


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def awkward(llm):
    """Null ids, null and empty texts, very long texts, repeated rows and extra columns with clashing names."""
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(None, "no id"), (None, None), (3, "\n\n\n"), (1000, "twice"), (1000, "twice")]
    return llm.createDataFrame(
        [(i, t, None, None, None, *["x"] * 7) for i, t in rows], DOCS + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def medium_dir():
    import os

    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("test tables are not available")
    return path
