import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls, empty and spaces-only texts, repeated rows, a long text, controls and other scripts.
TRICKY = [
    (1, "The quick brown fox\njumps over\n\nThe quick brown fox\n"), (2, None), (3, ""), (3, ""), (4, " \t\n\x0b "),
    (None, "a b c a b c a b c"), (5, "x" * 70_000 + " " + "yz " * 9_000), (6, "Größe ÉCOLE ciónñ 日本語 テキスト \U0001f600 ok"),
    (7, "one\x00two\x1cthree \x85 four five"), (7, "one\x00two\x1cthree \x85 four five"),
    (8, "<|endoftext|> <|im_end|> & &amp; &lt;| <|"), (9, "#tag *star* 100% $5 a&b x|y <b>"), (10, "İstanbul ΣΊΣΥΦΟΣ ſecret Kelvin"),
]


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with awkward rows, and extra columns whose names clash with the operators' own."""
    rows = [Row(doc_id=i, text=t, lang="en" if i and i % 2 else None, spans="s", n_words=-1, part=0, block=1, payload="p")
            for i, t in TRICKY]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, n_words int, part int, "
                                       "block int, payload string")


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.where("false")
