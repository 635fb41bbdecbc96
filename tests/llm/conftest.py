import pytest

# Columns whose names clash with those that the operators make.
CLASHES = "score double, kept boolean, node long, salt int, block int, digest string, dropped string, row int, n int, batch int, term string, place int"
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
COPY = "one two three four five six seven eight nine ten\nAll rights reserved.\nthe end of this text"
ROWS = [
    (1, None),
    (2, ""),
    (3, "word"),
    (4, LONG),
    (5, COPY),
    (6, COPY),
    (6, COPY),
    (7, COPY.replace("ten", "eleven")),
    (None, "a text without an id, of seven"),
    (8, " \t\n\x0b\x0c\r "),
    (9, "ÄÖ 漢字 é \U0001f600 <|endoftext|> it's  1234\n\n  x"),
    (-5, "a negative id and some words here, five or more"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    clash = (1.0, True, 1, 2, 3, "x", "y", 4, 5, 6, "z", 7)
    return spark.createDataFrame([(i, t, None, *clash) for i, t in ROWS], f"doc_id long, text string, lang string, {CLASHES}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, lang string, {CLASHES}")


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
