import pytest

SF = "/root/testdata/sf0.01"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, Unicode and columns whose names clash with results."""
    prose = " ".join(WORDS[i % 20] + WORDS[i // 20] for i in range(80))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, prose, "en"), (4, prose, "en"), (None, prose, None),
        (5, "one two", "en"), (6, "mail a.b@c.d@e.f and x@y or 1.2.3.4.5.6.7.8 999.1.1.1 +1 (23) 456-7890 4111 1111 1111 1111.", "en"),
        (7, "Ünïcode ☃ 𝒳 user@example.org token = \"abcdefgh12345678\" AKIA" + "Q7" * 8 + " " + "0f" * 20, "de"),
        (8, "secret: token: abcdefghijk password='short' key sk9Qz81LmX02PqRt77vWaBcDe 8-4 iban DE89 3704 0044 0532 0130 00 ssn 123-45-6789", "en"),
        (9, (prose + "\n") * 400, "en"), (10, ("x" * 3_000 + " ") * 100, "en"), (11, "#$% " * 60, "en"), (12, "All rights reserved. CC BY cc by general public license", "en"),
        (13, "postgres://app:hunter22@db.example.com account no 12345678 +12 3+4567 89\x0b8", "en"), (-5, "ÀÉ \x1c\x85 \xa0 x", "fr"),
    ]
    rows = [(i, t, lang, f"src{k % 2}", True, "clash", 7) for k, (i, t, lang) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept boolean, measures string, n_words int").repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
