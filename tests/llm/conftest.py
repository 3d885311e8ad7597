import pandas as pd
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    prose = "plain words of some prose that goes on and on without any end or aim but says little of note today"
    rows = [
        (0, prose, "en", "a"), (0, prose, "en", "a"), (1, prose, "en", "b"), (2, None, "en", "a"), (3, "", None, "a"),
        (None, prose + " indeed", "de", None), (None, None, None, None), (4, " \t\n\x0b ", "en", "\U0001F600"),
        (5, "very long " * 30_000, "en", "b"), (6, "one\ntwo\nOne \n\ntwo ", "fr", "z"), (7, "\n\n", "fr", ""),
        (8, "x" * 50_000, "en", "a"), (9, "É CÉ tü #1 $ % 4111 1111 1111 1111 mail a.b@c.de", "de", "a"),
    ] + [(100 + i, f"Shared Line \nown line {i}", "en", "a") for i in range(12)]
    pdf = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])
    pdf["doc_id"] = pdf["doc_id"].astype("Int64")
    names = ["size", "h", "fp", "part", "_part", "bucket", "words", "n_lines", "kept", "slot", "length", "gkey", "one", "d1", "drop"]
    for i, name in enumerate(names):
        pdf[name] = f"extra{i}"
    made = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(made, schema)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
