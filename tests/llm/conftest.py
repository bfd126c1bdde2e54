import pytest

ODD = ["", " ", "\n", "a", "one two", "Tab\tand\x0bmore\x0c.", "é ß Ω 日本 😀", "x" * 30000, "word " * 9000, "<|endoftext|> <s>", "a@b.co or +1 (614) 555-8001 or 10.0.0.1 or 4111111111111111", None, None, "same text again here", "same text again here"]


@pytest.fixture
def odd(spark):
    """Documents with nulls in any column, empty and long texts, repeated rows and clashing names."""
    rows = [(i if i != 11 else None, t, None if i % 2 else "en", "src0", None, True, "c", -1) for i, t in enumerate(ODD)]
    rows.append((14, ODD[14], "en", "src0", 5, True, "c", -1))  # the same id and text twice
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, cleaned string, fp int")


@pytest.fixture
def none(odd):
    return odd.where("false")


@pytest.fixture
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
