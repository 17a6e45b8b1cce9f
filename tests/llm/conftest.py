import public_tokenizers
import pytest

from olapflow.llm.base import settle


@pytest.fixture(autouse=True)
def settings(spark):
    settle(spark)


@pytest.fixture(scope="session")
def bpe():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def library(bpe):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe)


@pytest.fixture
def docs(spark):
    """Makes a frame of documents with columns that clash with what operators add."""

    def make(rows):
        schema = "doc_id long, text string, source string, n_chars long, kept string, size int, n_lines string, root string"
        full = [(i, t, s, len(t) if t is not None else None, "kept?", 7, "lines?", "r") for i, t, s in rows]
        return spark.createDataFrame(full, schema)

    return make
