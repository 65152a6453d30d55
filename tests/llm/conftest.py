import re

import pytest

from strata.llm.shipping import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from rows of (doc_id, text[, lang, source, n_chars, ...extra])."""
    def make(*rows, extra=""):
        width = 5 + extra.count(",")
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], DOCS + extra)
    return make


@pytest.fixture(scope="session")
def small_docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


def thue_morse(n=1024):
    """A word of n letters and its complement: equal under any polynomial hash modulo 2**64."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))
