"""Small messy tables for the operators on training text."""

import os
import random

import pytest

from orderwell.llm.shipping import ship

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as columns of the caller's own.
CLASHES = ("row", "sha", "maybe", "size", "kept", "key", "label", "hub", "readable", "_source", "id")


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


def messy_rows() -> list[tuple]:
    rng = random.Random(4)
    words = ["the", "of", "And", "reading", "écrire", "straße", "LONG", "x1", "don't", "naïve", "a", "42"]

    def prose(n: int) -> str:
        return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))

    texts = [prose(rng.randrange(1, 120)) for _ in range(60)]
    shared = "A line that very many documents share, word for word, indeed."
    texts += [f"{prose(9)}\n  {shared.upper()}\t\n{prose(4)}" for _ in range(7)]
    texts += [texts[0], texts[0].upper(), texts[1] + " tail", prose(4), "one two", "One  two", "", None, " \n ", "12 .. 34"]
    texts += [" ".join(texts[2].split()[:-1]), prose(6000), "x" * 5000, "é́　中文 🙂\x00\x1f z", "Ünï \v\f\r\n\n cödé"]
    rows = [(i, t, ["en", "fr", "de", None][i % 4], ["s1", "s2", None, "ß", "s1"][i % 5], 0) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id at all", None, None, None), (None, "no id at all", "en", "s2", None)]
    rows += [(500, None, None, None, None), (-7, texts[5], "en", "s1", 1)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return messy_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The messy rows over several files, with clashing extra columns."""
    path = str(tmp_path_factory.mktemp("messy") / "docs")
    df = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    df.selectExpr("*", *[f"'own' AS `{c}`" for c in CLASHES]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return spark.createDataFrame([], docs.schema)


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(os.environ.get("SF_DIR", "/root/testdata/sf0.001") + "/documents.parquet")


def by_row(df, *columns):
    """Rows as a sorted list of tuples, nulls and all."""
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
