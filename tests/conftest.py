import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from termloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The application's seed corpus.
SEED = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (2, "the quick red fox leaped over the sleeping cat"),
    (3, "cats and dogs can be friends"),
]


@pytest.fixture(scope="session")
def seed_docs(spark):
    from termloom.sources.corpus import literal_corpus

    return literal_corpus(spark, SEED)


@pytest.fixture(scope="session")
def seed_postings(seed_docs):
    from termloom.operators.postings import build_postings

    return build_postings(seed_docs)


@pytest.fixture(scope="session")
def random_docs(spark):
    """A corpus with one term in every third document and a few hundred rarer ones."""
    import random

    rng = random.Random(7)
    rows = []
    for doc_id in range(600):
        words = [f"w{min(int(rng.expovariate(0.03)), 300)}" for _ in range(rng.randint(0, 30))]
        if doc_id % 3 == 0:
            words.append("hot")
        rows.append((doc_id, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")
