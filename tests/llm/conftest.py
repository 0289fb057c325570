import random
from contextlib import contextmanager

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
VOWELS, HARD = "aeiou", "bdfgklmnprst"


def prose(rng, n):
    """n invented words with some sentences and lines."""
    words = ["".join(rng.choice(HARD) + rng.choice(VOWELS) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + (".\n" if i % 23 == 22 else "." if i % 9 == 8 else "") for i, w in enumerate(words))


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, wordless and very long texts, repeated rows, clashing columns."""
    rng = random.Random(3)
    long = prose(rng, 60_000)
    rows = [
        (1, "It is a small text, and it ends here.", "en", "s", 1),
        (1, "It is a small text, and it ends here.", "en", "s", 1),
        (2, None, "en", "s", 1),
        (3, "", None, None, None),
        (4, " \n\t\n !!! ", "en", "s", 1),
        (None, "Ein Text ohne Nummer, der hier steht.", "de", "s", 1),
        (None, None, None, None, None),
        (5, long, "xx", "s", 1),
        (6, long, "xx", "s", 1),
        (7, "naïve Straße 日本語 \U0001f600 don't we'll 12 3½\r\n  x", "en", "s", 1),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("other") for c in ("row", "key", "words", "n_words", "mark", "span", "score", "lang_pred", "digest", "known", "license", "band", "block", "grade", "kept", "place")})


@pytest.fixture
def noted_jobs(spark):
    """with noted_jobs() as stages: sees the jobs inside, under 64 shuffle partitions that stay apart; stages() then gives the tasks of each of their stages by job."""
    context, n = spark.sparkContext, 0
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}

    @contextmanager
    def noted():
        nonlocal n
        n += 1
        name, tracker = f"noted-{n}-{random.random()}", context.statusTracker()
        before = {k: spark.conf.get(k) for k in settings}
        context.setJobGroup(name, name)
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            yield lambda: {j: [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)] for j in tracker.getJobIdsForGroup(name)}
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
            context.setLocalProperty("spark.jobGroup.id", None)

    return noted


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
