import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or give to their results.
CLASHING = (
    "d", "m", "rid", "size", "count", "bucket", "slot", "n", "value", "start", "h", "part", "at", "hit", "t", "row", "given", "made", "_", "c", "c0", "c1",
    "rules", "match", "times", "times_id", "times_h", "copy", "_copy", "_id", "_rid", "_digest", "digest", "shard", "offset", "language",
    "quality_score", "component", "n_shingles", "kept", "taken", "target", "source_size", "z", "runs_", "score",
)


def prose(seed, n_words, vocabulary=400):
    rng = random.Random(seed)
    words = [
        "".join(rng.choice("abdeghiklmnoprstuvz") + rng.choice("aeiouäé") for _ in range(rng.randint(1, 4)))
        for _ in range(vocabulary)
    ]
    out = [rng.choice(words) for _ in range(n_words)]
    return " ".join(w + "\n" if i % 17 == 16 else w for i, w in enumerate(out))


def messy_rows():
    long = prose(1, 60_000, 20_000)
    base = prose(2, 300)
    rows = [
        (1, base, "en", "a", 5),
        (2, base, None, "a", None),
        (3, base.replace(base.split()[50], "CHANGED", 1), "de", "b", 1),
        (4, None, "en", None, 1),
        (5, "", "fr", "c", 0),
        (6, " \t\n\v\f\r ", "fr", "c", 3),
        (7, long, "en", "a", 1),
        (8, "x" * 70_000, "en", None, 1),
        (9, "the end " * 3000, "en", "b", 1),
        (10, "one", "es", "ü", 1),
        (11, "...!?", "es", "ü", 1),
        (12, "日本語 テキスト 次 行\x1c x " * 8, None, "z", 1),
        (13, prose(3, 120) + "\n" + base + "\n" + prose(4, 90), "de", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty, blank and very long texts, copies and near copies; ids are unique."""
    return spark.createDataFrame(messy_rows(), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def repeated_rows(spark):
    """Rows without an id, rows given twice, and one id with two texts."""
    rows = messy_rows()
    rows += [rows[0], rows[0], (None, rows[0][1], "en", "a", 1), (None, None, None, None, None), (None, None, None, None, None), (10, "other text here", "en", "b", 2)]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clashing(messy):
    from pyspark.sql import functions as F

    return messy.withColumns({name: F.lit("taken") for name in CLASHING})
