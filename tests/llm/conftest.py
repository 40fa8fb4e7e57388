import random

import pytest

# names that operators use inside, as extra columns
NAMES = "_id _none _tag none id tag k doc root entry bands parts pass whole d s i a b t at_ bucket bucket_at inside taken times shard target source_size slots frame content path file ordinal offset length place ids band n pairs x y fingerprint node component_id record member digest payload item_id edits similarity row half".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash long, size long, at int, fp string, key string, first int, toxicity double, start int, value string, " + ", ".join(f"{c} string" for c in NAMES)


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and very long texts, ties and repeated rows."""
    long = prose(1, 60_000)
    base = [
        (1, prose(2, 80), "a"),
        (2, prose(2, 80) + " tail", "a"),
        (2, prose(2, 80) + " tail", "a"),
        (3, None, "b"),
        (4, "", "b"),
        (5, " \t\n\x0b\f\r ", None),
        (6, long, "hot"),
        (7, long[: len(long) // 2], "hot"),
        (8, "one", "c"),
        (9, "one  two three\nOne", "c"),
        (10, "Grüße 漢字 😀 naïve <|endoftext|> don't", None),
        (None, prose(2, 40), "a"),
        (None, None, None),
        (11, prose(3, 200), "hot"),
        (12, prose(3, 200), "hot"),
    ]
    return base


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, 3, "4", "5", 6, 0.5, 7, "8", *NAMES) for i, t, s in rows], SCHEMA)
