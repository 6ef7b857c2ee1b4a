import random

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Awkward documents: no text, empty, blank, very long, copies, near copies,
    repeated rows, no source, no id, and extra columns with clashing names."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(4000)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = text(60)
    rows = []
    for i in range(120):
        body = text(rng.randint(1, 90))
        if i % 5 == 0:
            body = text(20) + "\n" + passage + " " + text(30)
        rows.append((i, body, "en" if i % 3 else "de", ["a", "b", None, "a"][i % 4]))
    long = text(9000)
    rows += [(200 + i, long.replace(words[i], "swapped", 1), "en", "a") for i in range(12)]
    rows += [(300 + i, rows[7][1], "en", "b") for i in range(9)]
    rows += [(400, None, "en", "a"), (401, "", None, "b"), (402, " \t\n", "en", None), (403, "Two words", "en", "a"),
             (404, "two WORDS", "en", "a"), (405, "ab " * 400, "en", "c"), (406, "ab " * 400, "en", "c")]
    rows += [(None, text(40), None, None), rows[3], rows[3]]
    schema = "doc_id bigint, text string, lang string, source string"
    frame = spark.createDataFrame(rows, schema)
    return frame.selectExpr("*", "length(text) AS n_chars", "1 AS size", "'x' AS key", "2 AS mark", "3 AS unit", "'y' AS digest", "0.5D AS nats")


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
