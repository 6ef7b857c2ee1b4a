"""License scans against a plain search over all word-aligned spans."""

import random
import re

import pytest

from orderlake.llm import licenses


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def edits(words, notice, keys):
    """Fewest edits between a span of words and a notice whose key words must be equal."""
    want = notice.split(" ")
    at = next((i for i, w in enumerate(want) if w in keys), None)
    if at is None:
        return distance(" ".join(words), notice)
    least = 999
    for i, w in enumerate(words):
        if w == want[at] and bool(i) == bool(at) and bool(words[i + 1:]) == bool(want[at + 1:]):
            least = min(least, distance(" ".join(words[:i]), " ".join(want[:at])) + distance(" ".join(words[i + 1:]), " ".join(want[at + 1:])))
    return least


def plain(text):
    words = words_of(text)
    base = [(i, label) for phrase, label in licenses.BASE.items() for n in [len(phrase.split())]
            for i in range(len(words) - n + 1) if words[i:i + n] == phrase.split()]
    labels, best = {label for _, label in base}, 0.0
    for notice, label, keys in licenses.NOTICES:
        bound, n = len(notice) // licenses.CHARS_AN_EDIT, len(notice.split())
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + n + bound) + 1):
                if abs(len(" ".join(words[i:j])) - len(notice)) <= bound:
                    e = edits(words[i:j], notice, keys)
                    if e <= bound:
                        labels.add(label)
                        best = max(best, 1 - e / len(notice))
    places = [i for i, _ in base]
    return (len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), 1.0 if base else best)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    fill = "some text of no license at all été 日本 mit 2 the under version apache cc by nc".split()
    rows = [None, "", " \n", "cc by nc cc by nc", "CC-BY-NC.", "ccbync", "Under the MIT\nLicense", "under the mit license2",
            "Apache License, Version 1.0", "apache license version 2", "under the mitt license"]
    for _ in range(150):
        notice = list(rng.choice(licenses.NOTICES)[0])
        for _ in range(rng.randint(0, 6)):
            i = rng.randrange(len(notice))
            notice[i] = rng.choice(["", "x", notice[i] + "e", " ", notice[i].upper()])
        rows.append(" ".join(rng.choices(fill, k=rng.randint(0, 8))) + ", " + "".join(notice) + ". " + " ".join(rng.choices(fill, k=5)))
    return rows + ["license " * 3000 + "undr the mit license", "x" * 200_000, rows[3]]


def test_equals_plain_search(spark, texts):
    rows = [(i if i != 5 else None, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, labels string").repartition(4)
    out = licenses.scan(frame).drop("matches")
    have = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert len(have) == len(rows)
    wrong = [(t, have[i], plain(t)) for i, t, _ in rows if i is not None and len(t or "") < 2000 and have[i] != plain(t)]
    assert not wrong
    assert have[len(texts) - 3][5] == "mit" and have[len(texts) - 2] == (1, 0, None, None, "", "", 0.0)
    assert sum(1 for t in texts if len(t or "") < 2000 and not plain(t)[4] and plain(t)[5]) > 20


def test_spans(spark):
    frame = spark.createDataFrame([(1, "It is undr the MIT licence, ok")], "doc_id int, text string")
    [row] = licenses.scan(frame).collect()
    assert [tuple(m) for m in row.matches] == [("mit", 2, 2, "undr the mit licence")]
    assert licenses.scan(frame.limit(0)).collect() == []
