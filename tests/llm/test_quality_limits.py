"""The limits of the quality classifier, language by language."""

import random

from orderlake.llm import kneser


def table(spark, trusted_small):
    """English in few letters, little trusted text of a language in more, one
    language without any, and junk."""
    rng = random.Random(11)

    def text(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))

    rows = [(i, text("abc", 60), "en") for i in range(300)]
    words = text("".join(map(chr, range(97, 117))), 200).split()
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(300)), "xx") for i in range(40)]
    rows += [(2000 + i, text("uvwxyz", 60), "yy") for i in range(5)] + [(2100, text("uvwxyz", 60), None)]
    rows += [(3000, "@@##%% ^^&& !!** " * 30, "en"), (3001, "@@##%% ^^&& !!** " * 30, "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trusted = [i for i, _, lang in rows if i < 300 or 1000 <= i < 1000 + trusted_small]
    return docs, spark.createDataFrame([(i, 1, 0) for i in trusted], "doc_id bigint, quality int, toxic int")


def test_little_trusted_text_has_its_own_limit(spark):
    docs, labels = table(spark, 20)
    gone = {r.doc_id for r in kneser.judge(docs, labels).where("NOT kept").collect()}
    assert {3000, 3001} <= gone
    assert not gone & set(range(1000, 2200))


def test_languages_without_trusted_text_stay(spark):
    docs, labels = table(spark, 0)
    judged = {r.doc_id: r for r in kneser.judge(docs, labels).collect()}
    assert not judged[3000].kept
    assert all(r.kept and r.threshold is None for r in judged.values() if r.lang != "en")


def test_limits_move_smoothly_with_trusted_documents(spark):
    """Beside 100 others, the 100th trusted document moves a limit like any other."""
    limits = {}
    for n in (98, 99, 100, 101):
        rows = [(i, "a", float(100 + i % 7), 100) for i in range(400)]
        rows += [(1000 + i, "b", float(200 + i % 5), 100) for i in range(n)]
        scored = spark.createDataFrame(rows, "doc_id bigint, lang string, nats double, chars bigint")
        trusted = scored.selectExpr("doc_id AS trusted_id")
        limits[n] = {r.language: r.most for r in kneser.thresholds(scored, trusted, 0.999).collect()}["b"]
    steps = [abs(limits[n + 1] - limits[n]) for n in (98, 99, 100)]
    assert max(steps) < 0.01


def test_columns_with_the_names_of_joined_ones(spark):
    docs, labels = table(spark, 20)
    clash = docs.selectExpr("*", "1 AS kn_doc", "'x' AS kn_lang", "2 AS kn_tie", "3 AS run", "4 AS gram")
    kept = kneser.keep_good(clash, labels)
    assert kept.columns == clash.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in kneser.keep_good(docs, labels).collect()}
