"""The sharded language model against plain Python."""

import math
import random
from collections import Counter

import pytest

from orderlake.llm import kneser, ngrams


def plain(trusted, order):
    """Probability of an n-gram by interpolated modified Kneser-Ney."""
    levels = {order: Counter(g for t in trusted for g in places(t, order))}
    for n in range(order, 1, -1):
        levels[n - 1] = Counter(g[1:] for g in levels[n])
    off, totals, kinds = {}, {}, {}
    for n, counts in levels.items():
        t = [sum(c == i for c in counts.values()) for i in range(1, 5)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] else 0
        off[n] = [
            min(max(i - (i + 1) * y * t[i] / t[i - 1], 0.1), i) if t[i - 1] and y else 0.5 for i in (1, 2, 3)
        ]
        totals[n], kinds[n] = Counter(), Counter()
        for g, c in counts.items():
            totals[n][g[:-1]] += c
            kinds[n][g[:-1]] += off[n][min(c, 3) - 1]

    def p(g):
        n, context = len(g), g[:-1]
        lower = p(g[1:]) if n > 1 else 1 / (len(levels[1]) + 1)
        if not totals[n][context]:
            return lower
        c = levels[n][g]
        own = (c - off[n][min(c, 3) - 1]) / totals[n][context] if c else 0
        return own + kinds[n][context] / totals[n][context] * lower

    return p


def places(text, order):
    padded = "\0" * (order - 1) + text + "\0"
    return [padded[i:i + order] for i in range(len(text) + 1)]


@pytest.mark.parametrize("order", [1, 2, 5])
def test_model_equals_plain_python(spark, order):
    rng = random.Random(4)
    words = ["the", "cat", "собака", "дом", "中文", "字", "ßé", "😀", "a"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    rows = [(i, i, t) for i, t in enumerate(texts)] + [(100, 1, "zz 漢漢漢 the"), (None, 7, "the cat"), (5, 5, texts[5]), (101, 2, ""), (103, 4, "a" * 9000), (102, 3, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, tie bigint, text string")
    p = plain(texts[:30], order)
    model = ngrams.Model(frame.where("doc_id < 30").dropDuplicates(), order)
    # Runs of some texts each, over several partitions.
    found = {(r.doc_id, r.tie): r for r in ngrams.score(frame.repartition(3, "tie"), model, 700).collect()}
    assert set(found) == {(d, t) for d, t, x in rows if x}
    for d, t, x in rows:
        if x:
            assert found[d, t].chars == len(x) + 1
            assert found[d, t].nats == pytest.approx(-sum(math.log(p(g)) for g in places(x, order)), rel=1e-9)


def test_many_symbols_stay_exact():
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 20000))) * 2
    grams, number, sizes = ngrams.grams_of([text, "ab"], 5)
    want = places(text, 5) + places("ab", 5)
    assert [grams[i] for i in number] == want and len(grams) == len(set(want)) and list(sizes) == [40001, 3]


def test_foreign_letters_are_not_folded(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("абвгдежзиклмн") for _ in range(rng.randint(4, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)), "ru") for i in range(150)]
    # The same letters moved to code points that the old folding could not tell apart.
    table = kneser.symbol_table()
    twin = {}
    for c in "абвгдежзиклмн":
        twin[ord(c)] = next(x for x in range(0x4E00, 0x9FFF) if table[x] == table[ord(c)])
    rows.append((500, rows[0][1].translate(twin), "ru"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.where("doc_id < 120").selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    gone = {r.doc_id for r in kneser.judge(docs, labels).where("NOT kept").collect()}
    assert gone == {500}
