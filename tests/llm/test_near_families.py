"""Families of texts about as alike as the limit, against all pairs in plain Python."""

import random

from orderlake.llm import jaccard


def test_families_around_the_limit(spark):
    rng = random.Random(11)
    rows = []
    for family in range(4):
        base = [f"w{family}x{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):
            words = list(base)
            for at in rng.sample(range(120), rng.randint(0, 4)):
                words[at] = f"own{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    k, percent = 4, 85
    found = {r.doc_id: r.component_id for r in jaccard.classes(
        spark.createDataFrame(rows, "doc_id bigint, text string"), k, percent
    ).collect()}

    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} for w in (t.split() for _, t in rows)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    apart = 0
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
            elif sets[a] & sets[b]:
                apart += 1
    want = {i: root(i) for i in range(len(rows))}
    assert apart > 500 and 4 < len(set(want.values())) < len(rows)
    assert found == want
