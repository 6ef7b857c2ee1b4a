"""Equal rows at a budget's end, and buckets of the index that become empty."""

from collections import Counter

import pytest

from orderlake.llm import cuckoo, mixing


def test_equal_rows_at_the_cut(spark):
    same = [(7, "a b c", "one")] * 400 + [(i, "x y z w", "two") for i in range(50)]
    documents = spark.createDataFrame(same, "doc_id bigint, text string, source string").repartition(7)
    found = mixing.mix_sizes(documents).collect()
    taken, targets, parts = Counter(), {}, Counter()
    for r in found:
        taken[r.source] += r.taken
        targets[r.source] = r.target
        parts[r.source] += r.taken % r.size > 0
    assert targets == pytest.approx({"one": 800.0, "two": 600.0})
    assert all(abs(taken[s] - targets[s]) < 1 for s in targets) and max(parts.values()) <= 1
    mixed = mixing.mix(documents).collect()
    assert Counter(w for r in mixed for w in [r.source] * len(r.text.split())) == taken
    assert Counter((r.source, r.taken) for r in found) == Counter((r.source, r.taken) for r in mixing.mix_sizes(documents).collect())


def test_bucket_that_becomes_empty(spark):
    keyed = cuckoo.digests(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string"))
    index = cuckoo.update_index(cuckoo.empty_index(spark), 1, inserts=keyed)
    assert index.count() == 2
    assert cuckoo.update_index(index, 1, deletes=keyed).count() == 0
