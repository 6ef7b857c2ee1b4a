"""What the removal of repeats sends to the texts, and the orders it sorts by."""

from collections import Counter

import numpy as np
import pytest

from orderlake.llm import suffixes


def removed(documents):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(documents).collect())


@pytest.mark.parametrize("times", [1, 4])
def test_no_keys_or_spans_are_sent(spark, documents, monkeypatch, times):
    """A bitmap of 4 KB holds 2048 documents, whatever is found in them."""
    sent, hint = [], type(documents).hint

    def recorded(frame, name, *parameters):
        if name == "broadcast":
            sent.append(frame)
        return hint(frame, name, *parameters)

    more = documents.join(spark.range(times).withColumnRenamed("id", "copy")).selectExpr("doc_id + 1000 * copy AS doc_id", "text")
    monkeypatch.setattr(type(documents), "hint", recorded)
    spread = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = suffixes.remove_repeats(more)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.where("n_removed > 0").count() > 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", spread)
    assert [frame.count() for frame in sent] == [1, 1, 1]
    assert [len(frame.first()["bits"]) for frame in sent] == [suffixes.BITS // 8] * 3
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 2


def test_full_bitmaps_change_no_row(documents, monkeypatch):
    want = removed(documents)
    monkeypatch.setattr(suffixes, "MAX_BITMAPS", 1)
    monkeypatch.setattr(suffixes, "BITS", 1)
    assert removed(documents) == want


def test_letters_and_suffixes_are_in_order():
    rng = np.random.default_rng(4)
    for step in range(1, 11):
        strings = [rng.integers(97, 99, rng.integers(0, 60)).astype(np.uint8).tobytes() for _ in range(30)]
        letter, place = suffixes.letters(strings, step)
        whole = [s[i:i + step] for s in strings for i in range(len(s) + 1)]
        known = sorted({w for w in whole if len(w) == step})
        assert [known.index(w) if len(w) == step else -1 for w in whole] == (np.unique(np.append(letter, 0), return_inverse=True)[1][:-1] - 1).tolist()

        def read(i):
            while letter[i]:
                yield 1, letter[i]
                i += step
            yield 0, i

        assert suffixes.suffix_array(letter, step).tolist() == sorted(range(len(letter)), key=lambda i: list(read(i)))
