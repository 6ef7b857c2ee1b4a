"""What a large family of near copies costs, and components of chains."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from orderlake.llm import components, jaccard, packing


def _family(rng, size, words, most):
    base = [f"w{rng.randrange(10**9)}" for _ in range(words)]
    out = []
    for _ in range(size):
        text = list(base)
        for at in rng.sample(range(words), rng.randint(0, most)):
            text[at] = f"own{rng.randrange(10**9)}"
        out.append(" ".join(text))
    return out


def test_pairs_of_a_family_grow_with_it_and_not_with_its_square(spark, monkeypatch):
    rng = random.Random(3)
    rows = list(enumerate(_family(rng, 300, 140, 7)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    rows_of, plain = {}, jaccard.stage

    def counted(df, name):
        out = plain(df, name)
        rows_of.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    found = {r.doc_id: r.component_id for r in jaccard.classes(docs, 4, 85).collect()}
    assert max(rows_of["open-pairs"] + rows_of["led-pairs"]) < 2 * len(rows)

    sets = [{tuple(w[i:i + 4]) for i in range(len(w) - 3)} for w in (t.split() for _, t in rows)]
    want = list(range(len(rows)))

    def root(i):
        return i if want[i] == i else root(want[i])

    links = 0
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                links += 1
                low, high = sorted((root(a), root(b)))
                want[high] = low
    assert links > 4 * len(rows)
    assert found == {i: root(i) for i in range(len(rows))}


def test_long_texts_with_common_parts_are_not_compared_whole(spark, monkeypatch):
    rng = random.Random(5)
    parts = [" ".join(f"p{rng.randrange(10**9)}" for _ in range(12)) for _ in range(40)]
    rows = []
    for i in range(40):
        own = [" ".join(f"x{rng.randrange(10**9)}" for _ in range(30)) for _ in range(40)]
        rows.append((i, " ".join(x for pair in zip(own, rng.sample(parts, 40)) for x in pair)))
    copy = rows[7][1].split()
    copy[5] = "changed"
    rows.append((40, " ".join(copy)))
    pairs, plain = [], jaccard.stage

    def counted(df, name):
        out = plain(df, name)
        if name == "compared":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    found = jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i for i in range(40)} | {40: 7}
    assert sum(pairs) < 10


def test_components_of_chains_stars_and_repeated_edges(spark):
    edges = [(1, 2), (2, 1), (2, 3), (5, 4), (4, 6), (6, 7), (9, 8), (10, 10), (12, 11), (13, 11), (20, 30), (30, 25)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(frame).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4, 8: 8, 9: 8, 11: 11, 12: 11, 13: 11, 20: 20, 25: 20, 30: 20}


def test_solver_holds_no_square_of_its_columns():
    rng = np.random.default_rng(1)
    a = np.zeros((60, 4000))
    for j in range(a.shape[1]):
        a[rng.integers(0, 60, 3), j] += 1
    want = np.where(rng.random(4000) < 0.01, rng.integers(1, 50, 4000), 0).astype(float)
    tracemalloc.start()
    x = packing.nnls(a, a @ want)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (x >= 0).all() and np.allclose(a @ x, a @ want, atol=1e-3)
    assert peak < 20e6


def test_entries_are_counted_once_and_shared_ones_kept_over_batches():
    rng = random.Random(6)
    rows = sorted((rng.randrange(60), rng.randrange(4), rng.randrange(3)) for _ in range(150))
    held = {}
    for token, sig, n in rows:
        held.setdefault(token, set()).add(sig)
    entries = sorted({(t, s) for t, s, _ in rows})
    want = [(t, s) for t, s in entries if len(held[t]) > 1]
    table = pa.RecordBatch.from_pydict({"token": [t for t, _, _ in rows], "sig": [s for _, s, _ in rows]})
    for size in (1, 2, 7, 150):
        parts = [table.slice(at, size) for at in range(0, len(rows), size)]
        found = jaccard._shared_batches(jaccard._distinct_batches(iter([table.slice(0, 0), *parts])))
        assert [(r["token"], r["sig"]) for batch in found for r in batch.to_pylist()] == want


def test_texts_are_not_moved_to_leave_near_copies_out(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 10:i * 10 + 40]), "x") for i in range(30)]
    rows += [(100, rows[3][1] + " more", "x"), rows[5], rows[5], (None, "no id at all", "x"), (200, "", "x"), (200, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_doc string")
    kept = jaccard.one_of_each(docs)
    plain = jaccard.one_of_each(spark.createDataFrame([*{*rows}], docs.schema))
    want = sorted((r for r in {*rows} if r[0] != 100), key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == want == sorted(map(tuple, plain.collect()), key=str)
    plan = plain._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
