"""The conversation trie against SQL, over shards of many sizes."""

import random

import numpy as np
import oracle
import duckdb
import pytest

from orderlake.llm import trie


def matched(spark, rows, run_turns):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, path string, least int")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    out = trie.prefix_trie(trie.replanted(trie.turn_lists(frame)), run_turns)
    return oracle.mismatch(out, con, trie.OP13_SQL)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "é", "long text"]), "p", 1))
    # A crowd of copies, a long conversation and its copy, missing values, negative ids.
    rows += [(100 + c, t, "user", f"copy {t}", "p", 1) for c in range(80) for t in range(3)]
    rows += [(c, t, "user", f"line {t}", "p", 1) for c in (300, 301, 305) for t in range(300)]
    rows += [(400, None, "user", "first", "p", 1), (400, 3, None, None, "p", 1), (400, 3, "user", "", "p", 1),
             (None, 1, "user", "nobody", "p", 1), (-7, 0, "user", "a", "p", 1), (501, 0, "user", "alone", "p", 1)]
    return rows


@pytest.mark.parametrize("run_turns", [1, 40, 700, trie.RUN_TURNS])
def test_equals_sql(spark, rows, run_turns):
    assert matched(spark, rows, run_turns) is None


def test_no_conversation(spark):
    assert matched(spark, [], 10) is None


def test_repeated_rows_are_turns(spark):
    assert matched(spark, [(2, 1, "user", "same", "p", 1)] * 30 + [(3, 1, "user", "same", "p", 1)] * 30, 5) is None


@pytest.mark.parametrize("turns", [1, 63, 64, 65, 5000])
def test_parentheses(turns):
    """Matching parentheses and leaf pairs against a stack."""
    rng, bits, depth = random.Random(turns), [1], 1
    for _ in range(2 * turns):
        up = depth == 1 or rng.random() < 0.55
        bits.append(int(up))
        depth += 1 if up else -1
    bits = np.array(bits + [0] * depth, np.uint8)
    opens, stack, close = np.flatnonzero(bits), [], {}
    for i, bit in enumerate(bits.tolist()):
        if bit:
            stack.append(i)
        else:
            close[stack.pop()] = i
    tree = trie.Parentheses(bits)
    found = tree.findclose(opens)
    assert found.tolist() == [close[i] for i in opens.tolist()]
    leaves = [sum(bits[i] == 1 and bits[i + 1] == 0 for i in range(a, b)) for a, b in zip(opens.tolist()[:50], found.tolist()[:50])]
    assert tree.leaves(opens, found).tolist()[:50] == leaves
