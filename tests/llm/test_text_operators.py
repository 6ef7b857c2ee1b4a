"""Operators on documents against brute force, on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from orderlake.llm import chat, components, cuckoo, jaccard, kneser, language, mixing, packing, suffixes, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_dedup(documents, nothing):
    found = cuckoo.dedup(documents).collect()
    groups = defaultdict(list)
    for r in documents.collect():
        groups[r.text or ""].append(r.doc_id)
    assert len(found) == documents.count()
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        own = [r for r in found if r.text_sha256 == digest]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in own)
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [keep]
    kept = cuckoo.deduped(documents)
    assert kept.columns == documents.columns and kept.count() == len(groups)
    assert cuckoo.dedup(nothing).count() == 0 == cuckoo.deduped(nothing).count()


def test_cuckoo_filter_holds_live_keys_only():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(6000)]
    index = cuckoo.CuckooFilter({}, 8)
    for i, key in enumerate(keys):
        index.insert(key, i)
    assert all(index.find(key) == i for i, key in enumerate(keys))
    assert all(index.delete(key) for key in keys[::2]) and not index.delete(keys[0])
    assert all(index.find(key) is None for key in keys[::2])
    assert all(index.find(key) == 2 * i + 1 for i, key in enumerate(keys[1::2]))


def test_index_takes_inserts_and_deletes(spark, documents):
    some = cuckoo.digests(documents.where("doc_id < 310"))
    gone = cuckoo.digests(documents.where("doc_id >= 300 AND doc_id < 310"))
    index = cuckoo.update_index(cuckoo.empty_index(spark), 3, inserts=some)
    index = cuckoo.update_index(index, 3, deletes=gone)
    want = cuckoo.update_index(cuckoo.empty_index(spark), 3, inserts=cuckoo.digests(documents.where("doc_id < 300")))
    pick = ["bucket", "text_sha256", "group_size"]
    assert sorted(rows(index.select(pick))) == sorted(rows(want.select(pick)))


def test_mix(documents, nothing):
    found = mixing.mix_sizes(documents).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert [targets[s] for s in names] == pytest.approx(
        mixing.shares([sizes[s] for s in names], [1.0, 2.0, 3.0, 1.0])
    )
    for s in names:
        assert abs(taken[s] - targets[s]) <= 3
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix_sizes(documents).collect()))
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(WORD.findall(r.text or ""))
        assert r.text is None or r.n_chars == len(r.text)
    assert words == taken
    assert mixing.mix_sizes(nothing).count() == 0 == mixing.mix(nothing).count()
    assert mixing.shares([10, 0, 5], [1, 5, 1]) == [7.5, 0.0, 7.5]
    assert mixing.shares([1, 99], [3, 1]) == [3.0, 97.0]


def test_pack(documents, nothing):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.tokenizer_path())
    found = packing.pack_documents(documents).collect()
    have = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
    want = Counter()
    for r in documents.collect():
        ids = np.asarray(coder.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for at in range(0, len(ids), 2048):
            piece = ids[at:at + 2048]
            want[r.doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert have == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= 2048
    assert packing.pack_documents(nothing).count() == 0


def test_odd_words_keep_their_ids():
    coder = packing._Ids(packing.tokenizer_path())
    text = "İst, Σας ΣΑΣ. a<|endoftext|>b <|ENDOFTEXT|>, don't IT'S. 12\x1c3\x85é\xa0ﬁ 中文, b,, e\u0301. ...$$ --"
    coder.learn(set(text.encode().split()))
    want = np.asarray(coder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert b"".join(coder[w] for w in text.encode().split()) == want


def test_least_squares():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((8, 15)) - 0.2, rng.random(8)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert x.min() >= 0 and slope.max() < 1e-6 and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-6
    plan = packing.plan_windows({3: 10, 5: 10, 8: 4, 2: 1}, 8)
    used = Counter()
    for need, times in plan:
        assert sum(n * k for n, k in need.items()) <= 8
        used.update({n: k * times for n, k in need.items()})
    assert used == {3: 10, 5: 10, 8: 4, 2: 1}


def test_long_structured_words_differ(spark):
    """Two words of a Thue-Morse pattern, whose sums modulo 2**64 agree."""
    one = [bin(i).count("1") % 2 for i in range(2048)]
    words = ["".join("ab"[(b + flip) % 2] for b in one) for flip in (0, 1)]
    apart = [(0, f"{words[0]} x y z"), (1, f"{words[1]} x y z")]
    found = jaccard.classes(spark.createDataFrame(apart, "doc_id bigint, text string"), 4, 85)
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 1}


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_classes(documents, nothing, k, percent):
    held = [(r.doc_id, r.text) for r in documents.collect()]
    sets = []
    for _, text in held:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    label = list(range(len(held)))
    for i in range(len(held)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    small = {}
    for x, (doc_id, _) in zip(label, held):
        if doc_id is not None:
            small[x] = min(doc_id, small.get(x, doc_id))
    want = Counter(
        (d, len(s), small.get(x, d) if s else d) for (d, _), s, x in zip(held, sets, label)
    )
    found = jaccard.classes(documents, k, percent).select("doc_id", "n_shingles", "component_id")
    assert Counter(rows(found)) == want
    if k == 5:
        kept = jaccard.one_of_each(documents, k, percent)
        assert kept.columns == documents.columns
        ids = [r.doc_id for r in kept.collect()]
        assert sorted(ids, key=str) == sorted({d for d, s, c in want if d == c}, key=str)
        assert jaccard.classes(nothing).count() == 0 == jaccard.one_of_each(nothing).count()


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    label = {x: x for e in edges for x in e}
    for _ in range(50):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = dict(rows(components.components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    loops = {a for a, b in edges if a == b}
    assert {k: v for k, v in label.items() if k in found} == found and set(label) - set(found) <= loops


def test_repeats(documents, nothing):
    found = {r.doc_id: r for r in suffixes.remove_repeats(documents).collect()}
    seen, done = set(), set()
    for r in sorted(documents.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id):
        if r.doc_id in done:
            continue
        done.add(r.doc_id)
        data = (r.text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(data[i:i + 100])
        runs = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone) if not g)
        own = found[r.doc_id]
        assert (own.n_bytes, own.n_removed, own.n_spans, bytes(own.kept)) == (len(data), sum(gone), runs, kept)
    assert suffixes.remove_repeats(nothing).count() == 0


def test_merged_transforms_find_all_repeats():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint8)) for _ in range(40)]
    for length in (1, 3, 7):
        string, at, group = suffixes.repeated(strings, length)
        have = defaultdict(set)
        for s, a, g in zip(string, at, group):
            have[g].add((s, a))
        want = defaultdict(set)
        for s, x in enumerate(strings):
            for a in range(len(x) - length + 1):
                want[x[a:a + length]].add((s, a))
        assert sorted(map(sorted, have.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_language(spark, documents, nothing):
    learned = spark.createDataFrame([("en", "the cat and the dog"), ("el", "η γάτα και ο σκύλος"), (None, "x"), ("de", None)], "lang string, text string")
    model = language.fit(learned)
    texts = [(1, "the dog and the cat"), (2, "ο σκύλος και η γάτα"), (3, None), (4, " 12 !"), (5, "the cat and the dog και ο σκύλος η γάτα και ο σκύλος")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: r for r in language.identify(frame, model, switch=2.0).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["en", "el", "und", "und", "el"]
    assert [s.lang for s in found[5].spans] == ["en", "el"] and found[5].spans[0].stop == 19
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language.identify(documents, model).count() == documents.count()
    assert {r.lang_pred for r in language.identify(documents, None).collect()} == {"und"}
    assert language.fit(nothing) is None and language.identify(nothing, model).count() == 0


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(0)

    def value(scores, path, switch):
        return sum(scores[i, x] for i, x in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

    for _ in range(100):
        counts, switch = rng.integers(1, 6, 4), rng.choice([0.5, 1, 3])
        scores = rng.normal(size=(counts.sum(), 3)) * rng.choice([0.5, 2])
        path, (best, fine) = language.viterbi(scores, counts, switch), language._single(scores, counts, switch)
        for j, at in enumerate(np.cumsum(counts) - counts):
            own = scores[at:at + counts[j]]
            top = max(value(own, p, switch) for p in product(range(3), repeat=int(counts[j])))
            assert value(own, path[at:at + counts[j]], switch) == pytest.approx(top)
            assert not fine[j] or own[:, best[j]].sum() == pytest.approx(top)


def test_quality(spark, documents, nothing):
    labels = documents.where("doc_id < 120").selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    junk = spark.createDataFrame([(900, "@@##%% ^^&& !!** " * 30, "en", "a")], "doc_id bigint, text string, lang string, source string")
    mixed = documents.unionByName(junk, allowMissingColumns=True)
    found = kneser.judge(mixed, labels, quantile=1.0).collect()
    assert len(found) == mixed.count()
    gone = {r.doc_id for r in found if not r.kept}
    assert 900 in gone and not gone & set(range(120)) and not gone & {400, 401}
    kept = kneser.keep_good(mixed, labels, quantile=1.0)
    assert kept.columns == mixed.columns and kept.count() == sum(r.kept for r in found)
    assert kneser.keep_good(documents, labels.limit(0)).count() == documents.count()
    assert kneser.judge(nothing, labels).count() == 0


def test_kneser_ney_sums_to_one(documents):
    logs = kneser.fit(documents.select("text")).reshape(-1, kneser.SYMBOLS)
    assert np.exp(logs[[0, 97 << 8 | 98, 97, 5 << 8 | 6]]).sum(axis=1) == pytest.approx(1.0, abs=1e-4)


def test_chat_reads_back(spark):
    turns = [(1, 0, "user", "a~0 <s>"), (1, 1, "user", "[/INST] b"), (1, 2, "assistant", "</s>~1~"), (1, 2, "assistant", "</s>~1~"),
             (2, None, None, None), (2, 1, "assistant", ""), (None, 5, "user", "x\ny")]
    turns += [(3, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(300)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS chunk", "'q' AS item")
    for chunk in (1, 64):
        out = chat.format_chats(frame, chunk)
        read = {r[0]: r for r in out.select("conv_id", chat.read_turns(out.formatted).alias("turns"), "formatted", "segments").collect()}
        for conv in (1, 2, 3, None):
            want = sorted([(t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == conv])
            assert [tuple(t) for t in read[conv].turns] == [t[1:] for t in want]
            assert "".join(s.text for s in read[conv].segments) == read[conv].formatted
        assert read[1].formatted == "<s>user[INST]a~00 ~1s>[/INST]~2/INST] b</s><s>assistant[INST]~1/s>~01~0[/INST]~1/s>~01~0</s>"
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"), "no-scheme.org/x": ("", "", None, "allow"),
        "http://A.Example.ORG/en/17?x": ("a.example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/2#es/": ("example.org", "/en/2", "org/", "allow"),
        "http://xexample.org/es/": ("xexample.org", "/es/", "org/", "allow"),
        "http://example.org/es/a/b": ("example.org", "/es/a/b", "example.org/es/", "block"),
        "http://example.org/es": ("example.org", "/es", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "x://b.com/de/": ("b.com", "/de/", "com/de/", "block"), "x://b.com/fr/?://c.org/": ("b.com", "/fr/", "com/fr/", "allow"),
        "x://b.net/de/": ("b.net", "/de/", None, "allow"), "x://?q": ("", "", None, "allow"),
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "page_id bigint, url string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS key")
    found = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(frame, urls.RULES, "page_id").collect()}
    assert found == dict(enumerate(cases.values()))
    both = [("allow", "a.b", "/x"), ("block", "a.b", "/x"), ("allow", "b", "/x/y")]
    assert urls.UrlTrie(both).find("c.a.b", "/x/y") == ("a.b/x", "block")
    assert urls.judge_urls(frame.limit(0), urls.RULES, "page_id").count() == 0
    with pytest.raises(ValueError):
        urls.judge_urls(frame, [("allow", "a", "/")] * (urls.MAX_RULES + 1), "page_id")
