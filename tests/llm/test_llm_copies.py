"""Near-duplicates and repeated passages."""

import random

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from daygauge.llm import near_dup, run_index
from daygauge.llm.rlbwt import RunIndex


def near_texts(seed):
    """Chains and groups of near copies, and pairs on both sides of the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = []
    for size, edits, group in ((60, 1, 12), (200, 4, 40), (120, 3, 25), (400, 14, 15)):
        base = text(size)
        for _ in range(group):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    link = text(80)
    for _ in range(12):  # a chain: each like the one before
        link = [*link[3:], *text(3)]
        texts.append(" ".join(link))
    texts += [" ".join(text(rng.randint(0, 90))) for _ in range(30)]
    texts += ["a b c", "A  B\tc", "a b", "a b c d e", "a b c d e f", "É x", "é x", "", None, " \n"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(
    "seed, leaders, block_bytes, broadcast", [(1, 6, 2 << 20, 4_000_000), (2, 1, 20_000, 0), (3, 2, 5_000, 0)]
)
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, leaders, block_bytes, broadcast):
    monkeypatch.setattr(near_dup, "LEADERS", leaders)
    monkeypatch.setattr(near_dup, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", block_bytes)
    docs, rows = brute.awkward(spark, near_texts(seed))
    first, sizes = brute.near_components([r[:2] for r in rows])
    found = near_dup.near_duplicates(docs.repartition(3)).collect()
    want = sorted((str(i), n, str(c)) for (i, *_), n, c in zip(rows, sizes, first))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == want
    kept = [r for r in found if r.kept]
    assert all(r.doc_id == r.component_id for r in kept)
    linked = [r for r in kept if r.n_shingles]
    assert len(linked) == len({r.component_id for r in found if r.n_shingles})
    whole = near_dup.without_near_duplicates(docs)
    assert whole.columns == docs.columns and whole.count() == len(kept)


def test_a_third_of_all_documents_in_one_group(spark, monkeypatch):
    """Their comparison is dealt out by pairs of blocks, and components are those of brute force."""
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 20_000)
    rng = random.Random(6)
    vocabulary = [f"w{n}" for n in range(5000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, texts = text(110), [" ".join(text(40)) for _ in range(240)]
    for _ in range(120):  # some within the threshold of each other, some not
        own = list(base)
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(" ".join(own))
    compared = []
    left_over = near_dup._left_over
    monkeypatch.setattr(near_dup, "_left_over", lambda *a: compared.append(left_over(*a)) or compared[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert found == dict(enumerate(brute.near_components(list(enumerate(texts)))[0]))
    assert "hashpartitioning(group" in compared[0]._jdf.queryExecution().toString()
    assert ", block" in compared[0]._jdf.queryExecution().toString().split("MapInArrow")[-1]


def test_near_duplicates_of_an_empty_table(spark):
    docs = brute.frame(spark, [])
    assert near_dup.near_duplicates(docs).collect() == near_dup.without_near_duplicates(docs).collect() == []


def test_every_coordinate_of_a_sketch_is_filled():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 100, 5000):
        sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for _ in range(3)]
        assert (near_dup.sketches(sets) != near_dup.EMPTY).all()
    assert near_dup.sketches([]).shape == (0, 128)


def test_sketches_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    shares = []
    for _ in range(200):
        both = rng.integers(0, 1 << 63, 60).astype(np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, 10).astype(np.uint64)]) for _ in "ab")
        x, y = near_dup.sketches([a, b])
        shares.append((x == y).mean())
    assert abs(np.mean(shares) - 60 / 80) < 0.01


def test_components_of_a_long_chain(spark):
    edges = [(n, n + 1) for n in range(100, 160)] + [(300, 200), (200, 250), (7, 7)]
    found = near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {n: 100 for n in range(100, 161)} | {200: 200, 250: 200, 300: 200, 7: 7}
    assert {r.node: r.root for r in found} == roots


# --- repeated passages --------------------------------------------------------------


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        letters, window = int(rng.integers(1, 4)), int(rng.integers(8, 12))
        make = lambda n, more: bytes(rng.integers(0, letters + more, n).astype(np.uint8))
        strings = [make(rng.integers(window, 40), 0) for _ in range(rng.integers(1, 10))]
        keys = rng.integers(0, 5, len(strings))
        index = RunIndex(strings, keys, window)
        queries = [*strings, *(make(rng.integers(1, 40), 1) for _ in range(4))]
        lengths, rows, places, begins = index.matching_statistics(queries)
        smallest = index.smallest_key(rows)
        for query, begin in zip(queries, begins):
            for at in range(len(query)):
                best = max(n for n in range(len(query) - at + 1) if any(query[at : at + n] in s for s in strings))
                assert lengths[begin + at] == best
                own = index.text[places[begin + at] :][:best] - 1
                assert bytes(own.astype(np.uint8)) == query[at : at + best]
                if best >= window:
                    have = [k for k, s in zip(keys, strings) if query[at : at + window] in s]
                    assert smallest[begin + at] == min(have)


def test_index_of_a_repetitive_corpus_grows_with_its_runs():
    rng = np.random.default_rng(2)
    base = bytes(rng.integers(97, 123, 4000).astype(np.uint8))

    def made(copies):
        strings = []
        for _ in range(copies):
            own = bytearray(base)
            own[rng.integers(len(base))] = 65
            strings.append(bytes(own))
        return RunIndex(strings, np.arange(copies), 50)

    few, many = made(4), made(64)
    assert many.rows == 16 * few.rows
    assert len(many.run_key) < 3 * len(few.run_key)
    # Beside the text, a byte a symbol, the index has a few bytes for each copy's own windows.
    beside = [index.nbytes - len(index.text) for index in (few, many)]
    assert beside[1] < 3 * beside[0] and many.nbytes < 4 * many.rows


def test_byte_255_is_refused():
    with pytest.raises(ValueError):
        RunIndex([b"a\xffb"], np.array([1]), 2)


def test_matching_statistics_decide_what_is_removed(monkeypatch):
    rng = np.random.default_rng(5)
    shared = bytes(rng.integers(97, 105, 70).astype(np.uint8))
    snippets = [b"a" * 20 + shared, b"b" * 20 + shared, b"c" * 80 + shared[:30], b"c" * 81]
    keys, anchors = np.array([7, 9, 3, 4]), np.array([1, 1, 2, 2], np.uint32)
    want = []
    for key, s in zip(keys, snippets):
        for at in range(len(s) - 49):
            want.append(min(k for k, other in zip(keys, snippets) if s[at : at + 50] in other))
    found, _ = run_index.smallest_keys(snippets, keys, anchors, 50)
    assert found.tolist() == want and want != np.repeat(keys, [len(s) - 49 for s in snippets]).tolist()
    streamed = RunIndex.matching_statistics
    for constant in (0, 50):
        monkeypatch.setattr(
            RunIndex, "matching_statistics", lambda *a, n=constant: (np.full_like((r := streamed(*a))[0], n), *r[1:])
        )
        assert run_index.smallest_keys(snippets, keys, anchors, 50)[0].tolist() != want


def passages(seed):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (49, 50, 51, 60, 120, 300)]
    texts = []
    for _ in range(90):
        own = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 80)))
        pieces = [rng.choice([*shared, "x" * rng.randint(1, 90), "é" * rng.randint(1, 40), own()]) for _ in range(rng.randint(0, 5))]
        texts.append("".join(pieces) if rng.random() > 0.05 else None)
    return [*texts, "x" * 3000, "x" * 49, "x" * 50, "y" * 700, "ab" * 400, "ab" * 300, texts[4]]


@pytest.mark.parametrize(
    "sizes", [{}, {"many": 2, "block_bytes": 2000, "part_bytes": 1000}], ids=["as-is", "hot-anchors-small-blocks"]
)
def test_removed_passages_equal_brute_force(spark, sizes):
    docs, rows = brute.awkward(spark, passages(3))
    docs = docs.withColumn("doc_id", F.col("doc_id") * 37 % 101)
    rows = [(i if i is None else i * 37 % 101, t) for i, t, *_ in rows]
    found = run_index.repeated_spans(docs, **sizes).collect()
    got = []
    for r in found:
        size = sum(s.end - s.start for s in r.spans)
        assert r.n_bytes - size == len(r.kept)
        got.append((1 << 63 if r.doc_id is None else r.doc_id, r.n_bytes, size, len(r.spans), brute.hashlib.sha256(r.kept).hexdigest()))
    assert sorted(got) == brute.removed(rows)


def test_a_block_sends_a_window_of_many_documents_once():
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    texts = [f"{n:05d} " + "".join(rng.choice("xyz") for _ in range(30)) + passage for n in range(300)]
    docs = run_index.pa.table({
        "block": run_index.pa.array([0] * 300, run_index.pa.int32()), "row": range(300), "id": range(300), "body": texts
    })
    copies = run_index._notes("copy", run_index.pa.array([0]), run_index.pa.nulls(1), [b""])
    asked = run_index._ask_anchors(1, 50, 20)(docs, copies)
    repeated = run_index._repeated(128)(asked)
    sent = run_index._ask_snippets(1, 4, 50, 20)(docs, run_index.pa.concat_tables([copies, repeated], promote_options="permissive"))
    shared = {passage[k : k + 50] for k in range(len(passage) - 49)}
    # Keys that go to another task: one a window, not one for each of the 300 documents that have it.
    moved = [r for r in sent.to_pylist() if r.get("kind") != "place"]
    assert 0 < sum(len(r["id"]) // 8 for r in moved) < 300 * len(shared) // 5
    pieces = [run_index.zstandard.ZstdDecompressor().decompress(r["bytes"]) for r in moved if r["kind"] == "window"]
    windows = [p[k : k + 50].decode() for p in pieces for k in range(0, len(p), 50)]
    assert len(windows) == len(set(windows)) and shared & set(windows)


def test_no_passages_in_an_empty_table(spark):
    assert run_index.repeated_spans(brute.frame(spark, [])).collect() == []


def test_an_index_of_many_strings_of_one_anchor(monkeypatch):
    monkeypatch.setattr(run_index, "LOAD", 200)
    rng = np.random.default_rng(4)
    strings = list({bytes(rng.integers(97, 99, 60).astype(np.uint8)) for _ in range(40)})
    keys, anchors = np.arange(len(strings), dtype=np.int64)[::-1].copy(), rng.integers(0, 6, len(strings)).astype(np.uint32)
    found, begins = run_index.smallest_keys(strings, keys, anchors, 50)
    for own, begin, anchor in zip(strings, begins, anchors):
        for at in range(len(own) - 49):
            same = [k for s, k, a in zip(strings, keys, anchors) if a == anchor and own[at : at + 50] in s]
            assert found[begin + at] == min(same)
