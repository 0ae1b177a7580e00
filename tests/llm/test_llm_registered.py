"""The queries without SQL and the whole pipeline, as registered, against plain-Python readings."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import llm_brute as brute
import numpy as np
import public_tokenizers
import pytest
from test_llm_filters import measured
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from daygauge.llm import mixing, ppm, quality, sharding


def planted():
    """Prose of four groups with exact copies, near copies, shared passages and junk."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    texts = [" ".join(prose(rng.randint(52, 70))) for _ in range(40)]
    texts += [texts[0], texts[1], texts[1].replace(" ", "\n", 7), texts[2] + " "]  # copies but for blanks
    for n in range(5, 11):  # near copies
        own = texts[n].split()
        own[rng.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    passage = " ".join(prose(20))
    texts += [" ".join([*prose(30), passage, *prose(20)]) for _ in range(3)]
    texts += [" ".join(w + "###" for w in texts[12].split()), "too short", None, "", "same three words " * 40]
    texts += ["\n".join(["one line of five words"] * 3 + [texts[13]]), " ".join(prose(700))]
    rng.shuffle(texts)
    return [(7 * n + 1, t, rng.choice(["en", "de"]), rng.choice(["a", "b", None]), n) for n, t in enumerate(texts)]


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    folder, rows = str(tmp_path_factory.mktemp("planted")), planted()
    brute.frame(spark, rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def collected(spark, name, folder):
    df = entry.queries()[name](spark, folder)
    return df.columns, sorted(tuple(r) for r in df.collect())


def test_op1_as_registered(spark, fixture):
    columns, found = collected(spark, "op1_lm_scoring", fixture[0])
    assert columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    lowered = sorted((i, brute.lower(t).encode()) for i, t, *_ in fixture[1])
    probability = brute.ppm([t for i, t in lowered if not held(i)], ppm.ORDER)
    counts = Counter(x for i, t in lowered if not held(i) for x in [*t.split(), None])
    total, kinds = sum(counts.values()), len(counts)
    for (i, own), row in zip(lowered, found, strict=True):
        tokens = [*own.split(), None]
        assert row[:5] == (i, held(i), len(tokens), sum(counts[x] > 0 for x in tokens), total)
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in tokens)
        assert row[5:] == pytest.approx((base, brute.ppm_score(probability, own, ppm.ORDER)), abs=1e-9)


def test_op2_as_registered(spark, fixture):
    columns, found = collected(spark, "op2_token_counts", fixture[0])
    assert columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {i: len(own.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in fixture[1]}
    assert found == sorted((i, len((t or "").encode()), sizes[i], sizes[i] > 1024) for i, t, *_ in fixture[1])
    assert 0 < sum(r[3] for r in found) < len(found)


def test_op3_as_registered(spark, fixture):
    columns, found = collected(spark, "op3_run_index_dedup", fixture[0])
    assert columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert found == brute.removed([r[:2] for r in fixture[1]])
    assert sum(r[2] > 0 for r in found) > 8


def test_op7_as_registered(spark, fixture):
    columns, found = collected(spark, "op7_sharding", fixture[0])
    assert columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    positions, owners = sharding.ring(16, sharding.VIRTUAL_NODES)
    arcs = defaultdict(list)
    for i, *_ in sorted(fixture[1]):
        place = int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16)
        arcs[int((positions < place).sum()) % len(positions)].append(i)
    # Round by round each arc offers what it has left to the next shard on the ring.
    free, used, at = sharding.capacities(len(fixture[1]), 16), Counter(), {}
    for step in range(len(owners)):
        for arc in sorted(arcs):
            shard = owners[(arc + step) % len(owners)]
            while arcs[arc] and used[shard] < free[shard]:
                at[arcs[arc].pop(0)] = (shard, used[shard])
                used[shard] += 1
    bodies = {i: (t or "").encode() for i, t, *_ in fixture[1]}
    assert found == sorted((i, len(b) + 1, zlib.crc32(b), "rows", *at[i], None) for i, b in bodies.items())


def sketched(values, share):
    """The first bucket that reaches the share, as its upper bound."""
    width = math.log(quality.WIDTH)
    buckets = sorted(quality.ZERO if v < quality.LEAST else math.ceil(math.log(v) / width) for v in values)
    own = buckets[max(0, math.ceil(len(buckets) * share) - 1)]
    return 0.0 if own == quality.ZERO else quality.WIDTH**own


def good(rows):
    measures = {r[0]: measured(r[1]) for r in rows}
    failed = {i: m[0] < 50 or 100 * m[5] > 50 * m[0] for i, m in measures.items()}
    def ratios(r):
        m = measures[r[0]]
        words = [(w, sum(c in "#*$%&|<>" for c in w)) for w in brute.words(r[1])]
        glued = sum(n for w, n in words if n < len(w))
        return glued / m[0], (m[2] - glued) / m[0], m[4] / m[3], m[5] / m[0], m[1] / m[0]

    groups = defaultdict(list)
    for r in rows:
        if not failed[r[0]]:
            groups[r[2:4]].append(r)
    kept = []
    for own in groups.values():
        inside = [True] * len(own)
        for n, (values, slack) in enumerate(zip(zip(*map(ratios, own)), (0.15, 0.15, 0.4, 0.25, 2.0))):
            some = [v for v in values if v >= quality.LEAST]
            if not some:
                continue
            low, middle, high = (sketched(some, share) for share in (0.25, 0.5, 0.75))
            share = len(some) / len(values)
            least, most = 0, slack + 3 * share * share * high
            if n == 4:
                least, most = middle - (middle - low) * 6 - slack, middle + (high - middle) * 6 + slack
            inside = [ok and least <= v <= most for ok, v in zip(inside, values)]
        kept += [r for r, ok in zip(own, inside) if ok]
    return kept


def without_copies(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    best = {}
    for r in rows:
        best[norm(r[1])] = min(best.get(norm(r[1]), (1, 0)), (-len(r[1]), r[0]))
    return [r for r in rows if best[norm(r[1])][1] == r[0]]


def without_near_copies(rows):
    first, _ = brute.near_components([r[:2] for r in rows])
    return [r for r, own in zip(rows, first) if r[0] == own]


def mixed(rows):
    taken = {i: n for (_, i), n in brute.mix([(r[0], r[1], r[3]) for r in rows])[1]}
    return [r for r in rows for _ in range(taken[r[0]] // len(brute.words(r[1])))]


def test_the_pipeline_as_registered(spark, fixture):
    columns, found = collected(spark, "pipeline", fixture[0])
    assert columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows, sizes = fixture[1], [len(fixture[1])]
    for stage in (good, without_copies, without_near_copies, mixed):
        rows = stage(rows)
        sizes.append(len(rows))
    # Each stage has something to do.
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] and max(Counter(r[0] for r in rows).values()) == 2
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t, *_ in rows:
        ids = own.encode(t, add_special_tokens=False).ids
        back = own.decode(ids, skip_special_tokens=False).encode()
        want.append((i, len(ids), *(hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), back))))
    assert found == sorted(want)


NO_DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_the_pipeline_of_no_documents(spark, tmp_path):
    brute.frame(spark, [], NO_DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.collect() == []


def test_the_stages_keep_columns_of_any_name(spark, tmp_path):
    """Nulls in every column, repeated rows, a very long text, and columns named as the operators' own."""
    prose = [t for _, t, *_ in planted() if t and len(t) > 300]
    docs, _ = brute.awkward(spark, [*prose[:20], None, "", " ", " ".join(prose * 40)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[name] == name for r in rows for name in ("row", "id", "body", "doc", "block", "node", "times"))
        docs = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_sharding_and_mixing_of_awkward_rows(spark):
    texts = ["a b", "c d e", None, "", " ", "x" * 300_000, "w " * 50_000, "a b"]
    docs, rows = brute.awkward(spark, texts)
    placed = sharding.sharded(docs, shards=4).collect()
    assert len(placed) == len(rows)
    assert sorted(r["size"] for r in placed) == sorted(len((t or "").encode()) + 1 for _, t, *_ in rows)
    counts = Counter(r.shard for r in placed)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in placed if r.shard == k) == list(range(n)) for k, n in counts.items())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken = Counter(str(r.doc_id) + str(r.text) for r in out.collect())
    given = Counter(str(i) + str(t) for i, t, *_ in rows)
    assert set(taken) <= set(given) and all(n <= 2 * given[k] for k, n in taken.items())
