"""URL filter, quality rules, exact duplicates."""

import hashlib
import random
import re
from collections import Counter

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

from daygauge.llm import quality, recipes, urls

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix odd potions near a quiet river bank ".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(PROSE) + rng.choice(["", "", "", "s", "ed"]) for _ in range(n))


# --- URLs ---------------------------------------------------------------------

RULES = [urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "de/")]


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://Example.ORG/es/1?q#f", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.example.org/es", "a.example.org", "/es", "org/", "allow"),
        ("http://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
        ("http://x.de", "x.de", "", None, "allow"),
        ("http://x.de/", "x.de", "/", "de/", "block"),
        ("http://porn.org/", "porn.org", "/", "org/", "allow"),
        ("http://x.com/porn.html", "x.com", "/porn.html", None, "block"),
        ("http://x.com/popcorn-banner", "x.com", "/popcorn-banner", None, "allow"),
        ("http://x.com/banner/banner", "x.com", "/banner/banner", None, "allow"),
        ("http://X.com/BANNER/popup", "x.com", "/BANNER/popup", None, "block"),
        ("http://x.com/a?u=http://porn/", "x.com", "/a", None, "block"),
        ("http://x.com/pornography", "x.com", "/pornography", None, "allow"),
        ("no url", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_url_verdicts(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "mine")], "page_id long, url string, judged string")
    row = urls.with_verdict(pages, rules=RULES).first()
    assert tuple(row.judged)[:4] == (host, path, rule, verdict)


def test_term_hits_equal_patterns():
    rng = random.Random(4)
    pieces = [*urls.STRICT, *urls.SOFT, "-", "/", ".", "x", "1", "é"]
    for _ in range(500):
        url = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        count = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", url)) for t in terms)
        assert urls.term_hits(url, urls.STRICT, urls.SOFT) == (count(urls.STRICT), count(urls.SOFT))


def test_vocabulary_from_a_table(spark):
    schema = "term string, kind string, judged string"
    rows = [("Bad", "strict", "x"), ("bad", "soft", "y"), ("So", "soft", None), ("so", "soft", ""), (None, None, ""), ("", "no", "")]
    terms = urls.vocabulary(spark.createDataFrame([*rows, ("x" * 70_000, "soft", ""), ("né", "soft", "")], schema))
    assert terms == (("bad",), ("né", "so", "x" * 70_000))
    pages = spark.createDataFrame([(1, "http://a/BAD"), (2, "http://a/so/né"), (3, "http://a/so/so"), (4, None)], "page_id long, url string")
    judged = urls.with_verdict(pages, strict=terms[0], soft=terms[1]).select("page_id", "judged.verdict").collect()
    assert sorted(map(tuple, judged)) == [(1, "block"), (2, "block"), (3, "allow"), (4, "allow")]
    with pytest.raises(ValueError, match="neither"):
        urls.vocabulary(spark.createDataFrame([("a", None, "")], schema))
    with pytest.raises(ValueError, match="more than 3"):
        urls.vocabulary(spark.createDataFrame([("abcd", "soft", "")], schema), most_bytes=3)
    none = urls.vocabulary(spark.createDataFrame([], schema))
    assert none == ((), ())
    assert {r.judged.verdict for r in urls.with_verdict(pages, strict=none[0], soft=none[1]).collect()} == {"allow"}


def test_urls_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.with_verdict(pages).collect() == []


def test_very_long_and_repeated_urls(spark):
    long = "http://a.example.com/fr/" + "x/" * 500_000 + "casino"
    rows = [(1, long), (1, long), (2, "http://" + "a." * 100_000 + "net/casino"), (None, None), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "page_id bigint, url string")
    found = urls.with_verdict(docs, rules=(urls.rule("allow", "com/fr/"),)).select("page_id", "judged.*").collect()
    assert len(found) == 6
    assert [tuple(r) for r in found if r.page_id == 1][0] == [tuple(r) for r in found if r.page_id == 1][1]
    assert all(r.verdict == "allow" and r.rule == "com/fr/" for r in found if r.page_id == 1)
    assert all(r.host == r.path == "" for r in found if r.page_id is None)


# --- quality --------------------------------------------------------------------


def measured(text):
    own = brute.words(text)
    windows = [tuple(own[k : k + 3]) for k in range(len(own) - 2)]
    counts = Counter(windows)
    covered = {k + o for k, w in enumerate(windows) if counts[w] > 1 for o in range(3)}
    lines = [line for line in (text or "").split("\n") if brute.words(line)]
    return (
        len(own),
        sum(map(len, own)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_equal_brute_force():
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a", "a a a a", "\x1fa\x85b\xa0c", "x\n\nx\n x\nx", "é # é # é # é", prose(1, 3000)]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for text in texts:
        assert quality.measure_text(text) == measured(text)


def test_sketched_quantiles_have_the_promised_error(spark):
    rng = random.Random(3)
    values = [rng.choice([0.0, rng.random() * 5, rng.random() ** 8]) for _ in range(4000)]
    table = spark.createDataFrame([("g", v) for v in values], "g string, v double").repartition(7)
    at = {"a": 0.1, "b": 0.5, "c": 0.75, "d": 0.99, "e": 1.0}
    row = quality.quantiles(quality.sketches(table, ["g"], ["v"]), ["g"], at).first()
    ordered = sorted(values)
    for name, share in at.items():
        exact = ordered[max(0, -(-len(values) * share // 1).__trunc__() - 1)]
        assert row[name] == 0 if exact < quality.LEAST else exact <= row[name] * (1 + 1e-9) <= exact * quality.WIDTH * 1.001


def test_glued_symbols():
    for text, n in ((None, 0), ("", 0), ("a b", 0), ("a### | # b|", 4), ("é# \n###", 1), ("<a> $ &&", 2)):
        assert quality.glued_symbols(text) == n


def test_bounds_follow_the_habits_of_a_group(spark):
    """A table is out of place among prose, and at home among tables; glued junk is caught in both."""
    line = lambda n: " | ".join(f"cell{(n + k) ** 3}" for k in range(0, 400, 100))
    text = {
        "prose": lambda n: prose(n, 120),
        "tables": lambda n: "\n".join(line(1000 * n + k) for k in range(30)),
        "lists": lambda n: "\n".join([prose(n, 60), *["the same closing line of words"] * 4]),
    }
    rows = [(g, kind, text[kind](n)) for g, kind in enumerate(text) for n in range(40)]
    rows += [(0, "prose", text["tables"](77)), *((g, kind, " ".join(w + "###" for w in prose(88, 120).split())) for g, kind in enumerate(text))]
    docs = brute.frame(spark, [(n, t, "en", kind, None) for n, (_, kind, t) in enumerate(rows)])
    kept = {r.doc_id for r in quality.quality(docs).where("kept").collect()}
    assert kept == set(range(120))
    measured_rows = docs.select("lang", "source", quality._measured(F.col("text")).alias("m")).select("lang", "source", "m.*")
    bounds = {r.source: r for r in quality.thresholds(measured_rows).collect()}
    for name, own in (("loose_ratio", "tables"), ("dup_line_ratio", "lists"), ("repeat_ratio", "lists"), ("word_length", "tables")):
        most = {source: bounds[source][f"most_{name}"] or 0 for source in bounds}
        assert len({round(x, 6) for x in most.values()}) > 1
        assert name == "word_length" or most[own] == max(most.values()) > 0
    assert all(0.15 < b.most_glued_ratio < 0.2 for b in bounds.values())


def test_quality_keeps_usual_and_drops_odd_documents(spark):
    usual = [prose(n, 120) for n in range(40)]
    symbols = " ".join(w + "###" for w in usual[0].split())
    again = "\n".join(["one line of five words here"] * 3 + [usual[1]])
    texts = [*usual, symbols, again, "too short", None, "", "same three words " * 40]
    docs, rows = brute.awkward(spark, texts)
    result = {(r.doc_id, r.n_words): r for r in quality.quality(docs).collect()}
    assert quality.quality(docs).count() == len(rows)
    for n, text in enumerate(texts):
        row = result[n, len(brute.words(text))]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_lines, row.n_dup_lines, row.n_repeat_words) == measured(text)
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert row.kept == (n < 40), text
    good = quality.good_documents(docs)
    assert good.columns == docs.columns
    assert sorted(r.doc_id for r in good.collect() if r.doc_id is not None) == sorted([*range(40), 1, 1])
    assert quality.good_documents(docs.limit(0)).collect() == quality.quality(docs.limit(0)).collect() == []


# --- exact duplicates -------------------------------------------------------------

LONG = prose(9, 6000)
TEXTS = [prose(1, 80), " " + prose(1, 80).replace(" ", "\n "), prose(2, 80), "", " \t", None, LONG, LONG[:-1], LONG + "\n",
         prose(1, 80).replace(" ", ""), "a b", "ab", "é" * 9000, "é" * 9000 + " ", "é" * 8999]


def copies(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    size = Counter(norm)
    best = {}
    for (i, t), n in zip(rows, norm):
        best[n] = min(best.get(n, (1, True, 0)), (-len(t or ""), i is None, i or 0))
    return sorted(
        ((i is None, i or 0), (best[n][1], best[n][2]), size[n], hashlib.sha256(n.encode()).hexdigest())
        for (i, _), n in zip(rows, norm)
    )


def weak(chunk):
    return F.length(chunk).cast("bigint") % 3


@pytest.mark.parametrize("hashed", [F.xxhash64, weak], ids=["hash", "colliding-hash"])
@pytest.mark.parametrize("least, most", [(256, 4096), (4, 16)])
def test_exact_groups_equal_brute_force(spark, hashed, least, most):
    docs, rows = brute.awkward(spark, TEXTS)
    found = recipes.exact_groups(docs, hashed=hashed, least=least, most=most).collect()
    got = sorted(
        ((r.doc_id is None, r.doc_id or 0), (r.keep_id is None, r.keep_id or 0), r.group_size, r.text_sha256) for r in found
    )
    assert got == copies([r[:2] for r in rows])
    groups = {r.text_sha256 for r in found}
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_without_copies_keeps_whole_rows(spark):
    docs, rows = brute.awkward(spark, TEXTS)
    kept = recipes.without_copies(docs)
    assert kept.columns == docs.columns
    expected = recipes.exact_groups(docs).where("kept").select("doc_id").collect()
    assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, expected))
    assert recipes.without_copies(docs.limit(0)).collect() == recipes.exact_groups(docs.limit(0)).collect() == []


def test_chunks_put_together_are_the_text(spark):
    table = spark.createDataFrame([(t,) for t in TEXTS if t], "t string")
    for least, most in ((256, 4096), (4, 16)):
        norm = recipes.normalised(F.col("t"))
        for text, cut in table.select(norm, recipes.chunks(norm, least, most)).collect():
            assert "".join(cut) == text and all(len(c) <= most for c in cut)


def test_an_insertion_leaves_most_chunks_alone(spark):
    changed = LONG[:9000] + "Inserted " + LONG[9000:]
    table = spark.createDataFrame([(LONG,), (changed,)], "t string")
    a, b = (set(r[0]) for r in table.select(recipes.chunks(recipes.normalised(F.col("t")))).collect())
    assert len(a & b) > 0.8 * len(a)


def test_exact_dedup_is_native(spark):
    docs, _ = brute.awkward(spark, TEXTS)
    plan = recipes.exact_groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
