"""URL filter: rules by host and path, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygauge.llm.workspace import ascii_lower

# One of these is enough to reject.
STRICT = ("ads-track", "casino", "hentai", "keygen", "malware", "phishing", "porn", "viagra", "warez", "xxx")
# Several different ones of these reject.
SOFT = (
    "ad", "ads", "adult", "affiliate", "banner", "bet", "bets", "bonus", "cam", "click", "crack", "dating", "escort",
    "free", "gambling", "nude", "pills", "poker", "popup", "promo", "sex", "slots", "torrent", "track", "tracker", "win",
)
SOFT_LIMIT = 2
# Bytes of a vocabulary at most: it goes to every task, where its automaton takes some dozen bytes for each.
VOCABULARY_BYTES = 4 << 20


def vocabulary(
    terms: DataFrame, term: str = "term", kind: str = "kind", most_bytes: int = VOCABULARY_BYTES
) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Strict and soft terms of a table, for ``with_verdict``.

    ``kind`` is ``strict`` or ``soft``. Terms are lower-cased and count once, as strict where they
    are both; null and empty ones are left out, and an empty table gives no terms. Other columns
    are not read. Raises ValueError for another kind, a null one included, and for more than
    ``most_bytes`` of different terms, before any of them comes to the driver.
    """
    rows = terms.select(ascii_lower(F.col(term)).alias("term"), F.coalesce(F.col(kind), F.lit("")).alias("kind"))
    rows = rows.where("term <> ''").groupBy("term").agg(F.max("kind").alias("kind"), F.min("kind").alias("least"))
    known = "kind IN ('strict', 'soft') AND least IN ('strict', 'soft')"
    size, wrong = rows.selectExpr("sum(octet_length(term))", f"count_if(NOT ({known}))").first()
    if wrong:
        raise ValueError(f"{wrong} terms are neither strict nor soft")
    if (size or 0) > most_bytes:
        raise ValueError(f"the vocabulary has {size} bytes, more than {most_bytes}")
    found = sorted((r.term, r.kind) for r in rows.collect())
    return tuple(t for t, k in found if k == "strict"), tuple(t for t, k in found if k == "soft")


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    """``rule("allow", "example.org/es/")``."""
    host, _, path = name.partition("/")
    return Rule(verdict, host, "/" + path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: on up to ``?`` or ``#``.

    A null url, or one without ``://``, has an empty host and path.
    """
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, shape, 1)), F.regexp_extract(text, shape, 2)


def _matched(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, getattr(r, value)).otherwise(found)
    return found


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    """Finds every term, overlapping ones too, with its class."""
    found = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            found.add_word(term, (kind, term))
    found.make_automaton()
    return found


def _joined(url: str, at: int) -> bool:
    """Whether the character there would prolong a term: an ASCII letter or digit."""
    return 0 <= at < len(url) and url[at].isascii() and url[at].isalnum()


def term_hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """How many different strict and soft terms stand in a lower-cased url as whole words."""
    if not strict and not soft:
        return 0, 0
    hits = {
        entry
        for end, entry in _automaton(strict, soft).iter(url)
        if not _joined(url, end + 1) and not _joined(url, end - len(entry[1]))
    }
    n_strict = sum(kind == "strict" for kind, _ in hits)
    return n_strict, len(hits) - n_strict


def with_verdict(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[Rule] = (),
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
    out: str = "judged",
) -> DataFrame:
    """Add a struct column ``out``: host, path, rule, verdict, n_strict, n_soft.

    The longest rule that fits decides. Where none fits, the vocabulary does: each
    different term counts once however often it stands in the url, terms are compared
    without regard to the case of A-Z and only between characters that are no ASCII
    letters or digits; one strict or ``soft_limit`` soft terms give ``block``.

    A null or empty url has no hits and is allowed. Rows are judged one by one, so ties,
    repeated rows and empty tables need nothing; other columns stay as they are, and a
    column of the name ``out`` is replaced. The rules are arguments of the plan: a few
    thousand at most. The terms go to every task; ``vocabulary`` reads them from a table
    and checks their size.
    """
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("n_strict long, n_soft long")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            counts = [term_hits(u, strict, soft) if u else (0, 0) for u in urls]
            yield pd.DataFrame(counts, columns=["n_strict", "n_soft"], dtype="int64")

    host, path = host_and_path(F.col(url))
    by_terms = (F.col(f"{out}.n_strict") > 0) | (F.col(f"{out}.n_soft") >= soft_limit)
    by_rule = _matched(host, path, rules, "verdict")
    return pages.withColumn(out, hits(ascii_lower(F.col(url)))).withColumn(
        out,
        F.struct(
            host.alias("host"),
            path.alias("path"),
            _matched(host, path, rules, "name").alias("rule"),
            F.coalesce(by_rule, F.when(by_terms, "block").otherwise("allow")).alias("verdict"),
            F.col(f"{out}.n_strict").alias("n_strict"),
            F.col(f"{out}.n_soft").alias("n_soft"),
        ),
    )
