"""How two tokenizers cut the same text: groups between common ends, links, and counts of linked ids.

Tokenizer A reads a space and the text, B the text, before which it puts a space itself. A text is
cut into chunks where both of them are bound to cut; each different chunk is encoded and aligned
once in a worker. Of the two lists of token ends the shorter one drives: each of its ends gallops
into the longer list, from the chunk's first end on in doubling steps, and then by halves. Ends in
both lists cut the groups; differences of ranks say which tokens of B a token of A overlaps.

The corpus-wide counts of id pairs are added up before they are shuffled. Frequent pairs, up to a
fixed number, are looked up in every task; a document sends only its other pairs to the table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from daygauge.llm.blocks import ascending, from_ascending, from_planes, planes
from daygauge.llm.charmap import SPACE_SYMBOL
from daygauge.llm.pieces import NORMAL, piece_model
from daygauge.llm.splitting import _TO_BYTES, LETTERS
from daygauge.llm.workspace import stored, text_slices

# Chunks that half of a worker's memory holds, and the longest one of them.
REMEMBERED, SHORT = 150_000, 48
# Pairs looked up in every task at most (17 bytes each); the others go through a join.
FREQUENT = 400_000
# Different pairs that a task holds while it counts.
HELD = 1 << 20
SLICE_CHARS = 1 << 19
# Steps in which counts are graded, for each doubling.
GRADES = 8

# White space by anyone's reading. Both tokenizers cut before a blank and around a line feed that stand alone.
# A cuts between a letter and one of the marks, and B does where none of its pieces goes across.
_MARKS = ".,;:!?#*%$&|<>()"
_SPACE = r"\s\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff"
_ODD = rf"(?:[{_SPACE}]{{2,}}|(?![ \n])[{_SPACE}])"
_REST = rf"(?: ?[^{_SPACE}]+|{_ODD}[^{_SPACE}]*)(?:{_ODD}[^{_SPACE}]*)*|[ \n]"
CHUNK = re.compile(_REST)
# Words of letters before marks that end the run, and such marks, are chunks of their own.
_END = rf"(?=[ \n][^{_SPACE}]|$)"
MARKED_CHUNK = re.compile(rf" ?[{LETTERS}]+(?=[{_MARKS}]+{_END})|(?<=[{LETTERS}])[{_MARKS}]+{_END}|{_REST}")


def gallop(ends: np.ndarray, among: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each of ``ends`` the rank of the first of ``among`` that isn't less, looked for from ``start`` on.

    Steps double until one is not less; the last step is halved. All ends take their steps together.
    """
    last = len(among) - 1
    low = start.astype(np.int64)
    high, step = low.copy(), 1
    open_ = np.flatnonzero((high <= last) & (among[np.minimum(high, last)] < ends))
    while len(open_):
        low[open_] = high[open_] + 1
        high[open_] = np.minimum(high[open_] + step, last + 1)
        step *= 2
        open_ = open_[(high[open_] <= last) & (among[np.minimum(high[open_], last)] < ends[open_])]
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        less = among[middle] < ends[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(
    a_ends: np.ndarray, b_ends: np.ndarray, a_start: np.ndarray, b_start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in both ascending lists of their common ends; the shorter list drives.

    ``a_start`` and ``b_start`` have for each end a rank in the other list that isn't beyond its place.
    """
    if len(a_ends) > len(b_ends):
        return common_ends(b_ends, a_ends, b_start, a_start)[::-1]
    if not len(a_ends):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rank = gallop(a_ends, b_ends, a_start)
    common = b_ends[np.minimum(rank, len(b_ends) - 1)] == a_ends
    return np.flatnonzero(common), rank[common]


def overlaps(
    a_ends: np.ndarray, b_ends: np.ndarray, a_common: np.ndarray, b_common: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (a, b) of all tokens that overlap; the last ends of both lists are common.

    A token of A overlaps those of B from the one that it begins in to the one that it ends in.
    Their ranks are looked for from the group's first token on.
    """
    first = np.concatenate([[0], b_common[:-1] + 1])
    starts = np.repeat(first, np.diff(a_common, prepend=-1))
    ending = gallop(a_ends, b_ends, starts)
    on_end = b_ends[ending] == a_ends
    begins = np.concatenate([[0], (ending + on_end)[:-1]])
    counts = ending - begins + 1
    a = np.repeat(np.arange(len(a_ends)), counts)
    upto = np.cumsum(counts)
    b = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - counts, counts) + np.repeat(begins, counts)
    return a, b


class Aligner:
    """Both tokenizers, and what a worker knows of chunks.

    A chunk is known as (tokens of A, of B, groups, groups as text, its linked pairs packed), or
    as None where the tokens' bytes are not the chunk's.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as file:
            made = json.load(file)
        before = made["pre_tokenizer"]
        if before["type"] != "ByteLevel" or made["normalizer"]:
            raise ValueError("tokenizer A is not byte-level")
        size = self.a.get_vocab_size(with_added_tokens=True)
        added = {t["id"] for t in made["added_tokens"]}
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [
            name.encode() if i in added else name.translate(_TO_BYTES).encode("latin-1") for i, name in enumerate(names)
        ]
        self.b = piece_model(b_path)
        self.a_widths = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_widths = np.array([len(x) for x in self.b.values], np.int64)
        spec = self.b.normalise
        in_lines = any("\n" in name for name in self.b.names)
        self.apart = (
            before.get("use_regex", True) and not before["add_prefix_space"] and self.b.apart and not in_lines
            and not spec.prefixes and not spec.squeeze and spec.dummy
        )
        across = re.compile(f"[{LETTERS}][{re.escape(_MARKS)}]")
        normal = [name for name, kind in zip(self.b.names, self.b.kinds) if kind == NORMAL]
        self.cut = CHUNK if any(map(across.search, normal)) else MARKED_CHUNK
        self.a_text, self.b_text = ([str(i) for i in range(len(x))] for x in (self.a_widths, self.b_widths))
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}
        self.long: list[str] = []

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers cut."""
        return self.cut.findall(" " + text) if self.apart else [" " + text]

    def _ids(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        if self.apart:
            return a, self.b.inner.encode([c.replace(" ", SPACE_SYMBOL) for c in chunks], num_threads=1)
        return a, [self.b.encode(c[1:])[0].tolist() for c in chunks]

    def _whole(self, chunks: list[str], a_lists: list[list[int]], b_lists: list[list[int]]) -> list[int]:
        """Places of the chunks whose bytes both lists of ids give; most often all of them do."""
        raw = [c.encode() for c in chunks]
        sizes = list(map(len, raw))
        for lists, values in ((a_lists, self.a_bytes), (b_lists, self.b.values)):
            own = [values[i] for i in chain.from_iterable(lists)]
            upto = np.array([0, *accumulate(map(len, own))])[np.array([0, *accumulate(map(len, lists))])]
            if np.diff(upto).tolist() != sizes or b"".join(own) != b"".join(raw):
                break
        else:
            return [n for n, size in enumerate(sizes) if size]
        made = ([b"".join([v[i] for i in ids]) for ids in x] for x, v in ((a_lists, self.a_bytes), (b_lists, self.b.values)))
        return [n for n, (r, a, b) in enumerate(zip(raw, *made)) if r and r == a == b]

    def aligned(self, chunks: list[str]) -> list[tuple | None]:
        """Align chunks, all in one go: one after the other they are one long text."""
        found: list[tuple | None] = [None] * len(chunks)
        a_lists, b_lists = self._ids(chunks)
        good = self._whole(chunks, a_lists, b_lists)
        if not good:
            return found
        ids, ends, firsts = [], [], []
        for lists, widths in ((a_lists, self.a_widths), (b_lists, self.b_widths)):
            own = [lists[n] for n in good]
            ids.append(np.fromiter(chain.from_iterable(own), np.int64))
            ends.append(np.cumsum(widths[ids[-1]]))
            firsts.append(np.array([0, *accumulate(map(len, own))]))
        sizes = [np.diff(f) for f in firsts]
        starts = [np.repeat(firsts[1 - k][:-1], sizes[k]) for k in range(2)]
        a_common, b_common = common_ends(*ends, *starts)
        a_link, b_link = overlaps(*ends, a_common, b_common)
        packed = (ids[0][a_link] << 32 | ids[1][b_link]).tobytes()
        link_first = np.searchsorted(a_link, firsts[0]).tolist()
        group_first = np.searchsorted(a_common, firsts[0]).tolist()
        a_text, b_text = [self.a_text[i] for i in ids[0].tolist()], [self.b_text[i] for i in ids[1].tolist()]
        cuts = zip(pairwise([0, *(a_common + 1).tolist()]), pairwise([0, *(b_common + 1).tolist()]))
        groups = [
            f"{a_text[i]}|{b_text[j]}" if k - i == 1 == m - j else f"{','.join(a_text[i:k])}|{','.join(b_text[j:m])}"
            for (i, k), (j, m) in cuts
        ]
        bounds = zip(pairwise(firsts[0].tolist()), pairwise(firsts[1].tolist()), pairwise(group_first), pairwise(link_first))
        for n, ((i, k), (j, m), (g, h), (x, y)) in zip(good, bounds):
            found[n] = (k - i, m - j, h - g, ";".join(groups[g:h]), packed[8 * x : 8 * y])
        return found

    def learn(self, texts: list[list[str]]) -> None:
        """Know all chunks of some texts. Of two halves of what is known, the one without late use goes."""
        new = set(chain.from_iterable(texts)).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.before, self.known = self.known, {}
            new = set(chain.from_iterable(texts))
        if self.before:
            again = new.intersection(self.before)
            self.known.update((c, self.before[c]) for c in again)
            new -= again
        new = list(new)
        self.known.update(zip(new, self.aligned(new)))
        self.long = [c for c in new if len(c) > SHORT]

    def forget_long(self) -> None:
        for chunk in self.long:
            self.known.pop(chunk, None)
        self.long = []


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups string"


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", out: str = "aligned") -> DataFrame:
    """Add ``out``, a struct of n_a, n_b, n_groups, n_links, groups, pairs, times.

    ``groups`` has the ids of both sides of each group in order, ``a1,a2|b1;a3|b2,b3``; ``pairs`` the
    different linked id pairs (``a << 32 | b``) ascending and ``times`` how many links each has,
    both packed (``blocks.from_ascending``, ``from_planes`` of unsigned 32 bits). Of a text that is
    null or empty, or whose tokens' bytes aren't a space and the text on both sides, all are zero
    and empty. Rows are aligned one by one, so ties and repeated rows need nothing; an empty table
    gives no rows; a very long text is aligned chunk by chunk. Other columns are kept, one named
    ``out`` is replaced.
    """
    kept = [c for c in docs.columns if c != out]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    rows = docs.select(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    fields = f"{_COUNTS}, pairs binary, times binary"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            for start, texts in text_slices(batch.column("body"), SLICE_CHARS):
                cut = [own.chunks(t) if t else [] for t in texts]
                own.learn(cut)
                made = [_summed([own.known[c] for c in chunks]) for chunks in cut]
                own.forget_long()
                names = [f.split()[0] for f in fields.split(", ")]
                kinds = [*[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
                columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
                struct = pa.StructArray.from_arrays(columns, names)
                doc = batch.column("doc").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([doc, struct], names=["doc", "made"])

    made = "struct<" + ", ".join(f.replace(" ", ": ") for f in fields.split(", ")) + ">"
    schema = StructType([rows.schema["doc"], *StructType.fromDDL(f"made {made}").fields])
    return rows.mapInArrow(align, schema).select("doc.*", F.col("made").alias(out))


def _summed(chunks: list[tuple | None]) -> tuple:
    if not chunks or None in chunks:
        return 0, 0, 0, 0, "", b"", b""
    n_a, n_b, n_groups, groups, packed = zip(*chunks)
    links = np.frombuffer(b"".join(packed), np.int64)
    pairs, times = np.unique(links, return_counts=True)
    return (
        sum(n_a), sum(n_b), sum(n_groups), len(links), ";".join(groups),
        ascending(pairs), planes(times.astype(np.uint32)),
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of rows (pairs, times): pair, n, best (whether no pair of its id of B has more)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            own = [from_ascending(x) for x in batch.column("pairs")]
            times = [from_planes(x, np.uint32).astype(np.int64) for x in batch.column("times")]
            pairs, where = np.unique(np.concatenate([pairs, *own]), return_inverse=True)
            n = np.bincount(where, np.concatenate([n, *times]), len(pairs)).astype(np.int64)
            if len(pairs) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])
                pairs, n = pairs[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    summed = rows.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    summed = stored(summed.withColumn("b", F.expr("pair & 4294967295")), "pair-counts")
    most = summed.groupBy("b").agg(F.max("n").alias("most"))
    return stored(summed.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _frequent(counts: DataFrame, frequent: int) -> pa.Table:
    """The pairs from the least grade of counts on for which they are ``frequent`` at most, ascending."""
    grade = F.floor(F.log2("n") * GRADES)
    sizes = sorted(counts.groupBy(grade.alias("g")).count().collect(), reverse=True)
    upto = accumulate(r["count"] for r in sizes)
    least = min((r.g for r, size in zip(sizes, upto) if size <= frequent), default=None)
    chosen = counts.where(grade >= least) if least is not None else counts.limit(0)
    return chosen.select("pair", "n", "best").toArrow().sort_by("pair")


def with_counts(rows: DataFrame, pairs: str, times: str, frequent: int = FREQUENT) -> DataFrame:
    """Add n_best (links whose count is the highest of their id of B) and count_sum (of all links' counts).

    A count is the number of links of an id pair in all rows. ``rows`` must be a stored table that
    has a unique number ``row``; its packed columns ``pairs`` and ``times`` (see ``aligned``) are
    dropped, columns n_best and count_sum replaced.
    """
    kept = [c for c in rows.columns if c not in (pairs, times, "row", "n_best", "count_sum")]
    plain = rows.select(
        "row", F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(pairs).alias("pairs"), F.col(times).alias("times")
    )
    counts = pair_counts(plain)
    table = _frequent(counts, frequent)
    known, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, rest, rest_times = [], [], []
            for packed, packed_times in zip(batch.column("pairs"), batch.column("times")):
                own = from_ascending(packed)
                times = from_planes(packed_times, np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                hit = known[at] == own if len(known) else np.zeros(len(own), bool)
                found = at[hit]
                sums.append((int(times[hit] @ best[found].astype(np.int64)), int(times[hit] @ n[found])))
                rest.append(own[~hit])
                rest_times.append(times[~hit])
            ends = pa.array(np.cumsum([0, *map(len, rest)]).astype(np.int32))
            columns = [batch.column("row"), batch.column("doc"), *(pa.array([s[k] for s in sums], pa.int64()) for k in range(2))]
            columns += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (rest, rest_times)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc", "hits", "hit_sum", "rest", "times"])

    schema = StructType(
        [*plain.select("row", "doc").schema.fields,
         *StructType.fromDDL("hits long, hit_sum long, rest array<long>, times array<long>").fields]
    )
    looked = stored(plain.mapInArrow(look_up, schema), "looked-up")
    rest = looked.select("row", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("row", "r.*")
    rest = rest.withColumnRenamed("rest", "pair").join(counts, "pair")
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more"), F.sum(F.expr("times * n")).alias("more_sum")
    )
    zero = F.lit(0).cast("bigint")
    return looked.join(more, "row", "left").select(
        "doc.*",
        (F.col("hits") + F.coalesce("more", zero)).alias("n_best"),
        (F.col("hit_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
    )
