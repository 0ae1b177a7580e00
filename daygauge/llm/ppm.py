"""Score texts by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``order`` bytes, with the counts of the symbols
that follow each in the training texts: 256 bytes and the end of the text. A symbol is coded
in its longest context; where it never followed there, an escape is coded and the context is
shortened by its oldest byte. Escapes are estimated by method D: a symbol seen c times of T
has (2c - 1) / 2T, and an escape q / 2T for q different symbols. Symbols of the contexts that
were escaped from are excluded from the shorter ones. Below the empty context all symbols not
yet excluded are equally likely, so the probabilities of the symbols in a context add up to 1.

Since the model is trained beforehand, what a position costs depends on its context and
symbol only. So the trie is a table of (context, symbol) with counts, dealt out by the last
two bytes of the context: a part then holds whole subtrees, in which all longer contexts find
their shorter ones, down to contexts of one byte, whose counts (at most 256 * 257) go to all
tasks. The model grows with the corpus and is never in one place.

Where very many (context, symbol) share an ending, as most of a text's sentences do, its subtree
is dealt out by one byte more, and again if need be. A part then has not all of the shorter
contexts it needs, so their counts (at most 257 each) are a table, of which each part gets the
rows of its own contexts. That table grows with the corpus and never leaves Spark.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from daygauge.llm.blocks import BATCH_ROWS, BLOCK_BYTES, batches, in_blocks
from daygauge.llm.blocks import ascending, from_ascending, from_planes, planes
from daygauge.llm.workspace import stored

# With the number of a text in a batch, (context, symbol) has to fit into 63 bits: 5 bytes at most.
ORDER = 5
END = 256
SYMBOLS = 257
# Contexts with so many questions under them, over all blocks, are dealt out by one byte more.
HOT = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def event(text: str, as_words: bool = False) -> bytes:
    """The bytes that are scored: the lower-cased text, or its words with one blank between them."""
    lowered = text.encode().translate(_LOWER)
    return b" ".join(lowered.split()) if as_words else lowered


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each (context, symbol) of the texts, and how many each text has.

    A text is its bytes and then its end; before the first byte stand blanks. In the number the
    nearest byte of the context comes first, so contexts with a common ending are neighbours;
    the symbol is in the last nine bits.
    """
    pad = b" " * order
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    flat = np.frombuffer(b"".join([x for t in texts for x in (pad, t, b"\0")]), np.uint8)
    starts = np.cumsum(lengths + order) - lengths
    symbols = flat.astype(np.int64)
    codes = symbols.copy()
    codes[starts + lengths - 1] = END
    for back in range(order):
        shift = 9 + 8 * (order - 1 - back)
        codes[back + 1 :] |= symbols[: len(symbols) - back - 1] << shift
    inside = np.ones(len(codes), bool)
    for back in range(1, order + 1):
        inside[starts - back] = False
    return codes[inside], lengths


def summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different numbers in ascending order with the sums of their counts."""
    different, at = np.unique(numbers, return_inverse=True)
    return different, np.bincount(at, counts, len(different)).astype(np.int64)


class Below:
    """The contexts of one byte and none, dense: counts, and log10 probabilities."""

    def __init__(self, ones: np.ndarray):
        """``ones``: counts of shape (256, SYMBOLS)."""
        none = ones.sum(axis=0)
        q, t = np.count_nonzero(none), none.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.full(SYMBOLS, -np.log10(SYMBOLS - q) if q < SYMBOLS else 0.0)
            first = _started(none, t, q, rest, rest)
        self.counts = ones
        self.total, self.kinds = ones.sum(axis=1), np.count_nonzero(ones, axis=1)
        overlap = np.where(ones > 0, none[None, :], 0).sum(axis=1)
        shape = ones.shape
        self.rest = _escaped(
            np.broadcast_to(self.total[:, None], shape),
            np.broadcast_to(self.kinds[:, None], shape),
            np.broadcast_to((t - overlap)[:, None], shape),
            np.broadcast_to((q - self.kinds)[:, None], shape),
            np.broadcast_to(none, shape),
            np.broadcast_to(rest, shape),
            np.broadcast_to(first, shape),
        )
        self.started = _started(ones, self.total[:, None], self.kinds[:, None], self.rest, first)


def _started(c, t, q, rest, shorter):
    """log10 of a symbol's probability in a context from which nothing is excluded.

    rest: behind an escape; shorter: in the next shorter context, for a context never seen.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = np.where(q == SYMBOLS, c / t, (2 * c - 1) / (2 * t))
        found = np.where(c > 0, np.log10(seen), np.log10(q / (2 * t)) + rest)
    return np.where(t == 0, shorter, found)


def _escaped(t, q, left, kinds, c, rest, started):
    """log10 of a symbol's probability in the next shorter context, behind an escape from a longer one.

    t, q: of the longer context; left, kinds: count and number of the shorter one's symbols
    that aren't excluded; c, rest: of the symbol there; started: without an exclusion there.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = np.where(kinds + q == SYMBOLS, c / left, (2 * c - 1) / (2 * left))
        found = np.where(c > 0, np.log10(seen), np.log10(kinds / (2 * left)) + rest)
    return np.where(t == 0, started, np.where(left == 0, rest, found))


# Of contexts that are dealt out by more bytes, by their length: (context, symbol) in ascending order, counts.
Split = dict[int, tuple[np.ndarray, np.ndarray]]


def _whole(numbers: np.ndarray, counts: np.ndarray, given: tuple[np.ndarray, np.ndarray]):
    """Give contexts whose subtree is in several parts all their symbols and counts."""
    partial = np.isin(numbers >> 9, given[0] >> 9)
    own = np.isin(given[0] >> 9, numbers[partial] >> 9)
    numbers = np.concatenate([numbers[~partial], given[0][own]])
    counts = np.concatenate([counts[~partial], given[1][own]])
    order = np.argsort(numbers)
    return numbers[order], counts[order]


def costs(
    numbers: np.ndarray, counts: np.ndarray, below: Below, order: int, split: Split | None = None
) -> np.ndarray:
    """log10 probability of each (context, symbol), given whole subtrees, but for ``split``, in ascending order."""
    levels = [(numbers, counts)]
    parents = []
    for length in range(order - 1, 1, -1):
        keys = levels[-1][0]
        shorter = (keys >> 17 << 9) | (keys & 511)
        different, at = np.unique(shorter, return_inverse=True)
        totals = np.bincount(at, levels[-1][1], len(different)).astype(np.int64)
        if split and length in split:
            different, totals = _whole(different, totals, split[length])
            at = np.searchsorted(different, shorter)
        parents.append(at)
        levels.append((different, totals))

    keys = levels[-1][0]
    one, symbol = keys >> 17, keys & 511
    c_up, rest_up, started_up = below.counts[one, symbol], below.rest[one, symbol], below.started[one, symbol]
    t_up, q_up = below.total[one], below.kinds[one]
    for depth in range(len(levels) - 1, -1, -1):
        keys, c = levels[depth]
        context, of = np.unique(keys >> 9, return_inverse=True)
        t = np.bincount(of, c, len(context)).astype(np.int64)[of]
        q = np.bincount(of, c > 0, len(context)).astype(np.int64)[of]
        overlap = np.bincount(of, np.where(c > 0, c_up, 0), len(context)).astype(np.int64)[of]
        rest = _escaped(t, q, t_up - overlap, q_up - q, c_up, rest_up, started_up)
        started = _started(c, t, q, rest, started_up)
        if depth:
            at = parents[depth - 1]
            c_up, rest_up, started_up, t_up, q_up = c[at], rest[at], started[at], t[at], q[at]
    return started


def _asked(texts: list[bytes], train: np.ndarray, order: int):
    """Different grams and different words of some texts, with their counts in training texts."""
    codes, lengths = grams(texts, order)
    learnt = np.repeat(train, lengths)
    seen, n = np.unique(codes[learnt], return_counts=True)
    other = np.unique(codes[~learnt])
    words: Counter = Counter()
    for own, is_train in zip(texts, train):
        if is_train:
            words.update(own.split())
    for own, is_train in zip(texts, train):
        if not is_train:
            words.update(dict.fromkeys(own.split(), 0))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
    counts = np.fromiter(words.values(), np.int64, len(words))
    both = np.concatenate([seen, other]), np.concatenate([n, np.zeros(len(other), np.int64)])
    return both, (hashes, counts)


def _context(numbers: np.ndarray, length: int, order: int) -> np.ndarray:
    """The last ``length`` bytes of the contexts."""
    return numbers >> (9 + 8 * (order - length))


def _part_of(kind: str, numbers: np.ndarray, parts: int, order: int, length: int = 2) -> np.ndarray:
    """Grams go by the last two bytes of their context, or ``length``, words by their hash."""
    key = _context(numbers, length, order) if kind == "gram" else numbers
    return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _block_questions(table: pa.Table, order: int, as_words: bool) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """A block's different grams and words with their training counts."""
    train = ~np.array(table.column("held_out").to_pylist(), bool)
    asked: dict[str, list] = {"gram": [], "word": []}
    for start, texts in batches(table, "body"):
        events = [event(t, as_words) for t in texts]
        for kind, found in zip(asked, _asked(events, train[start : start + len(texts)], order)):
            asked[kind].append(found)
    return {kind: summed(*map(np.concatenate, zip(*found))) for kind, found in asked.items()}


QUESTIONS = "kind string, part int, block int, numbers binary, counts binary"
ANSWERS = "kind string, part int, block int, numbers binary, vals binary, distinct long"
ANSWER_SCHEMA = pa.schema(
    [("kind", pa.string()), ("part", pa.int32()), ("block", pa.int32())]
    + [("numbers", pa.binary()), ("vals", pa.binary()), ("distinct", pa.int64())]
)


def _ask(parts: int, order: int, as_words: bool = False):
    def ask(table: pa.Table) -> pa.Table:
        rows = []
        block = table.column("block")[0].as_py()
        for kind, (numbers, counts) in _block_questions(table, order, as_words).items():
            part = _part_of(kind, numbers, parts, order)
            for p in np.unique(part).tolist():
                own = part == p
                packed = ascending(numbers[own]), planes(counts[own].astype(np.uint32))
                rows.append({"kind": kind, "part": p, "block": block, "numbers": packed[0], "counts": packed[1]})
        kinds = [("kind", pa.string()), ("part", pa.int32()), ("block", pa.int32())]
        return pa.Table.from_pylist(rows, pa.schema([*kinds, ("numbers", pa.binary()), ("counts", pa.binary())]))

    return ask


HOT_ROWS = "part int, length int, context long"


def _heavy(least: int, order: int):
    """Contexts of two bytes or more that ``least`` of a block's questions are under, with their number.

    Codes are in ascending order, so the questions under a context are neighbours.
    """

    def heavy(batches):
        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("numbers")):
                codes = from_ascending(packed)
                for length in range(2, order):
                    own = _context(codes, length, order)
                    ends = np.flatnonzero(np.diff(own, append=-1))
                    asked = np.diff(ends, prepend=-1)
                    many = asked >= least
                    contexts, asked = own[ends[many]], asked[many]
                    columns = [np.full(len(asked), part, np.int32), np.full(len(asked), length, np.int32), contexts, asked]
                    names = ["part", "length", "context", "asked"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return heavy


def hot_contexts(questions: DataFrame, blocks: int, order: int, hot: int) -> DataFrame:
    """Contexts to be dealt out by one byte more, with the part that their questions would be in.

    Blocks name those under which they have their share of ``hot`` questions, and what they name
    has to add up to half of ``hot``. So no other context has more than one and a half times
    ``hot`` questions, and the shorter endings of a hot context are hot too.
    """
    grams = questions.where("kind = 'gram'").select("part", "numbers")
    named = grams.mapInArrow(_heavy(max(1, hot // blocks), order), f"{HOT_ROWS}, asked long")
    found = named.groupBy("part", "length", "context").agg(F.sum("asked").alias("asked"))
    return stored(found.where(F.col("asked") >= hot / 2).drop("asked"), "ppm-hot-contexts")


def _with_hot(questions: DataFrame, hot: DataFrame) -> DataFrame:
    """Give the questions of a part its hot contexts."""
    of_part = hot.groupBy("part").agg(F.collect_list(F.struct("length", "context")).alias("hot"))
    # Words are joined by their part too, so that no null key gathers them, and then have none.
    own = F.when(F.col("kind") == "gram", F.col("hot"))
    return questions.join(of_part, "part", "left").withColumn("hot", own)


def _by_length(hot: pa.Scalar, order: int) -> dict[int, np.ndarray]:
    """Hot contexts in ascending order, by their length."""
    found: dict[int, list[int]] = {}
    for each in hot.as_py() or []:
        found.setdefault(each["length"], []).append(each["context"])
    return {length: np.sort(np.array(found[length], np.int64)) for length in sorted(found)}


def _moved(parts: int, order: int):
    """Send questions under hot contexts to parts by one byte more than the longest such context has."""

    def moved(batches):
        names = [field.split()[0] for field in QUESTIONS.split(", ")]
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                contexts = _by_length(row.column("hot")[0], order)
                if not contexts:
                    yield row.select(names)
                    continue
                numbers = from_ascending(row.column("numbers")[0])
                counts = from_planes(row.column("counts")[0], np.uint32)
                part = np.full(len(numbers), row.column("part")[0].as_py())
                for length, own in contexts.items():
                    under = np.isin(_context(numbers, length, order), own)
                    part[under] = _part_of("gram", numbers[under], parts, order, length + 1)
                each = np.unique(part)
                cut = [part == p for p in each]
                columns = [
                    pa.array(["gram"] * len(each), pa.string()),
                    pa.array(each, pa.int32()),
                    pa.array([row.column("block")[0].as_py()] * len(each), pa.int32()),
                    pa.array([ascending(numbers[own]) for own in cut], pa.binary()),
                    pa.array([planes(counts[own]) for own in cut], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return moved


def _hot_counts(order: int):
    """A block's counts of the symbols behind each hot context, at most 257 each."""

    def counted(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                contexts = _by_length(batch.column("hot")[at], order)
                codes = from_ascending(batch.column("numbers")[at])
                counts = from_planes(batch.column("counts")[at], np.uint32)
                for length, hot in contexts.items():
                    own = _context(codes, length, order)
                    under = np.isin(own, hot)
                    keys, n = summed((own[under] << 9) | (codes[under] & 511), counts[under])
                    columns = [np.full(len(keys), length, np.int32), keys >> 9, keys & 511, n]
                    names = ["length", "context", "symbol", "n"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return counted


def _needed(parts: int, order: int):
    """For each hot context, the parts that its questions go to, with it and its shorter endings."""

    def needed(batches):
        for batch in batches:
            length, context = (batch.column(c).to_numpy() for c in ("length", "context"))
            for n in np.unique(length).tolist():
                own = context[length == n]
                longer = ((own[:, None] << 8) | np.arange(256)).ravel()
                # ``_part_of`` looks at a question's context: the bytes below its ending don't matter.
                part = _part_of("gram", longer << (9 + 8 * (order - n - 1)), parts, order, n + 1)
                for shorter in range(2, n + 1):
                    ending = longer >> (8 * (n + 1 - shorter))
                    columns = [part.astype(np.int32), np.full(len(part), shorter, np.int32), ending]
                    names = ["part", "length", "context"]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return needed


def dealt_out(questions: DataFrame, hot: DataFrame, parts: int, order: int) -> tuple[DataFrame, DataFrame]:
    """The questions dealt to their parts, and for each part the counts of the hot contexts that it needs.

    The counts have a row per part, length and context, with symbols and counts as arrays.
    """
    asked = _with_hot(questions, hot)
    counted = asked.where("hot IS NOT NULL").select("numbers", "counts", "hot")
    counted = counted.mapInArrow(_hot_counts(order), "length int, context long, symbol long, n long")
    each = counted.groupBy("length", "context", "symbol").agg(F.sum("n").alias("n"))
    behind = each.groupBy("length", "context").agg(F.sort_array(F.collect_list(F.struct("symbol", "n"))).alias("behind"))
    needed = hot.mapInArrow(_needed(parts, order), HOT_ROWS).distinct()
    split = needed.join(behind, ["length", "context"]).select(
        F.lit("gram").alias("kind"), "part", "length", "context",
        F.col("behind.symbol").alias("symbols"), F.col("behind.n").alias("counts"),
    )
    return asked.mapInArrow(_moved(parts, order), QUESTIONS), split


def _split_of(shared: pa.Table) -> Split:
    """A part's counts of hot contexts, by the contexts' length."""
    lengths = shared.column("length").to_numpy()
    split: Split = {}
    for length in np.unique(lengths).tolist():
        own = shared.filter(pa.array(lengths == length)).sort_by("context").combine_chunks()
        symbols, counts = pc.list_flatten(own.column("symbols")), pc.list_flatten(own.column("counts"))
        contexts = np.repeat(own.column("context").to_numpy(), pc.list_value_length(own.column("symbols")).to_numpy())
        split[length] = ((contexts << 9) | symbols.to_numpy(), counts.to_numpy())
    return split


def _answer(below: Below, order: int):
    """Add up a part's counts over all blocks, and give each block the values of what it asked."""

    def answer(table: pa.Table, shared: pa.Table | None = None) -> pa.Table:
        if not len(table):
            return pa.Table.from_pylist([], ANSWER_SCHEMA)
        kind = table.column("kind")[0].as_py()
        split = _split_of(shared) if shared is not None and len(shared) else None
        numbers = [from_ascending(x) for x in table.column("numbers")]
        counts = [from_planes(x, np.uint32) for x in table.column("counts")]
        different, totals = summed(np.concatenate(numbers), np.concatenate(counts))
        values = costs(different, totals, below, order, split) if kind == "gram" else totals.astype(np.float64)
        sent = [planes(values[np.searchsorted(different, own)]) for own in numbers]
        distinct = [int(np.count_nonzero(totals))] + [0] * (len(sent) - 1)
        answered = table.select(["kind", "part", "block", "numbers"])
        answered = answered.append_column("vals", pa.array(sent, pa.binary()))
        return answered.append_column("distinct", pa.array(distinct, pa.int64()))

    return answer


def _values(answers: pa.Table, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A block's numbers of one kind in ascending order with their values."""
    rows = [i for i, k in enumerate(answers.column("kind").to_pylist()) if k == kind]
    if not rows:
        return np.empty(0, np.int64), np.empty(0)
    numbers = np.concatenate([from_ascending(answers.column("numbers")[i]) for i in rows])
    values = np.concatenate([from_planes(answers.column("vals")[i], np.float64) for i in rows])
    order = np.argsort(numbers)
    return numbers[order], values[order]


class _WordValues(dict):
    """Values of words, looked up by their hash when they are first met."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.hashes, self.values_of = hashes, values

    def __missing__(self, word: bytes) -> float:
        number = np.uint64(xxhash.xxh3_64_intdigest(word)).view(np.int64)
        value = self[word] = float(self.values_of[np.searchsorted(self.hashes, number)])
        return value


def _totals(codes: np.ndarray, lengths: np.ndarray, gram: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Sum up the costs of each text's grams. In ascending order equal grams are looked up once."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    packed = np.sort(codes * BATCH_ROWS + of)
    codes, of = packed // BATCH_ROWS, packed % BATCH_ROWS
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    each = cost[np.searchsorted(gram, codes[first])]
    return np.bincount(of, np.repeat(each, np.diff(np.append(first, len(codes)))), len(lengths))


def _score(order: int, as_words: bool = False):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        gram, cost = _values(answers, "gram")
        values = _WordValues(*_values(answers, "word"))
        words, known, logs, scores = [], [], [], []
        for _, texts in batches(docs, "body"):
            events = [event(t, as_words) for t in texts]
            codes, lengths = grams(events, order)
            scores.append(_totals(codes, lengths, gram, cost))
            split = [e.split() for e in events]
            n = np.array([len(s) for s in split], np.int64)
            found = np.fromiter((v for s in split for v in map(values.__getitem__, s)), np.float64, int(n.sum()))
            of = np.repeat(np.arange(len(split)), n)
            words.append(n)
            known.append(np.bincount(of, found > 0, len(split)).astype(np.int64))
            logs.append(np.bincount(of, np.log10(found + 0.5), len(split)))
        found = [pa.array(np.concatenate(x)) for x in (words, known, logs, scores)]
        names = ["id", "held_out", "n_words", "n_known", "log_counts", "score"]
        return pa.Table.from_arrays([docs.column("id"), docs.column("held_out"), *found], names=names)

    return score


def byte_counts(questions: DataFrame, order: int) -> np.ndarray:
    """Counts of the symbols behind each byte, which all tasks have: 256 * 257 at most."""

    def counted(batches):
        for batch in batches:
            for numbers, counts in zip(batch.column("numbers"), batch.column("counts")):
                codes = from_ascending(numbers)
                keys, n = summed((_context(codes, 1, order) << 9) | (codes & 511), from_planes(counts, np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    pairs = questions.where("kind = 'gram'").select("numbers", "counts").mapInArrow(counted, "key long, n long")
    rows = pairs.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys = rows.column("key").to_numpy()
    ones = np.zeros((256, SYMBOLS), np.int64)
    ones[keys >> 9, keys & 511] = rows.column("n").to_numpy()
    return ones


def scored(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
    as_words: bool = False,
) -> DataFrame:
    """One row per document: the key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents whose crc32 of the key, as text, isn't 1 modulo 5 (a
    null key counts as empty) and scores all. A-Z are lower-cased; tokens are words and one
    end of the text. base_score adds log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, for c the
    token's and N all tokens of training, V of them different; score is the log10 probability
    of the lower-cased text as it stands, white space included, and the end; with ``as_words``, of
    its words with one blank between them and the end, the event that the base model scores. A
    null or empty text is the end alone. Without training documents every symbol is equally likely, and so is every word.
    Repeated rows are learnt and scored each by itself; an empty table gives no rows. Words are
    counted by 64-bit hashes. Other columns are not read.
    """
    if not 2 <= order <= ORDER:
        raise ValueError(f"order must be from 2 to {ORDER}")
    name = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("id"),
        (F.crc32(name) % 5 == 1).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    table, blocks = in_blocks(rows, "body", block_bytes)
    texts = table.select("block", "held_out", "body")
    asked = texts.groupBy("block").applyInArrow(_ask(blocks, order, as_words), QUESTIONS)
    questions = stored(asked, "ppm-questions")
    answer = _answer(Below(byte_counts(questions, order)), order)
    heavy = hot_contexts(questions, blocks, order, hot)
    if heavy.isEmpty():
        answers = questions.groupBy("kind", "part").applyInArrow(lambda table: answer(table), ANSWERS)
    else:
        dealt, split = dealt_out(questions, heavy, blocks, order)
        parts = dealt.groupBy("kind", "part").cogroup(split.groupBy("kind", "part"))
        answers = parts.applyInArrow(lambda table, shared: answer(table, shared), ANSWERS)
    answers = stored(answers, "ppm-answers")
    schema = StructType(
        [table.schema["id"], StructField("held_out", BooleanType())]
        + [StructField(name, LongType()) for name in ("n_words", "n_known")]
        + [StructField(name, DoubleType()) for name in ("log_counts", "score")]
    )
    asked = table.select("block", "id", "held_out", "body").groupBy("block")
    scores = stored(asked.cogroup(answers.groupBy("block")).applyInArrow(_score(order, as_words), schema), "ppm-scores")

    ends, learnt = scores.where("NOT held_out").agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    distinct = answers.agg(F.sum(F.when(F.col("kind") == "word", F.col("distinct")))).first()[0] or 0
    total, kinds = learnt + ends, distinct + (ends > 0)
    tokens = F.col("n_words") + 1
    all_logs = F.col("log_counts") + F.log10(F.lit(ends + 0.5))
    return scores.select(
        F.col("id").alias(key),
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (all_logs - tokens * F.log10(F.lit(total + 0.5 * (kinds + 1)))).alias("base_score"),
        "score",
    )
