"""Word BPE, encoded and decoded; long text without a split is encoded by tree concatenation.

Most texts fall into short pre-tokens, and a worker encodes each different one once. Long
texts are cut into parts that Spark deals out. A long pre-token, which the merges may tie
together from end to end, is cut in halves again and again down to leaves; the leaves are
encoded apart from each other, and neighbours are joined bottom-up: the tokens around the
join are encoded anew, in a window that grows until its first and last token are those that
the two sides had. A sequence of tokens is the encoding of its text if each neighbouring
pair is the encoding of its own text; inside the window and in each side the pairs are such,
and the tokens at the window's ends are shared, so the joined sequence is the encoding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType
from tokenizers import models

from daygauge.llm.splitting import as_characters, sections, special_ids, split_words, tokenizer, word_pieces
from daygauge.llm.workspace import text_slices

# Texts of more characters are dealt out in parts of about PART characters.
LONG = 32_768
PART = 8_192
# Pre-tokens of more characters are cut into leaves of at most LEAF characters.
LEAF = 1_024
WINDOW = 4
# Different pre-tokens that a worker remembers.
REMEMBERED = 200_000


class _Known(dict):
    """Packed ids of pre-tokens, made when a pre-token is first met."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= LEAF:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Ids of pieces, as packed little-endian unsigned 32-bit integers, and texts of ids."""

    def __init__(self, path: str):
        own = tokenizer(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.path = path
        self.whole = own.model
        self.suffix = model["end_of_word_suffix"] or ""
        self.inner = models.BPE(vocab=model["vocab"], merges=[tuple(m) for m in model["merges"]])
        self.specials = special_ids(path)
        size = own.get_vocab_size(with_added_tokens=True)
        self.values = [own.id_to_token(i) or "" for i in range(size)]
        self.known = _Known(lambda piece: self.leaf(piece, True))

    def pieces(self, pieces: list[str]) -> bytes:
        """The ids of whole pre-tokens."""
        return b"".join(map(self.known.__getitem__, pieces))

    def leaf(self, piece: str, last: bool) -> bytes:
        """The ids of a cut from a pre-token; only the last one ends a word."""
        return pack(self._tokens(as_characters(piece), last))

    def _tokens(self, characters: str, last: bool) -> list[int]:
        model = self.whole if last else self.inner
        return [t.id for t in model.tokenize(characters)]

    def joined(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of a text from the encodings of its two halves."""
        width = WINDOW
        while True:
            a, b = left[-width:], right[:width]
            at_end = last and len(b) == len(right)
            text = "".join(self.values[i] for i in (*a, *b))
            window = self._tokens(text.removesuffix(self.suffix) if at_end else text, at_end)
            left_agrees = len(a) == len(left) or window[0] == a[0]
            right_agrees = len(b) == len(right) or window[-1] == b[-1]
            if left_agrees and right_agrees:
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2

    def tree(self, leaves: list[list[int]], last: bool = True) -> list[int]:
        """Join neighbouring halves, bottom-up."""
        if len(leaves) == 1:
            return leaves[0]
        half = len(leaves) // 2
        return self.joined(self.tree(leaves[:half], False), self.tree(leaves[half:], last), last)

    def text(self, ids: bytes) -> str:
        """Tokens put together with blanks, as the library does without a decoder."""
        values = self.values
        return " ".join([values[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a file, made once in each Python worker."""
    return Codec(path)


def pack(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def unpack(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def halves(piece: str, leaf: int = LEAF) -> list[str]:
    """Cut a long piece in halves until each is short enough; together they are the piece."""
    if len(piece) <= leaf:
        return [piece]
    half = len(piece) // 2
    return halves(piece[:half], leaf) + halves(piece[half:], leaf)


def text_parts(text: str, path: str, part: int = PART, leaf: int = LEAF) -> list[tuple[str, int, str]]:
    """Parts of a text in order: (kind, cut, body).

    kind ``pieces`` has whole pre-tokens with blanks between them, ``special`` a special string,
    and ``leaf`` one leaf of a long pre-token, where ``cut`` tells which: 1 the first, 2 an
    inner one, 3 the last.
    """
    parts: list[tuple[str, int, str]] = []
    held: list[str] = []
    size = 0

    def flush():
        nonlocal held, size
        if held:
            parts.append(("pieces", 0, " ".join(held)))
        held, size = [], 0

    for at, section in enumerate(sections(text, path)):
        if at % 2:
            flush()
            parts.append(("special", 0, section))
            continue
        for piece in word_pieces(section, path):
            if len(piece) > leaf:
                flush()
                leaves = halves(piece, leaf)
                marks = [1] + [2] * (len(leaves) - 2) + [3]
                parts += [("leaf", mark, own) for mark, own in zip(marks, leaves)]
                continue
            held.append(piece)
            size += len(piece)
            if size >= part:
                flush()
    flush()
    return parts


def encode_part(own: Codec, kind: str, cut: int, body: str) -> bytes:
    if kind == "special":
        return pack([own.specials[body]])
    if kind == "leaf":
        return own.leaf(body, cut == 3)
    return own.pieces(split_words(body, own.path))


def join_parts(own: Codec, parts: list[tuple[int, bytes]]) -> bytes:
    """Put the ids of parts (cut, ids) together, joining the leaves of each long pre-token."""
    found, leaves = [], []
    for cut, ids in parts:
        if not cut:
            found.append(ids)
            continue
        leaves.append(unpack(ids))
        if cut == 3:
            found.append(pack(own.tree(leaves)))
            leaves = []
    return b"".join(found)


def encode_text(text: str | None, path: str, leaf: int = LEAF) -> bytes:
    """Encode one text; a null one has no ids."""
    own, found = codec(path), []
    for at, section in enumerate(sections(text or "", path)):
        if at % 2:
            found.append(pack([own.specials[section]]))
            continue
        pieces = word_pieces(section, path)
        if len(section) > leaf and max(map(len, pieces), default=0) > leaf:
            parts = text_parts(section, path, leaf=leaf)
            found.append(join_parts(own, [(cut, encode_part(own, kind, cut, body)) for kind, cut, body in parts]))
        else:
            found.append(own.pieces(pieces))
    return b"".join(found)


def _schema(rows: DataFrame, *fields: tuple[str, DataType]) -> StructType:
    return StructType([rows.schema["doc"], *(StructField(name, kind) for name, kind in fields)])


def _encoded_short(rows: DataFrame, path: str, leaf: int) -> DataFrame:
    """Of rows (doc, body): doc, ids, decoded."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column("body")):
                ids = [encode_text(t, path, leaf) for t in texts]
                text = [codec(path).text(i) for i in ids]
                columns = [batch.column("doc").slice(start, len(ids))]
                columns += [pa.array(ids, pa.binary()), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "ids", "decoded"])

    schema = _schema(rows, ("ids", BinaryType()), ("decoded", StringType()))
    return rows.select("doc", "body").mapInArrow(encode, schema)


PART_FIELDS = "array<struct<kind:string,cut:int,body:string>>"


def _encoded_long(rows: DataFrame, path: str, part: int, leaf: int) -> DataFrame:
    """Of rows (doc, body, row): doc, ids, decoded. Parts of a text are encoded in different tasks."""

    @F.pandas_udf(PART_FIELDS)
    def cut_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            cut = [[{"kind": k, "cut": c, "body": b} for k, c, b in text_parts(t, path, part, leaf)] for t in texts]
            yield pd.Series(cut, dtype="object")

    @F.pandas_udf("binary")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for parts in batches:
            yield pd.Series([encode_part(codec(path), *p) for p in zip(*parts)], dtype="object")

    @F.pandas_udf("ids binary, decoded string")
    def join(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for cuts, ids in batches:
            own = codec(path)
            whole = [join_parts(own, list(zip(c, i))) for c, i in zip(cuts, ids)]
            yield pd.DataFrame({"ids": whole, "decoded": [own.text(w) for w in whole]})

    parts = rows.select("row", "doc", F.posexplode_outer(cut_up("body")).alias("at", "p"))
    first = F.when(F.coalesce("at", F.lit(0)) == 0, F.col("doc")).alias("doc")
    spread = parts.select("row", first, "at", "p.*").repartition("row", "at")
    encoded_parts = spread.select(
        "row", "doc", "at", "cut", F.when(F.col("kind").isNotNull(), encode("kind", "cut", "body")).alias("ids")
    )
    one = F.when(F.col("at").isNotNull(), F.struct("at", "cut", "ids"))
    texts = encoded_parts.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.sort_array(F.collect_list(one)).alias("parts")
    )
    return texts.select("doc", join("parts.cut", "parts.ids").alias("j")).select("doc", "j.*")


def encoded(
    docs: DataFrame,
    path: str,
    text: str = "text",
    out: str = "ids",
    text_out: str | None = None,
    long: int = LONG,
    part: int = PART,
    leaf: int = LEAF,
) -> DataFrame:
    """Add ``out``: the ids of each text as packed little-endian unsigned 32-bit integers.

    With ``text_out`` the text of the ids is added too, as ``decoded`` gives it. ``path`` names
    the tokenizer's file, which every worker reads. Nothing is added around a text; special
    strings inside it are their own token. Null and empty texts, and texts of white space, have
    no ids (an empty binary). Rows are encoded one by one, so repeated rows and ties need
    nothing, and an empty table gives no rows. Other columns are kept; those of the names
    ``out`` and ``text_out`` are replaced. Texts above ``long`` characters go through parts.
    """
    kept = [c for c in docs.columns if c not in (out, text_out)]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")
    rows = docs.select(whole, body, F.monotonically_increasing_id().alias("row"))
    is_long = F.char_length("body") > long
    done = _encoded_short(rows.where(~is_long), path, leaf).unionByName(
        _encoded_long(rows.where(is_long), path, part, leaf)
    )
    added = [F.col("ids").alias(out), *([F.col("decoded").alias(text_out)] if text_out else [])]
    return done.select("doc.*", *added)


def decoded(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of the ids, special tokens included; null or no ids give an empty text.

    Rows are decoded one by one, so ties and repeated rows need nothing, and an empty table gives no
    rows. Other columns are kept, one named ``out`` is replaced.
    """

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for packed in batches:
            yield pd.Series([codec(path).text(p or b"") for p in packed], dtype="object")

    return docs.withColumn(out, decode(F.col(f"`{ids}`")))
