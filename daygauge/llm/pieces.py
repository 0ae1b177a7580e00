"""Encoding by a piece model that knows where in the text each piece comes from, and decoding.

A text is normalised by longest prefixes of the model's compiled character map
(``daygauge.llm.charmap``), which tells the source of every byte. The normalised text is cut
where no piece can reach across, before the spaces that follow something else; each different
section is merged by the library once in a worker, and is remembered as ids and widths. The widths, added up,
are looked up among the sources, which projects every piece to a span of the original bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from sentencepiece import SentencePieceProcessor

from daygauge.llm.charmap import SPACE_SYMBOL, Normaliser, entries
from daygauge.llm.workspace import text_slices

# Characters of a text that are normalised at once, where it can be cut.
PART = 1 << 18
# Different sections that a worker remembers, and the longest one of them.
REMEMBERED, SHORT = 300_000, 64
# Text in an output batch.
SLICE_CHARS = 1 << 19

# Numbers of the fields, and kinds, of a model file.
_PIECES, _TRAINER, _NORMALISER, _DENORMALISER = 1, 2, 3, 5
NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BPE = 2


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message in wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(message):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, message[at : at + size]
        at += size


def _message(fields: list[tuple[int, int | bytes]]) -> bytes:
    """A message of fields that are lengths of bytes, or small numbers."""

    def number(value: int) -> bytes:
        low = bytes()
        while value >= 0x80:
            low += bytes([value & 0x7F | 0x80])
            value >>= 7
        return low + bytes([value])

    made = [
        number(key << 3 | 2) + number(len(value)) + value if isinstance(value, bytes) else number(key << 3) + number(value)
        for key, value in fields
    ]
    return b"".join(made)


class PieceModel:
    """Pieces, scores and normaliser of a model with merges and byte fallback."""

    def __init__(self, model: bytes):
        top = list(_fields(model))
        trainer = dict(_fields(next(v for k, v in top if k == _TRAINER)))
        spec = dict(_fields(next(v for k, v in top if k == _NORMALISER)))
        listed = [dict(_fields(v)) for k, v in top if k == _PIECES]
        kinds = [p.get(3, NORMAL) for p in listed]
        suffix, byte_fallback = trainer.get(24, 0), trainer.get(35, 0)
        if trainer.get(3) != _BPE or suffix or not byte_fallback or not spec.get(5, 1):
            raise ValueError("not a model of merges with byte fallback and spaces as symbols before words")
        if set(kinds) - {NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("a model with pieces given by users or unused")
        self.names = [p[1].decode() for p in listed]
        self.kinds = kinds
        normal = [name for name, kind in zip(self.names, kinds) if kind == NORMAL]
        self.end_id = trainer.get(42, 2)
        self.unknown = trainer.get(44, b" \xe2\x81\x87 ")
        self.normalise = Normaliser(
            entries(spec.get(2, b"")), dummy=bool(spec.get(3, 1)), squeeze=bool(spec.get(4, 1))
        )
        across = re.compile(f"[^{SPACE_SYMBOL}]{SPACE_SYMBOL}")
        self.apart = not any(map(across.search, normal))
        self._sections = re.compile(f"{SPACE_SYMBOL}*[^{SPACE_SYMBOL}]+|{SPACE_SYMBOL}+")
        # The library merges sections that are normalised already, and does nothing else to them.
        plain = [(k, v) for k, v in top if k not in (_NORMALISER, _DENORMALISER)]
        plain.append((_NORMALISER, _message([(1, b"identity"), (3, 0), (4, 0), (5, 1)])))
        self.inner = SentencePieceProcessor(model_proto=_message(plain))
        self.known: dict[str, bytes] = {}
        # What each id gives when decoded; bytes of byte pieces count as text only together.
        self.values = [self._value(i) for i in range(len(self.names))]
        widths = [-1 if kind == _BYTE else len(name.encode()) for kind, name in zip(kinds, self.names)]
        self.widths = np.array(widths, np.int32)
        self.bytes = np.array([v[0] if kind == _BYTE else 0 for kind, v in zip(kinds, self.values)], np.uint8)

    def _value(self, i: int) -> bytes:
        kind, name = self.kinds[i], self.names[i]
        if kind == NORMAL:
            return name.replace(SPACE_SYMBOL, " ").encode()
        return {_CONTROL: b"", _UNKNOWN: self.unknown}.get(kind) if kind != _BYTE else bytes([int(name[3:5], 16)])

    def _packed(self, lists: list[list[int]]) -> list[bytes]:
        """Pairs (id, width in bytes) of each section. The last byte of a character has its width, the others none."""
        ids = np.fromiter(chain.from_iterable(lists), np.int32)
        widths = self.widths[ids]
        at = np.flatnonzero(widths < 0)
        if len(at):
            begins = np.flatnonzero((self.bytes[ids[at]] & 0xC0) != 0x80)
            ends = np.append(begins[1:], len(at))
            widths[at] = 0
            widths[at[ends - 1]] = ends - begins
        packed = np.stack([ids, widths], 1).tobytes()
        upto = [0, *accumulate(map(len, lists))]
        return [packed[8 * a : 8 * b] for a, b in pairwise(upto)]

    def _merged(self, sections: list[str]) -> bytes:
        """Packed pairs of sections in a row; different ones are merged once, and short ones remembered."""
        new = list(set(sections).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(set(sections))
        if new:
            self.known.update(zip(new, self._packed(self.inner.encode(new, num_threads=1))))
        packed = b"".join(map(self.known.__getitem__, sections))
        for section in new:
            if len(section) > SHORT:
                del self.known[section]
        return packed

    def sections(self, normalised: str) -> list[str]:
        return self._sections.findall(normalised) if self.apart else [normalised] if normalised else []

    def parts(self, text: str, part: int) -> Iterator[str]:
        """The text in parts of about ``part`` characters, cut before spaces where that changes nothing."""
        begin = 0
        while self.apart and self.normalise.cuts and len(text) - begin > part:
            found = _CUT.search(text, begin + part)
            if found is None:
                break
            yield text[begin : found.end()]
            begin = found.end()
        yield text[begin:]

    def encode(self, text: str | None, part: int = PART) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a text, and where in its bytes each piece begins and ends."""
        pairs, begins, ends, source = [], [], [], 0
        parts = list(self.parts(text or "", part))
        for n, own in enumerate(parts):
            normalised, places = self.normalise(own, first=n == 0, last=n == len(parts) - 1)
            packed = self._merged(self.sections(normalised))
            found = np.frombuffer(packed, "<i4").reshape(-1, 2)
            upto = np.cumsum(found[:, 1], dtype=np.int64)
            pairs.append(found[:, 0])
            begins.append(source + places[upto - found[:, 1]])
            ends.append(source + places[upto])
            source += len(own.encode())
        return tuple(np.concatenate(x).astype(np.int32) for x in (pairs, begins, ends))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control pieces give nothing, bytes that aren't UTF-8 a replacement character each."""
        at, begun, text = 0, False, b""
        strip = self.normalise.dummy or self.normalise.squeeze
        while at < len(ids) and not begun and not text:  # a space before the text isn't part of it
            value = self.values[ids[at]]
            if strip and self.kinds[ids[at]] == NORMAL and value.startswith(b" "):
                value, begun = value[1:], not self.normalise.squeeze
            elif self.kinds[ids[at]] == _BYTE:
                break
            text += value
            at += 1
        whole = text + b"".join([self.values[i] for i in ids[at:]])
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return text.decode() + self._decode_bytes(ids[at:])

    def _decode_bytes(self, ids: list[int]) -> str:
        found, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.kinds[i] == _BYTE:
                run += self.values[i]
                continue
            while run:
                for size in range(min(4, len(run)), 0, -1):
                    try:
                        character = run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    if len(character) == 1:
                        break
                else:
                    size, character = 1, "�"
                found.append(character)
                run = run[size:]
            if i is not None:
                found.append(self.values[i].decode())
        return "".join(found)


# A part of a text may end after a letter or digit that a space follows.
_CUT = re.compile("[0-9A-Za-z](?= )")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """The model of a file, read once in each Python worker."""
    with open(path, "rb") as file:
        return PieceModel(file.read())


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) for x in found)]).astype(np.int32)
    flat = np.concatenate(found) if found else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))


def encoded(
    docs: DataFrame,
    path: str,
    text: str = "text",
    out: str = "pieces",
    end: bool = False,
    decode: bool = False,
    part: int = PART,
) -> DataFrame:
    """Add ``out``, a struct of ``ids``, ``begins``, ``ends``, and ``decoded`` with ``decode``.

    ``path`` names the model's file, which every worker reads. ``begins`` and ``ends`` are offsets
    in the UTF-8 of the text as it was before normalisation: of a replaced prefix all pieces but
    the last are empty spans at its begin. A character given as bytes has its span in the last of
    them. With ``end`` the end id follows each text, with an empty span at its end. ``decoded`` is
    the text that the ids stand for. Null and empty texts have no pieces (but the end id). Rows are
    encoded one by one, so ties and repeated rows need nothing; an empty table gives no rows; a
    very long text is normalised in parts. Other columns are kept, one named ``out`` is replaced.
    """
    kept = [c for c in docs.columns if c != out]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc")
    rows = docs.select(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for start, texts in text_slices(batch.column("body"), SLICE_CHARS):
                found = [model.encode(t, part) for t in texts]
                if end:
                    close = [np.array([x], np.int32) for x in (model.end_id,)]
                    sizes = [np.array([len(t.encode())], np.int32) for t in texts]
                    found = [
                        (np.concatenate([i, *close]), np.concatenate([b, n]), np.concatenate([e, n]))
                        for (i, b, e), n in zip(found, sizes)
                    ]
                columns = [_lists([f[k] for f in found]) for k in range(3)]
                if decode:
                    columns.append(pa.array([model.decode(f[0].tolist()) for f in found], pa.string()))
                made = pa.StructArray.from_arrays(columns, ["ids", "begins", "ends", "decoded"][: len(columns)])
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(start, len(texts)), made], names=["doc", "made"])

    made = "struct<ids: array<int>, begins: array<int>, ends: array<int>" + (", decoded: string>" if decode else ">")
    schema = StructType([rows.schema["doc"], *StructType.fromDDL(f"made {made}").fields])
    return rows.mapInArrow(encode, schema).select("doc.*", F.col("made").alias(out))


def decoded(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text that an array of ids stands for.

    Null or no ids, and control ids, give an empty text; a null id among them is left out. Rows
    stand alone; an empty table gives no rows. Other columns are kept, one named ``out`` is replaced.
    """

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = piece_model(path)
        for lists in batches:
            yield pd.Series([model.decode([] if x is None else list(x)) for x in lists], dtype="object")

    return docs.withColumn(out, decode(F.array_compact(F.col(f"`{ids}`"))))
