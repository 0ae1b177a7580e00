"""The compiled character map of a piece model, and normalisation that keeps the source's offsets.

The map is a double-array trie whose leaves point into a pool of replacements. Its entries are
listed once; a text is then searched for characters that begin an entry, and at each the longest
prefix that is an entry is replaced. What lies between is taken over as it stands.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

SPACE_SYMBOL = "▁"


def entries(compiled: bytes) -> dict[str, str]:
    """Every entry of a compiled map: prefix of a text and what replaces it."""
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled, "<u4", size // 4, 4).astype(np.int64)
    pool = compiled[4 + size :]
    # Fields of a unit: bits 0-7 and 31 the label, 8 whether a leaf follows, 9 the offset's scale, 10-30 the offset.
    label, leaf = units & 0x800000FF, (units >> 8) & 1
    offset = (units >> 10) << ((units & 0x200) >> 6)
    letters = np.arange(1, 256)
    found, open_nodes = {}, [(int(offset[0]), b"")]
    while open_nodes:
        node, prefix = open_nodes.pop()
        at = node ^ letters
        at, own = at[at < len(units)], letters[at < len(units)]
        for child, letter in zip(at[label[at] == own].tolist(), own[label[at] == own].tolist()):
            below, key = child ^ int(offset[child]), prefix + bytes([letter])
            if leaf[child]:
                start = int(units[below]) & 0x7FFFFFFF
                found[key.decode()] = pool[start : pool.index(b"\0", start)].decode()
            open_nodes.append((below, key))
    return found


@dataclass
class Normaliser:
    """What a model does to a text before it is cut into pieces.

    ``prefixes`` are the map's entries; ``dummy`` puts a space before the text, ``squeeze`` drops
    spaces at its ends and all but one in a run.
    """

    prefixes: dict[str, str]
    dummy: bool = True
    squeeze: bool = False
    _starts: re.Pattern | None = field(init=False, default=None)
    _longest: dict[str, int] = field(init=False, default_factory=dict)

    def __post_init__(self):
        for key in self.prefixes:
            self._longest[key[0]] = max(len(key), self._longest.get(key[0], 0))
        if self.prefixes:
            self._starts = re.compile("[" + "".join(map(re.escape, sorted(self._longest))) + "]")

    @property
    def cuts(self) -> bool:
        """Whether a text may be cut before a space that follows a letter or digit of ASCII."""
        plain = all(not (" " in key or key.isascii() and key.isalnum()) for key in self.prefixes)
        return plain and not any(key[-1] == " " or len(key) > 1 and key[0].isascii() for key in self.prefixes)

    def replaced(self, text: str) -> tuple[str, np.ndarray]:
        """The text after replacements, and for each byte of it the offset of its source in bytes."""
        if self._starts is None or self._starts.search(text) is None:
            return text, np.arange(len(text.encode()))
        parts: list[str] = []
        places: list[np.ndarray] = []
        done = source = at = 0  # characters done, bytes done, and where to look on
        while found := self._starts.search(text, at):
            begin = found.start()
            for size in range(self._longest[found.group()], 0, -1):
                key = text[begin : begin + size]
                if len(key) == size and key in self.prefixes:
                    break
            else:
                at = begin + 1
                continue
            kept, new = text[done:begin], self.prefixes[key]
            width = len(kept.encode())
            parts += [kept, new]
            places += [np.arange(source, source + width), np.full(len(new.encode()), source + width)]
            source += width + len(key.encode())
            done = at = begin + size
        rest = text[done:]
        places.append(np.arange(source, source + len(rest.encode())))
        return "".join([*parts, rest]), np.concatenate(places)

    def __call__(self, text: str, first: bool = True, last: bool = True) -> tuple[str, np.ndarray]:
        """A text with spaces as symbols, and the source's offset for each of its bytes and for its end.

        ``first`` and ``last`` say whether a part of a text begins or ends it.
        """
        size = len(text.encode())
        plain, places = self.replaced(text)
        raw = np.frombuffer(plain.encode(), np.uint8)
        if self.squeeze:
            blank = raw == 32
            keep = ~(blank & np.concatenate([[first], blank[:-1]]))
            raw, places = raw[keep], places[keep]
            plain = raw.tobytes().decode()
        if not plain:
            return "", np.array([size])
        before = " " if first and self.dummy else ""
        start = np.full(3 * len(before), places[0])
        aligned = np.concatenate([start, np.repeat(places, np.where(raw == 32, 3, 1)), [size]])
        spaced = (before + plain).replace(" ", SPACE_SYMBOL)
        if self.squeeze and last:
            short = spaced.rstrip(SPACE_SYMBOL)
            aligned = aligned[: len(aligned) - 3 * (len(spaced) - len(short))]
            spaced = short
        return spaced, aligned
