"""Split texts into pre-tokens as a public tokenizer does.

Texts made of ASCII, Latin-1 and Latin Extended-A are split by one compiled pattern; any
other text by the tokenizer library's own normalizer and pre-tokenizer, so that classes of
rarer characters are exactly the library's.
"""

from __future__ import annotations

import re
from functools import lru_cache

from tokenizers import Tokenizer

# The letters, numbers and white space among the characters split here.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = "\t-\r "
# Not split here: above Latin Extended-A, other white space, and a letter whose lower case is two characters.
OTHER = re.compile("[^\x00-\x84\x86-\x9f\xa1-įı-ſ]")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_SPLIT = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
WORD_SPLIT = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")


def _byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others in order for the characters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()
_TO_CHARACTERS = {b: c for b, c in enumerate(BYTE_CHARACTERS)}
_TO_BYTES = {ord(c): b for b, c in enumerate(BYTE_CHARACTERS)}


def as_characters(piece: str) -> str:
    """A piece with each byte of its UTF-8 as one character."""
    return piece if piece.isascii() and piece.isprintable() and " " not in piece else (
        piece.encode().decode("latin-1").translate(_TO_CHARACTERS)
    )


def as_text(characters: str) -> str:
    return characters.translate(_TO_BYTES).encode("latin-1").decode()


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once in each Python worker."""
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=4)
def _specials(path: str) -> tuple[dict[str, int], re.Pattern | None]:
    ids = {token.content: i for i, token in tokenizer(path).get_added_tokens_decoder().items() if token.special}
    longest_first = sorted(ids, key=len, reverse=True)
    return ids, re.compile("|".join(map(re.escape, longest_first))) if ids else None


def special_ids(path: str) -> dict[str, int]:
    return _specials(path)[0]


def sections(text: str, path: str) -> list[str]:
    """The text cut at special strings, which stand at the odd places."""
    pattern = _specials(path)[1]
    if pattern is None or "<" not in text:
        return [text]
    cut, upto = [], 0
    for found in pattern.finditer(text):
        cut += [text[upto : found.start()], found.group()]
        upto = found.end()
    return [*cut, text[upto:]]


def byte_pieces(section: str, path: str) -> list[str]:
    """Pre-tokens of byte-level BPE; together they are the section."""
    if OTHER.search(section) is None:
        return BYTE_SPLIT.findall(section)
    return [as_text(c) for c, _ in tokenizer(path).pre_tokenizer.pre_tokenize_str(section)]


def normalised_words(section: str, path: str) -> str:
    """A section as the lower-casing word BPE reads it."""
    return section.lower() if OTHER.search(section) is None else tokenizer(path).normalizer.normalize_str(section)


def split_words(normalised: str, path: str) -> list[str]:
    """Pre-tokens of a normalised section; white space is dropped."""
    if OTHER.search(normalised) is None:
        return WORD_SPLIT.findall(normalised)
    return [as_text(c) for c, _ in tokenizer(path).pre_tokenizer.pre_tokenize_str(normalised)]


def word_pieces(section: str, path: str) -> list[str]:
    return split_words(normalised_words(section, path), path)
