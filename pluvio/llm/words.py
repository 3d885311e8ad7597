"""Words of UTF-8 bytes, split by a table of the ASCII characters that belong to them."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of a text that are split at once.
STEP = 4 << 20


def word_table(digits: bool) -> bytes:
    """Per byte: letters as lower case, bytes beyond ASCII (and digits) as they are, a space for all else."""
    return bytes(b | 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 or digits and 48 <= b <= 57 else 32 for b in range(256))


def split_words(text: bytes, table: bytes, step: int = STEP) -> Iterator[list[bytes]]:
    """The words of a whole text, lower-cased from A to Z only, in lists of about ``step`` bytes."""
    text, start = text.translate(table), 0
    while len(text) - start > step and (cut := text.find(b" ", start + step)) >= 0:
        yield text[start:cut].split()
        start = cut
    yield text[start:].split()
