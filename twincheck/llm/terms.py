"""Terms of whole texts: maximal runs of letters (with ``digits`` also 0-9) and of everything beyond ASCII, A-Z lowered."""

from __future__ import annotations

_LETTERS = b"abcdefghijklmnopqrstuvwxyz"


def term_table(digits: bool) -> bytes:
    """For ``bytes.translate``: lower-cases A-Z and turns each byte that belongs to no term into a space.

    All of them are ASCII, so UTF-8 sequences are never torn.
    """
    kept = _LETTERS + (b"0123456789" if digits else b"")
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in kept:
        table[byte] = byte
    for byte in _LETTERS:
        table[byte - 32] = byte
    return bytes(table)
