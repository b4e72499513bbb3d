"""Hashed character n-grams of a text, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are handled in pieces of so many characters, so memory stays bounded for texts of any length.
PIECE = 1 << 20


def pieces(text: str, overlap: int) -> Iterator[np.ndarray]:
    """Code points of the lowered text between two spaces, cut into pieces that share ``overlap`` code points."""
    text = f" {text.lower()} "
    for at in range(0, max(1, len(text) - overlap), PIECE):
        yield np.frombuffer(text[at : at + PIECE + overlap].encode("utf-32-le", "surrogatepass"), np.uint32)


def buckets(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> list[np.ndarray]:
    """For each order the bucket of the n-gram at each position; orders ascend."""
    found, have = [], 1
    rolled = codes * np.uint32(0x9E3779B1)
    for order in orders:
        while have < order:
            rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[have:]
            have += 1
        mixed = (rolled ^ (rolled >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + np.uint32(order)
        found.append((mixed ^ (mixed >> np.uint32(16))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - bits))
    return found


def text_buckets(text: str, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the text, piece by piece; an n-gram in an overlap counts once."""
    longest = max(orders)
    for k, codes in enumerate(pieces(text, longest - 1)):
        parts = buckets(codes, orders, bits)
        # The overlap repeats the shorter n-grams that ended the piece before.
        yield np.concatenate([p[longest - n :] if k else p for n, p in zip(orders, parts, strict=True)])
