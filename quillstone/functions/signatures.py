"""Signatures of statements: RSA with PSS padding and SHA-256, verified with integers alone."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd

from ..shipping import arrow_udf

HASH, SALT = 32, 32


def _masked(seed: bytes, n: int) -> bytes:
    return b"".join(hashlib.sha256(seed + i.to_bytes(4, "big")).digest() for i in range(-(-n // HASH)))[:n]


def _xor(a: bytes, b: bytes) -> bytes:
    return bytes(x ^ y for x, y in zip(a, b))


def verify(modulus: int, exponent: int, message: bytes, signature: bytes) -> bool:
    """Whether the signature is the key's over the message (salt of 32 bytes)."""
    bits = modulus.bit_length() - 1
    size = -(-bits // 8)
    number = int.from_bytes(signature, "big")
    if len(signature) != -(-modulus.bit_length() // 8) or number >= modulus or size < HASH + SALT + 2:
        return False
    opened = pow(number, exponent, modulus)
    if opened >> 8 * size:
        return False
    block = opened.to_bytes(size, "big")
    masked, digest, end = block[: -HASH - 1], block[-HASH - 1 : -1], block[-1]
    spare = 8 * size - bits
    if end != 0xBC or masked[0] >> (8 - spare):
        return False
    data = bytearray(_xor(masked, _masked(digest, len(masked))))
    data[0] &= 0xFF >> spare
    padding, salt = bytes(data[:-SALT]), bytes(data[-SALT:])
    if padding != bytes(len(padding) - 1) + b"\x01":
        return False
    return hashlib.sha256(bytes(8) + hashlib.sha256(message).digest() + salt).digest() == digest


def sign(modulus: int, private: int, message: bytes, salt: bytes) -> bytes:
    """A signature for fixtures and tests; real ones come from a key service."""
    bits = modulus.bit_length() - 1
    size = -(-bits // 8)
    digest = hashlib.sha256(bytes(8) + hashlib.sha256(message).digest() + salt).digest()
    data = bytes(size - HASH - len(salt) - 2) + b"\x01" + salt
    masked = bytearray(_xor(data, _masked(digest, len(data))))
    masked[0] &= 0xFF >> (8 * size - bits)
    return pow(int.from_bytes(bytes(masked) + digest + b"\xbc", "big"), private, modulus).to_bytes(-(-modulus.bit_length() // 8), "big")


def verified_by(modulus: int, exponent: int):
    """A column function (message, signature in hex): whether the key signed it; null stays null."""

    def check(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for messages, signatures in parts:
            yield pd.Series([None if m is None or s is None else verify(modulus, exponent, m.encode(), bytes.fromhex(s)) for m, s in zip(messages, signatures)], dtype="boolean")

    return arrow_udf(check, "boolean")
