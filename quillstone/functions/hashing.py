"""Hashes, identities and canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import arrow_udf


def sha256_text(c: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(c, 256)


def stable_uuid(namespace: str, value: Column) -> Column:
    """A UUID that depends only on namespace and value, with version and variant digits set."""
    h = F.sha2(F.concat(F.lit(namespace + ":"), value), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(F.lit("a"), part(18, 3)), part(21, 12))


def edit_id(old: Column, new: Column) -> Column:
    """First 12 hex digits over both wordings, a NUL between them."""
    return F.substring(F.sha2(F.concat(old, F.lit("\0"), new), 256), 1, 12)


def head_name(key: Column, sequence: Column) -> Column:
    """Object name of a statement: key and the sequence in twelve digits."""
    return F.concat(key, F.lit("/"), F.lpad(sequence.cast("string"), 12, "0"))


def canonical(value) -> str:
    """RFC 8785 text of a JSON value: keys by UTF-16 units, numbers as ECMAScript writes them."""
    if value is None or isinstance(value, (bool, str)):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, (int, float)):
        return number(float(value)) if isinstance(value, float) or abs(value) > 1 << 53 else str(value)
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    keys = sorted(value, key=lambda k: k.encode("utf-16-be"))
    return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + canonical(value[k]) for k in keys) + "}"


def number(x: float) -> str:
    """The shortest text of a double, laid out as ECMAScript does."""
    if x != x or x in (float("inf"), float("-inf")):
        raise ValueError("not a JSON number")
    if x == 0:
        return "0"
    sign, (digits, exponent) = "-" * (x < 0), f"{abs(x)!r}".lower().partition("e")[::2]
    whole, _, part = digits.partition(".")
    shift = len(whole) + int(exponent or 0)
    all_digits = (whole + ("" if part == "0" else part)).lstrip("0")
    shift -= len(whole + part) - len((whole + part).lstrip("0")) if whole == "0" else 0
    all_digits = all_digits.rstrip("0") or "0"
    n = len(all_digits)
    if 0 < shift <= 21:
        body = all_digits + "0" * (shift - n) if n <= shift else all_digits[:shift] + "." + all_digits[shift:]
    elif -6 < shift <= 0:
        body = "0." + "0" * -shift + all_digits
    else:
        e = shift - 1
        body = all_digits[0] + ("." + all_digits[1:] if n > 1 else "") + "e" + ("+" if e > 0 else "-") + str(abs(e))
    return sign + body


def _unique_pairs(pairs):
    found = dict(pairs)
    if len(found) != len(pairs):
        raise ValueError("a key occurs twice")
    return found


def strict_json(text: str):
    """The value of a JSON text in which no object repeats a key."""
    return json.loads(text, object_pairs_hook=_unique_pairs, parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))


def _canonical_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Canonical text of JSON, null where it is not JSON or repeats a key."""

    def one(t):
        try:
            return None if t is None else canonical(strict_json(t))
        except ValueError:
            return None

    for s in texts:
        yield s.map(one, na_action="ignore")


def crc32c_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0x82F63B78 if n & 1 else 0)
        table.append(n)
    return table


canonical_json = arrow_udf(_canonical_json, "string")


def canonical_without(c: Column, *names: str) -> Column:
    """Canonical text of a JSON object without some of its top-level fields."""

    def drop(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda t: canonical({k: v for k, v in strict_json(t).items() if k not in names}), na_action="ignore")

    return arrow_udf(drop, "string")(c)


def _crc32c(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Castagnoli checksum of UTF-8 bytes (Spark's crc32 uses the other polynomial)."""
    table = crc32c_table()

    def one(t):
        c = 0xFFFFFFFF
        for b in t.encode():
            c = table[(c ^ b) & 255] ^ c >> 8
        return c ^ 0xFFFFFFFF

    for s in texts:
        yield s.map(one, na_action="ignore")


crc32c = arrow_udf(_crc32c, "long")
