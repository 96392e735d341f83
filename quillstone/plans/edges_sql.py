"""The quote-edge rule and normalisation as SQL, for tables without grids."""

from __future__ import annotations

from ..functions import classes, quoting


def _sql(chars: str) -> str:
    """Characters inside a class of RE2, in a SQL string."""
    return "".join("\\" + c if c in "[]\\^-" else "''" if c == "'" else c for c in chars)


def _ranges(*ranges) -> str:
    one = lambda p: f"\\x{{{p:X}}}"
    return "".join(one(r) if isinstance(r, int) else f"{one(r[0])}-{one(r[1])}" for r in ranges)


FORBIDDEN = _ranges(*(r for r in classes.FORBIDDEN if r[0] != 0xD800))
WHITE = _ranges(*classes.WHITESPACE)
OPEN = _sql(quoting.OPENERS.replace("‹", ""))
CLOSE = _sql(quoting.CLOSERS)
SIGN = "[^\\p{Lu}\\p{Ll}\\p{Lt}\\p{Lo}\\p{N}\\p{M}\\s\\p{Pd}" + OPEN + _sql(quoting.PLAIN + quoting.POSTFIX) + "]"
SIGN_AFTER = "[^\\p{Lu}\\p{Ll}\\p{Lt}\\p{Lo}\\p{N}\\p{M}\\s\\p{Pd}" + OPEN + _sql(quoting.PLAIN) + "]"


def normal(c: str) -> str:
    """Normalised text of a column that holds no bullets; null if a character is forbidden."""
    plain = f"regexp_replace({c}, '\\x{{AD}}\\r?\\n|[{_ranges(*classes.INVISIBLE)}]', '', 'g')"
    return f"CASE WHEN NOT regexp_matches({c}, '[{FORBIDDEN}]') THEN trim(regexp_replace(nfc_normalize({plain}), '[{WHITE}]+', ' ', 'g')) END"


def accepted(before: str, quote: str, after: str) -> str:
    """Whether a quote may stand between two texts."""
    bare = f"regexp_replace({before}, '[{OPEN}]*$', '')"
    left = (
        f"({bare} = '' OR (ends_with({bare}, ' ') AND NOT regexp_matches({bare}, '{SIGN}[^\\p{{L}}\\p{{N}} ]*[ \\p{{M}}{OPEN}]*$')"
        f" AND NOT (regexp_matches({quote}, '^\\p{{M}}*\\p{{N}}') AND regexp_matches({bare}, '\\p{{N}}[ \\p{{M}}]*$'))))"
    )
    right = (
        f"({after} = '' OR regexp_matches({after}, '^[{CLOSE}]+( |$)') OR (starts_with({after}, ' ') AND NOT (regexp_matches({quote}, '\\p{{N}}\\p{{M}}*$')"
        f" AND (regexp_matches({after}, '^[ \\p{{M}}]*\\p{{N}}') OR regexp_matches({after}, '^[ \\p{{M}}{OPEN}]*{SIGN_AFTER}')))))"
    )
    return f"({left} AND {right})"


def places(pairs: str) -> str:
    """Accepted places of each row of ``pairs`` (a, b, body, quote): relation (a, b, body, quote, s)."""
    found = f"SELECT *, unnest(range(1, len(parts))) AS i FROM (SELECT *, string_split(body, quote) AS parts FROM ({pairs}) WHERE quote <> '' AND contains(body, quote))"
    start = "CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) AS BIGINT) + (i - 1) * length(quote)"
    cut = "SELECT a, b, body, quote, s, left(body, s) AS before, substr(body, s + length(quote) + 1) AS after"
    return f"(SELECT a, b, body, quote, s FROM ({cut} FROM (SELECT *, {start} AS s FROM ({found}))) WHERE {accepted('before', 'quote', 'after')})"
