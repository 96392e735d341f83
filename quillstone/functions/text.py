"""Text normalisation, tokens and small text predicates as column expressions."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import arrow_udf
from . import classes

# The ligatures that normalisation expands.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬆ": "st"}
INVISIBLE = classes.pattern(*classes.INVISIBLE)
SPACES = classes.pattern(*classes.WHITESPACE)
IN_LINE = classes.pattern(*(p for p in classes.WHITESPACE if p not in (0x09, 0x0A)))
#: Printable ASCII, tab, line breaks and Latin letters.
ORDINARY = "\\x20-\\x7e\\n\\t\\r\\u00a0-\\u00ac\\u00ae-\\u02ff"
BULLETS = classes.pattern(*classes.BULLETS)
# A well-formed string of the JVM holds no single surrogates: their range is left out.
FORBIDDEN = f"[{classes.pattern(*(r for r in classes.FORBIDDEN if r[0] != 0xD800))}]"


def _nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode composition; Spark has no function for it."""
    for s in texts:
        yield s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


nfc = arrow_udf(_nfc, "string")


def unusual(c: Column) -> Column:
    """The characters of a text but printable ASCII, tab, line breaks and Latin letters, on which no rule
    but white space bears. It is mostly empty, and costs less than any test of the whole text."""
    return F.regexp_replace(c, f"[{ORDINARY}]+", "")


@functools.cache
def _decomposing() -> str:
    """The code points, marks apart, that composition replaces by others, as ranges of a character class."""
    points = [p for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.normalize("NFC", chr(p)) != chr(p)]
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return classes.pattern(*map(tuple, runs))


def compose(c: Column) -> Column:
    """NFC. Text without marks, joining letters and the few other code points that it changes is composed
    already; only other texts are sent to Python, the rest goes there as null."""
    open_ = unusual(c).rlike(f"[\\p{{M}}\\u1100-\\u11ff{_decomposing()}]")
    return F.coalesce(nfc(F.when(open_, c)), c)


def drop_invisible(c: Column) -> Column:
    """Invisible characters go; a soft hyphen takes the line break behind it along."""
    return F.regexp_replace(c, f"\\u00ad\r?\n|[{INVISIBLE}]", "")


def expand_ligatures(c: Column) -> Column:
    out = c
    for one, many in LIGATURES.items():
        out = F.replace(out, F.lit(one), F.lit(many))
    return F.when(unusual(c).rlike("[\\ufb00-\\ufb06]"), out).otherwise(c)


def plain_bullets(c: Column) -> Column:
    """Bullets at the start of a line (not of the text, not on a line with a tab), each before white space, become a space."""
    return F.regexp_replace(c, f"(?<=\n)(?:[{IN_LINE}]*[{BULLETS}](?=[{SPACES}]))+(?=[^\n\t]*(?:\n|$))", " ")


def collapse(c: Column) -> Column:
    """Each run of white space is one space, and none stands at the ends."""
    return F.trim(F.regexp_replace(c, f"[{SPACES}]+", " "))


def collapse_ordinary(c: Column) -> Column:
    """``collapse`` of ordinary text, in which few code points are white space; single spaces are left as they are."""
    return F.trim(F.regexp_replace(c, "[\\t\\n\\r\\xa0][\\t\\n\\r \\xa0]*| [\\t\\n\\r \\xa0]+", " "))


def collapse_template(c: Column) -> Column:
    """Runs of space, tab and no-break space are one space."""
    return F.regexp_replace(c, "[ \t ]+", " ")


def ordinary(c: Column) -> Column:
    """Whether a text holds nothing on which any rule but white space bears: one look at it, up to the first such
    character."""
    return c.rlike(f"\\A[{ORDINARY}]*+\\z")


def normalize(c: Column) -> Column:
    """The order matters: drop, expand, compose, bullets, white space. Text that holds a forbidden
    character is null: it cannot be compared. Ordinary text only has its white space collapsed."""
    odd = unusual(c)
    plain = F.when(odd.rlike(f"[{INVISIBLE}\\ufb00-\\ufb06]"), expand_ligatures(drop_invisible(c))).otherwise(c)
    whole = compose(F.when(~ordinary(c) & ~odd.rlike(FORBIDDEN), plain))
    return F.when(ordinary(c), collapse_ordinary(c)).otherwise(collapse(F.when(odd.rlike(f"[{BULLETS}]"), plain_bullets(whole)).otherwise(whole)))


def forbidden_at(c: Column) -> Column:
    """Code-point offset of the first forbidden character, null if none."""
    at = F.regexp_instr(c, F.lit(FORBIDDEN))
    return F.when(at > 0, at - 1)


def tokens(c: Column) -> Column:
    """Word runs, white-space runs and single other characters: joined they give the text back."""
    return F.regexp_extract_all(c, F.lit("[\\p{L}\\p{N}_]+|\\s+|[^\\p{L}\\p{N}_\\s]"), F.lit(0))


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingles(c: Column, n: int) -> Column:
    """Runs of n words, distinct."""
    w = F.transform(F.array(words(c)), lambda x: F.transform(F.sequence(F.lit(1), F.greatest(F.size(x) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(x, i, n), " ")))
    return F.array_distinct(F.when(F.size(words(c)) >= n, F.element_at(w, 1)).otherwise(F.array().cast("array<string>")))


def cause(c: Column) -> Column:
    """A message without what varies: quoted parts, code points and numbers masked, 80 characters at most."""
    c = F.regexp_replace(c, "'[^']*'|\"[^\"]*\"", "'_'")
    c = F.regexp_replace(c, "U\\+[0-9A-F]{4,6}", "U+_")
    return F.substring(F.regexp_replace(c, "[0-9]+", "N"), 1, 80)


def luminance(channel: Column) -> Column:
    v = channel / 255.0
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def contrast(a: list[Column], b: list[Column]) -> Column:
    """Ratio of the relative luminances of two colours (red, green, blue from 0 to 255)."""
    of = lambda c: 0.2126 * luminance(c[0]) + 0.7152 * luminance(c[1]) + 0.0722 * luminance(c[2])
    return (F.greatest(of(a), of(b)) + 0.05) / (F.least(of(a), of(b)) + 0.05)


def repeated_letter(n: Column) -> Column:
    """1 A, 26 Z, 27 AA, 28 BB, ..."""
    return F.repeat(F.chr(F.lit(65) + (n - 1) % 26), (F.floor((n - 1) / 26) + 1).cast("int"))


def base26_letter(n: Column) -> Column:
    """1 a, 26 z, 27 aa, 28 ab, ... up to three letters."""
    letter = lambda x: F.chr(F.lit(97) + F.pmod(x, F.lit(26)))
    one, two = n - 1, F.floor((n - 27) / 26)
    three = F.floor((n - 703) / 676)
    return F.when(n <= 26, letter(one)).when(n <= 702, F.concat(letter(two), letter(one))).otherwise(F.concat(letter(three), letter(F.floor((n - 703) / 26)), letter(one)))


def roman(n: Column) -> Column:
    """Lower-case roman numeral of 1 to 3999."""
    digits = lambda *d: F.array(*[F.lit(x) for x in d])
    at = lambda table, value: F.element_at(table, (value % 10 + 1).cast("int"))
    return F.concat(
        F.repeat(F.lit("m"), F.floor(n / 1000).cast("int")),
        at(digits("", "c", "cc", "ccc", "cd", "d", "dc", "dcc", "dccc", "cm"), F.floor(n / 100)),
        at(digits("", "x", "xx", "xxx", "xl", "l", "lx", "lxx", "lxxx", "xc"), F.floor(n / 10)),
        at(digits("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"), n),
    )


def number_format(n: Column, format: Column) -> Column:
    """A number in a word processor's format; null where the format has no form for it."""
    letters = F.when(n.between(1, 780), repeated_letter(n))
    numerals = F.when(n.between(1, 3999), roman(n))
    zero = F.when(n < 10, F.concat(F.lit("0"), n.cast("string"))).otherwise(n.cast("string"))
    return (
        F.when(format == "none", "").when(format == "decimal", F.when(n >= 0, n.cast("string"))).when(format == "decimalZero", F.when(n >= 0, zero))
        .when(format == "upperRoman", F.upper(numerals)).when(format == "lowerRoman", numerals).when(format == "upperLetter", letters).when(format == "lowerLetter", F.lower(letters))
    )


# Letters that capitals keep or replace by letters of their own, and what an underline leaves as it is.
CAPITALS_OWN = {"\u0390": "\u03aa", "\u03b0": "\u03ab"}
UNDER_PLAIN = " .,;:()[]/'\"%@_&#!?*\u00a0\u2018\u2019\u201c\u201d"
NUMERO, NUMERO_O = "Nn\u039d\uff2e", "o\u043e\u03bf\u1d0f"


def capitals(c: Column) -> Column:
    """Capitals letter by letter: the runs that keep their form stand between those that do not."""
    kept = "\u00b5\u2170-\u217f" + "".join(chr(p) for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF and len(chr(p).upper()) != 1 and chr(p) not in CAPITALS_OWN)
    pieces = F.regexp_extract_all(c, F.lit(f"[{kept}]+|[^{kept}]+"), F.lit(0))
    own = c
    for small, large in CAPITALS_OWN.items():
        own = F.replace(own, F.lit(small), F.lit(large))
    pieces = F.regexp_extract_all(own, F.lit(f"[{kept}]+|[^{kept}]+"), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(f"^[{kept}]"), p).otherwise(F.upper(p))), "")


def underline_changes(c: Column, start: Column, end: Column) -> Column:
    """Whether an underline over code points [start, end) could change what the drawn text says: over anything
    but plain letters, digits and punctuation, over a small letter right after a number, or an o after an N."""
    plain = re.sub(r"([\[\]\\^&-])", r"\\\1", UNDER_PLAIN)
    under = F.substring(c, start + 1, end - start)
    upto = F.regexp_replace(F.substring(c, F.lit(1), end), f"[{classes.pattern(*classes.IGNORABLE)}]", "")
    inner = F.length(F.regexp_replace(under, f"[{classes.pattern(*classes.IGNORABLE)}]", ""))
    before = F.substring(upto, F.greatest(F.length(upto) - inner, F.lit(1)), inner + 1)
    first = F.length(upto) - inner
    numero = (first > 0) & before.rlike(f"^[{NUMERO}][{NUMERO_O}]")
    return ~under.rlike(f"^[\\p{{IsLatin}}\\p{{IsGreek}}\\p{{IsCyrillic}}0-9{plain}]*$") | before.rlike("\\p{N}\\p{Ll}") | numero
