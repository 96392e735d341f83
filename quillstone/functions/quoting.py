"""Finding quotes at safe edges, cutting texts into chunks, and differences of texts."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..shipping import arrow_udf
from . import classes

# What may stand before a quote and after it, what binds no number, what binds only the
# number before it, and the marks of a table's grid.
OPENERS = "([{\"'‘“„«‹¿¡"
CLOSERS = ".,;:!?)]}\"'’”»›…"
PLAIN = ".,;:!?)]}\"'’”»…®™©*†‡§¶#"
POSTFIX = "%‰‱°′″℃℉"
TABLE, TABLE_END, ROW, CELL, LEFT, ABOVE = "\ufdd0\ufdd1\ufdd2\ufdd3\ufdd4\ufdd5"


class _Classes(dict):
    """The class of each code point, found when it is first met: w space, g other gap, m mark, d number,
    l letter, x marker, o opening mark, q mark that opens and closes, c closing mark, C closing mark that
    looks like a sign, n other plain punctuation, p postfix sign, s sign (all else)."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        kind = unicodedata.category(c)
        if c == " ":
            k = "w"
        elif classes.is_gap(point):
            k = "g"
        elif point == 0xFFFC or 0xFDD0 <= point <= 0xFDEF:
            k = "x"
        elif kind[0] == "N":
            k = "d"
        elif kind[0] == "L" and kind != "Lm":
            k = "l"
        elif kind[0] == "M":
            k = "m"
        elif c in OPENERS and c != "‹":
            k = "q" if c in CLOSERS else "o"
        elif c in CLOSERS:
            k = "c" if c in PLAIN else "C"
        else:
            k = "n" if c in PLAIN or kind == "Pd" else "p" if c in POSTFIX else "s"
        self[point] = k
        return k


_CLASSES = _Classes()
# On classes. Backwards from a quote: opening marks up to a space or the start; a number or a sign before the space.
_OPENED, _CLOSED = re.compile("[oq]*(?:w|$)"), re.compile("[cqC]+(?:w|$)")
_NUMBER = re.compile("[wgm]*d")
_SIGN_BEFORE = re.compile("[wgmoq]*(?:[sC]|[cnp][moqcnp]*[sC])")
_SIGN_AFTER = re.compile("[wgmoq]*[spC]")
_WORD = re.compile("[^wg]+")


class Grid:
    """The tables of a text: for a place in a cell, what the cells beside it begin and end with."""

    def __init__(self, text: str, kinds: str):
        self.kinds, self.cells = kinds, []
        for m in re.finditer(f"{TABLE}[^{TABLE_END}]*", text):
            rows: list[list[tuple[str, int, int]]] = []
            for part in re.finditer(f"[{ROW}{CELL}{LEFT}{ABOVE}][^{ROW}{CELL}{LEFT}{ABOVE}]*", m.group()):
                mark, at = part.group()[0], m.start() + part.start() + 1
                if mark == ROW:
                    rows.append([])
                elif rows:
                    rows[-1].append((mark, at, m.start() + part.end()))
            self._place(rows)

    def _place(self, rows: list) -> None:
        owner: list[list] = []
        for r, slots in enumerate(rows):
            owner.append([])
            for c, (mark, start, end) in enumerate(slots):
                if mark == CELL:
                    cell = {"start": start, "end": end, "spans": [], "sides": None}
                    self.cells.append(cell)
                elif mark == LEFT:
                    cell = owner[r][c - 1] if c else None
                else:
                    cell = owner[r - 1][c] if r and c < len(owner[r - 1]) else None
                owner[r].append(cell)
        for row in owner:
            for c, cell in enumerate(row):
                if cell is not None and (c == 0 or row[c - 1] is not cell):
                    last = c
                    while last + 1 < len(row) and row[last + 1] is cell:
                        last += 1
                    cell["spans"].append((row[:c], row[last + 1 :]))

    def _words(self, cells: list) -> list[str]:
        return [w for cell in cells if cell is not None for w in _WORD.findall(self.kinds[cell["start"] : cell["end"]])]

    def beside(self, at: int) -> tuple[list[str], list[str]]:
        """The words (as classes) of all cells left and right of the cell that holds a place."""
        for cell in self.cells:
            if cell["start"] <= at < cell["end"]:
                if cell["sides"] is None:
                    cell["sides"] = tuple(self._words([x for span in cell["spans"] for x in span[side]]) for side in (0, 1))
                return cell["sides"]
        return [], []


class Searched:
    """A text that quotes are looked up in."""

    def __init__(self, text: str):
        self.text, self._kinds, self._back, self._grid = text, None, "", None

    def _prepare(self) -> None:
        if self._kinds is None:
            self._kinds = self.text.translate(_CLASSES)
            self._back = self._kinds[::-1]
            self._grid = Grid(self.text, self._kinds) if TABLE in self.text else None

    def _begins(self, at: int, quote: str) -> bool:
        opened = _OPENED.match(self._back, len(self._back) - at)
        if not opened:
            return False
        if not opened.group().endswith("w"):
            return True  # the start of the text
        before, number = opened.end(), _NUMBER.match(quote)
        if _SIGN_BEFORE.match(self._back, before) or (number and _NUMBER.match(self._back, before)):
            return False
        if self._grid is None:
            return True
        words, _ = self._grid.beside(at)
        return not any(_SIGN_BEFORE.match(w[::-1]) or (number and _NUMBER.match(w[::-1])) for w in words)

    def _ends(self, at: int, quote: str) -> bool:
        if at == len(self.text):
            return True
        if self._kinds[at] != "w":
            return bool(_CLOSED.match(self._kinds, at))
        if not _NUMBER.match(quote[::-1]):
            return True
        if _NUMBER.match(self._kinds, at + 1) or _SIGN_AFTER.match(self._kinds, at + 1):
            return False
        if self._grid is None:
            return True
        _, words = self._grid.beside(at)
        return not any(_NUMBER.match(w) or _SIGN_AFTER.match(w) for w in words)

    def find(self, quote: str) -> tuple[int, int] | None:
        """Code-point span of the first place where the quote may begin and end, or none."""
        at = self.text.find(quote) if quote else -1
        if at < 0:
            return None
        self._prepare()
        kinds = quote.translate(_CLASSES)
        if not kinds.strip("wg"):
            return None
        while at >= 0:
            if self._begins(at, kinds) and self._ends(at + len(quote), kinds):
                return at, at + len(quote)
            at = self.text.find(quote, at + 1)
        return None


def find(text: str, quote: str) -> tuple[int, int] | None:
    return Searched(text).find(quote)


def searchable(quote: str) -> bool:
    """Whether a quote holds anything that a reader sees, and no marker of tables and pictures."""
    kinds = quote.translate(_CLASSES)
    return bool(kinds.strip("wg")) and "x" not in kinds


def _parts_number(text: str, at: int) -> bool:
    """Whether a cut at the space at this place would part a number, or a sign from its number."""
    kinds = text.translate(_CLASSES)
    back, before, after = kinds[::-1], len(kinds) - at, at + 1
    number_before, number_after = _NUMBER.match(back, before), _NUMBER.match(kinds, after)
    return bool(_SIGN_BEFORE.match(back, before) or (number_before and (number_after or _SIGN_AFTER.match(kinds, after))))


_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
_SEGMENT = StructType([StructField("kind", StringType()), StructField("text", StringType())])


def _locate(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, quotes in parts:
        last, found = None, []
        for t, q in zip(texts, quotes):  # pairs of one text come together: it is read once
            if t is None or q is None:
                found.append(None)
                continue
            if last is None or last.text != t:
                last = Searched(t)
            found.append(last.find(q))
        yield pd.DataFrame({"start": pd.array([f and f[0] if f else None for f in found], "Int32"), "end": pd.array([f[1] if f else None for f in found], "Int32")})


locate = arrow_udf(_locate, _SPAN)

def _askable(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether a normalised quote can be looked for at all (null: it held a forbidden character)."""
    for s in parts:
        yield s.map(lambda q: isinstance(q, str) and searchable(q)).astype(bool)


may_be_asked = arrow_udf(_askable, "boolean")

LIMIT = 2000


def _units(text: str) -> list[int]:
    """UTF-16 units up to each code point."""
    out = [0]
    for c in text:
        out.append(out[-1] + 1 + (c > "￿"))
    return out


def cut(text: str, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Spans of at most limit UTF-16 units, cut at spaces where no number is split, of even length;
    a stretch without such a place is cut at the limit."""
    if not text:
        return []
    units = _units(text)
    n = -(-units[-1] // limit)
    goal = -(-units[-1] // n)
    spans, start = [], 0
    while start < len(text):
        if units[-1] - units[start] <= limit:
            spans.append((start, len(text)))
            break
        stop = start + 1
        low, high = start, len(text)
        while low < high:  # the last place within the limit
            mid = (low + high + 1) // 2
            if units[mid] - units[start] <= limit:
                low = mid
            else:
                high = mid - 1
        stop = max(low, start + 1)
        aim = min(stop, start + goal)
        best = None
        for i in sorted((m.start() + start for m in re.finditer(" ", text[start + 1 : stop])), key=lambda i: abs(i + 1 - aim)):
            i += 1
            if not _parts_number(text, i):
                best = i
                break
        end = best if best is not None and best > start else stop
        spans.append((start, end))
        start = end + (best is not None and end == best)
    return spans


def _chunks(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield texts.map(lambda t: [{"start": a, "end": b} for a, b in cut(t or "")])


chunks = arrow_udf(_chunks, ArrayType(_SPAN))

TOKEN = re.compile(r"\w+|\s+|[^\w\s]")


def difference(old: str, new: str) -> list[tuple[str, str]]:
    """Segments t (kept), d (deleted) and i (inserted); kept and deleted give old, kept and inserted new."""
    a, b = TOKEN.findall(old), TOKEN.findall(new)
    out = []
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out.append(("t", "".join(a[i:j])))
            continue
        if j > i:
            out.append(("d", "".join(a[i:j])))
        if m > k:
            out.append(("i", "".join(b[k:m])))
    return out


def _segments(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for old, new in parts:
        yield pd.Series([[{"kind": k, "text": t} for k, t in difference(a, b)] for a, b in zip(old, new)])


segments = arrow_udf(_segments, ArrayType(_SEGMENT))


def align(pattern: list[str], words: list[str], anywhere: bool = False) -> float:
    """matched / (matched + cost) of the cheapest alignment of two word lists, by rows of edit costs; of
    equally cheap ones the one that matches most. With ``anywhere`` the pattern may begin and end at any
    word of ``words`` at no cost."""
    best = [(0 if anywhere else j, 0) for j in range(len(words) + 1)]
    for i, p in enumerate(pattern, 1):
        row = [(i, 0)]
        for j, w in enumerate(words, 1):
            keep = (best[j - 1][0], best[j - 1][1] - 1) if p == w else (best[j - 1][0] + 1, best[j - 1][1])
            row.append(min(keep, (best[j][0] + 1, best[j][1]), (row[-1][0] + 1, row[-1][1])))
        best = row
    cost, matched = min(best) if anywhere else best[-1]
    return -matched / (cost - matched) if matched or cost else 0.0


def _alignment(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for patterns, texts in parts:
        yield pd.Series([align(list(p), list(t), True) for p, t in zip(patterns, texts)], dtype="float64")


alignment = arrow_udf(_alignment, "double")


def occurrences(text: str, wording: str) -> list[int]:
    """All places of a wording, overlapping ones too."""
    out, at = [], text.find(wording) if wording else -1
    while at >= 0:
        out.append(at)
        at = text.find(wording, at + 1)
    return out


CONTEXT = 2


def wording(words: list[str], at: int, new: str) -> tuple[str, str]:
    """(old, new) wording of the change of one word of a text: with CONTEXT words around it, and as many
    more as it takes until the old wording stands in the text once."""
    text, k = " ".join(words), CONTEXT
    while True:
        low, high = max(0, at - k), at + k + 1
        old = " ".join(words[low:high])
        if len(occurrences(text, old)) <= 1 or (low == 0 and high >= len(words)):
            return old, " ".join([*words[low:at], new, *words[at + 1 : high]])
        k += 1


_WORDING = StructType([StructField("old", StringType()), StructField("new", StringType())])


def _wordings(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, places, news in parts:
        rows = [wording(t.split(" "), p, n) for t, p, n in zip(texts, places, news)]
        yield pd.DataFrame(rows, columns=["old", "new"])


wordings = arrow_udf(_wordings, _WORDING)


def paragraph_changes(old: list[str], new: list[str]) -> dict[str, int]:
    """How many paragraphs of two versions are kept, changed in place, inserted and deleted."""
    n = {"kept": 0, "changed": 0, "inserted": 0, "deleted": 0}
    for op, i, j, k, m in difflib.SequenceMatcher(None, old, new, autojunk=False).get_opcodes():
        if op == "equal":
            n["kept"] += j - i
            continue
        both = min(j - i, m - k)
        n["changed"] += both
        n["deleted"] += j - i - both
        n["inserted"] += m - k - both
    return n


_CHANGES = StructType([StructField(k, IntegerType()) for k in ("kept", "changed", "inserted", "deleted")])


def _paragraph_changes(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for old, new in parts:
        yield pd.DataFrame([paragraph_changes(a.split("\n"), b.split("\n")) for a, b in zip(old, new)], columns=["kept", "changed", "inserted", "deleted"]).astype("int32")


aligned_paragraphs = arrow_udf(_paragraph_changes, _CHANGES)
