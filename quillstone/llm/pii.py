"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) are always reported when their pattern and check hold. Added
kinds (iban by mod 97, ssn, phone_local) are reported when pattern, check and context together reach
the threshold. Scans are linear: e-mail addresses are grown around each @, digit runs are taken once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import table
from .texts import slices

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "phone_local")
KINDS = BASE + ADDED
THRESHOLD = 0.5
#: Score of a span that its pattern and check support, and what a context word adds or takes.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "phone_local": 0.3}
STEP = 0.25
NEAR = 48
CONTEXT = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax", "telefon"),
}
AGAINST = {
    "ip": ("version", "release", "section"),
    "card": ("isbn", "order", "serial"),
    "phone": ("isbn", "order", "serial"),
    "ssn": ("order", "part", "serial"),
    "phone_local": ("order", "part", "serial"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_RUN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IBAN_END = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+)(-])(?<!\+[0-9] )\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: around each @ the longest local part that no earlier
    match reaches into, and the domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping IBANs of 15 to 34 letters and digits: from each start the longest run of
    whole words, across single spaces, that is one by mod 97."""
    done = 0
    for m in _IBAN_START.finditer(text):
        run = _IBAN_RUN.match(text, m.start()) if m.start() >= done else None
        if not run:
            continue
        start, stop = run.span()
        for end in reversed([e.start() for e in _IBAN_END.finditer(text, start, stop + 1) if e.start() <= stop]):
            plain = text[start:end].replace(" ", "")
            if len(plain) < 15:
                break
            if mod97(plain):
                yield start, end
                done = end
                break


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", s, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", *m.span()))
    return found


def added_spans(text: str) -> list[tuple[str, int, int]]:
    if not _DIGIT.search(text):
        return []
    found = []
    found += [("iban", s, e) for s, e in ibans(text)]
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            found.append(("ssn", *m.span()))
    found += [("phone_local", *m.span()) for m in _PHONE_LOCAL.finditer(text)]
    return found


def score(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, moved by words near the span."""
    near = (text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]).lower()
    words = set(re.findall(r"[a-z]+", near))
    has = lambda group: any(w in words or (" " in w and w in near) for w in group)
    s = PRIOR[kind] + STEP * has(CONTEXT.get(kind, ())) - STEP * has(AGAINST.get(kind, ()))
    return min(1.0, max(0.0, s))


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """kind, start, end (code points, end exclusive), score; by kind, then start."""
    base = [(k, s, e, score(text, k, s, e)) for k, s, e in base_spans(text)]
    taken = [(s, e) for _, s, e, _ in base]
    more = [(k, s, e, score(text, k, s, e)) for k, s, e in added_spans(text) if not any(s < b and a < e for a, b in taken)]
    return sorted(base + [x for x in more if x[3] >= THRESHOLD], key=lambda x: (KINDS.index(x[0]), x[1]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows = [[{"kind": k, "start": s, "end": e, "score": x} for k, s, e, x in spans(t)] for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, _SPANS)], ["doc_id", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end, score>>: one row per row of docs.

    Null and empty texts have no spans; repeated doc_ids are rows of their own. Only doc_id and text
    are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, _find, "doc_id long, spans array<struct<kind:string, start:long, end:long, score:double>>")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    counted = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [counted(k) for k in BASE]
    top = F.coalesce(F.array_max(F.transform("spans", lambda x: x["score"])), F.lit(0.0))
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), top.alias("top_score"))
