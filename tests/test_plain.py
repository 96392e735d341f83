"""Queries that SQL does not express, against plain Python over the same rows."""

from __future__ import annotations

import difflib
import hashlib
import hmac
import html
import json
import re
import unicodedata

from quillstone import plans
from quillstone.functions import signatures
from quillstone.plans import services
from quillstone.streaming import sinks

CHECKED = ("a6_unlock_order", "a22_lift_order", "h2_canonical_json", "h3_canonical_hash", "h5_crc32c", "p6_segments", "p21_plain_characters", "p26_principals", "q3_chunks", "src13_lenient_text")


def rows(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


def run(spark, sf, name):
    return plans.QUERIES[name](spark, sf).collect()


def test_canonical_json(spark, sf):
    props = {r.event_id: r.props for r in rows(spark, sf, "events")}
    hashes = {r.event_id: r.sha for r in run(spark, sf, "h3_canonical_hash")}
    for r in run(spark, sf, "h2_canonical_json"):
        value = json.loads(props[r.event_id])
        assert all(isinstance(v, (str, int)) for v in value.values())
        want = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v, ensure_ascii=False)}" for k, v in sorted(value.items())) + "}"
        assert r.canonical == want and hashes[r.event_id] == hashlib.sha256(want.encode()).hexdigest()


def test_crc32c(spark, sf):
    def slow(data):
        c = 0xFFFFFFFF
        for b in data:
            c ^= b
            for _ in range(8):
                c = c >> 1 ^ 0x82F63B78 * (c & 1)
        return c ^ 0xFFFFFFFF

    names = {r.p_partkey: r.p_name for r in rows(spark, sf, "part")}
    assert {r.p_partkey: r.crc for r in run(spark, sf, "h5_crc32c")} == {k: slow(n.encode()) for k, n in names.items()}


def causes(text):
    t = text or ""
    named = {"short": len(t) < 400, "long": len(t) > 8000, "table": "|" in t, "markup": "<" in t, "digits": bool(re.search("[0-9]{4}", t)), "shout": "!!" in t}
    return {k for k, v in named.items() if v}


def test_unlock_orders(spark, sf):
    for name, alone in (("a6_unlock_order", True), ("a22_lift_order", False)):
        left, want = [c for c in (causes(r.text) for r in rows(spark, sf, "documents")) if c], []
        while left and len(want) < 20:
            gain = {c: sum(c in f and (len(f) == 1 or not alone) for f in left) for f in left for c in f}
            best = min(gain, key=lambda c: (-gain[c], c))
            want.append((len(want) + 1, best, gain[best]))
            left = [f - {best} for f in left if f - {best}]
        assert [tuple(r) for r in run(spark, sf, name)] == want


def test_segments(spark, sf):
    turns = {(r.conv_id, r.turn): r.text for r in rows(spark, sf, "conversations")}
    token = re.compile(r"\w+|\s+|[^\w\s]")
    for r in run(spark, sf, "p6_segments"):
        after = min(t for c, t in turns if c == r.conv_id and t > r.turn)
        ops = difflib.SequenceMatcher(None, token.findall(turns[r.conv_id, r.turn]), token.findall(turns[r.conv_id, after]), autojunk=False).get_opcodes()
        assert r.n_inserted == sum(o in ("insert", "replace") for o, *_ in ops)
        assert r.n_segments == sum(2 if o == "replace" else 1 for o, *_ in ops)


def test_chunks(spark, sf):
    texts = {r.doc_id: r.text or "" for r in rows(spark, sf, "documents")}
    found = {}
    for r in run(spark, sf, "q3_chunks"):
        found.setdefault(r.doc_id, []).append((r.start, r.end))
    for doc, text in texts.items():
        spans = sorted(found.get(doc, []))
        assert all(len(text[a:b].encode("utf-16-le")) <= 4000 for a, b in spans)
        assert "".join(text[a:b] for a, b in spans).replace(" ", "") == text.replace(" ", "")
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def plain_paragraphs(page):
    page = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>", "", page)
    blocks = "div p h1 h2 h3 h4 h5 h6 ul ol li table thead tbody tfoot tr td th caption blockquote dl dt dd hr br".split()
    page = re.sub(rf"(?i)</?({'|'.join(blocks)})\b[^>]*>", "\x00", page)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in page.split("\x00")]
    return [p for p in parts if p]


def test_lenient_reading(spark, sf):
    pages = {r.page_id: plain_paragraphs(r.html) for r in rows(spark, sf, "pages")}
    assert {r.page_id: r.n_paragraphs for r in run(spark, sf, "src13_lenient_text")} == {k: len(p) for k, p in pages.items()}
    assert {r.page_id: r.n_characters for r in run(spark, sf, "p21_plain_characters")} == {k: sum(map(len, p)) for k, p in pages.items()}


def test_principals(spark, sf):
    names = {r.c_custkey: r.c_name for r in rows(spark, sf, "customer")}
    spark.conf.set("quillstone.principal.key", "test key")
    try:
        got = {r.c_custkey: r.principal for r in run(spark, sf, "p26_principals")}
    finally:
        spark.conf.unset("quillstone.principal.key")
    fold = lambda n: unicodedata.normalize("NFKC", n).casefold().encode()
    assert got == {k: hmac.new(b"test key", fold(n), hashlib.sha256).hexdigest() for k, n in names.items()}
    assert {r.c_custkey: r.principal for r in run(spark, sf, "p26_principals")} != got


def test_signatures():
    n, d = services.P * services.Q, pow(services.EXPONENT, -1, (services.P - 1) * (services.Q - 1))
    s = signatures.sign(n, d, b"m", b"s" * 32)
    assert signatures.verify(n, services.EXPONENT, b"m", s)
    assert not signatures.verify(n, services.EXPONENT, b"M", s)
    assert not any(signatures.verify(n, services.EXPONENT, b"m", bad) for bad in (b"", s[:-1], s[:-1] + bytes([s[-1] ^ 1]), n.to_bytes(128, "big"), b"\xff" * 128))


def test_retries_wait_by_the_ladder():
    waits, left = [], [3]

    def write():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError
        return "done"

    assert sinks.with_retries(write, sleep=waits.append) == "done" and waits == [2, 5, 15]
    left[0], waits[:] = 99, []
    try:
        sinks.with_retries(write, sleep=waits.append)
    except OSError:
        assert waits == [2, 5, 15, 30, 60]


def test_a_batch_sent_again_is_written_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "i int, ts string").selectExpr("i", "timestamp(ts) AS ts")
    for n in (0, 1, 1, 0):
        sinks.append_days(df, f"{tmp_path}/days", "ts", n)
    assert spark.read.parquet(f"{tmp_path}/days").count() == 4
