"""Scalar functions against hand-made rows and plain Python."""

from __future__ import annotations

import hashlib
import json
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as s
from pyspark.sql import functions as F

from quillstone.functions import classes, hashing, quoting, text, xhtml


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_normalisation_by_hand(spark):
    rows = ["  a \t b ", "so­\nft", "ﬃ ﬁ", "é", "x\n• item", "x\n• a\tb", "• first", "zero​width", None, ""]
    want = ["a b", "soft", "ffi fi", "é", "x item", "x • a b", "• first", "zerowidth", None, ""]
    assert [r[0] for r in values(spark, rows, text.normalize(F.col("t")))] == want
    once = values(spark, [w for w in want if w], text.normalize(F.col("t")))
    assert [r[0] for r in once] == [w for w in want if w and True]


def test_forbidden_offset(spark):
    assert values(spark, ["ok", "a\x01b", "\x7f", None], text.forbidden_at(F.col("t"))) == [(None,), (1,), (0,), (None,)]


def test_ordinals(spark):
    df = spark.createDataFrame([(n,) for n in (1, 4, 26, 27, 28, 52, 53, 702, 703, 704, 1994)], "n long")
    got = [tuple(r) for r in df.select(text.base26_letter(F.col("n")), text.repeated_letter(F.col("n")), text.roman(F.col("n"))).collect()]
    assert got[:3] == [("a", "A", "i"), ("d", "D", "iv"), ("z", "Z", "xxvi")]
    assert [g[0] for g in got] == ["a", "d", "z", "aa", "ab", "az", "ba", "zz", "aaa", "aab", xhtml.list_marker("a", 1994)[:-2]]
    assert got[3][1] == "AA" and got[4][1] == "BB" and got[-1][2] == "mcmxciv"


def test_hashes(spark):
    got = values(spark, ["x", "é😀"], hashing.sha256_text(F.col("t")), hashing.stable_uuid("ns", F.col("t")), hashing.crc32c(F.col("t")))
    for t, (sha, uid, _) in zip(["x", "é😀"], got):
        h = hashlib.sha256(f"ns:{t}".encode()).hexdigest()
        assert sha == hashlib.sha256(t.encode()).hexdigest()
        assert uid == f"{h[:8]}-{h[8:12]}-5{h[13:16]}-a{h[17:20]}-{h[20:32]}"
    assert values(spark, ["123456789"], hashing.crc32c(F.col("t"))) == [(0xE3069283,)]


def test_canonical_json(spark):
    rows = ['{"b":1,"a":1.0}', '{"a":1,"a":2}', "nope", '{"é":"\\u20ac","z":[1e21,1e-7,0.1,-0.0,123456789.125]}', None]
    want = ['{"a":1,"b":1}', None, None, '{"z":[1e+21,1e-7,0.1,0,123456789.125],"é":"€"}', None]
    assert [r[0] for r in values(spark, rows, hashing.canonical_json(F.col("t")))] == want


@given(s.floats(allow_nan=False, allow_infinity=False))
@settings(max_examples=300, deadline=None)
def test_numbers_read_back(x):
    assert float(hashing.number(x)) == x


@given(s.recursive(s.none() | s.booleans() | s.integers(-1000, 1000) | s.text(), lambda c: s.lists(c) | s.dictionaries(s.text(), c), max_leaves=8))
@settings(max_examples=150, deadline=None)
def test_canonical_keeps_the_value(v):
    t = hashing.canonical(v)
    assert json.loads(t) == v and hashing.canonical(json.loads(t)) == t


@pytest.mark.parametrize(
    "body,quote,at",
    [
        ("Take 2.5 mg", "Take 2", None), ("Take 5 mg daily", "Take 5", (0, 6)), ("at -20 °C", "20 °C", None), ("(see section 4.4)", "see section 4", None),
        ("non-diabetic patients", "diabetic patients", None), ("1 000 000 IU", "000 IU", None), ("a (see b). c", "see b", (3, 8)), ("≥ 30 ml", "30 ml", None),
        ("cat concat cat", "cat", (0, 3)), ("concat, cat.", "cat", (8, 11)), ("x", " ", None),
    ],
)
def test_quote_edges(body, quote, at):
    assert quoting.find(body, quote) == at


def cells(*rows):
    """A grid of cells: text, or < and ^ for slots covered from the left and from above."""
    slot = lambda c: {"<": quoting.LEFT, "^": quoting.ABOVE}.get(c, f"{quoting.CELL} {c} ")
    return quoting.TABLE + "".join(quoting.ROW + "".join(slot(c) for c in r) for r in rows) + quoting.TABLE_END


@pytest.mark.parametrize(
    "body,cut,whole",
    [
        # units, decimals, brackets, signs joined to a number
        ("The patient’s dose is 7 mg/m² weekly.", ["dose is 7 mg/m", "7 mg/", "e", "The patient"], ["7 mg/m² weekly", "The patient’s", "weekly."]),
        ("Inject 3.5 ml slowly, then 12,5 ml.", ["Inject 3", "Inject 3.", "then 12", "5 ml slowly"], ["Inject 3.5 ml", "slowly", "then 12,5 ml"]),
        ("Stop (see part 5.1) at once.", ["see part 5", "(see part 5", "1) at once"], ["see part 5.1", "(see part 5.1)", "at once"]),
        ("Freeze at -40 °C or −60 °C.", ["40 °C or", "60 °C"], ["-40 °C or", "−60 °C"]),
        ("For <15 kg or ≥80 kg; if ≥ 65 years.", ["15 kg or", "80 kg", "65 years"], ["<15 kg or", "≥ 65 years", "For"]),
        ("Use non-sterile gloves. Won't keep.", ["sterile gloves", "t keep", "Won"], ["non-sterile gloves", "Won't keep"]),
        # grouped numbers across spaces, thin spaces, ignored and blank code points
        ("Up to 2 500 000 IU.", ["Up to 2", "500 000 IU", "Up to 2 500"], ["Up to", "2 500 000 IU"]),
        ("Give 20\u2009 000 IU or 7\u2063 000 IU.", ["000 IU or", "Give 20", "000 IU.", "Give 20\u2009"], ["Give 20\u2009 000 IU or"]),
        ("Dose 30\u2800 000 IU. Or 4\U000e0020 000 IU.", ["Dose 30", "000 IU.", "Or 4\U000e0020"], ["Dose", "Or"]),
        ("Take 3 ½ spoons.", ["½ spoons", "Take 3"], ["spoons."]),
        # signs across spaces, brackets, marks and look-alikes
        ("Rate < (25 ml/min). See (part 9).", ["(25 ml/min).", "25 ml/min"], ["(part 9).", "part 9", "Rate"]),
        ("Rate ≮ 25 ml. Rate <\u0332 35 ml. Rate <= 45 ml. Mean 9 +/- 4 mg.", ["25 ml.", "35 ml.", "45 ml.", "4 mg.", "Mean 9"], ["Rate", "Mean"]),
        ("Rate ❮ 25 ml. Rate ‹25 ml. Rate < ( 35 ml ).", ["25 ml.", "35 ml"], ["Rate"]),
        ("Count 50 × 10⁹/l. Down by 12 %. Half 1 / 2 cup.", ["Count 50", "Down by 12", "2 cup.", "Half 1"], ["Count", "Down by"]),
        ("Count 50 (× 10⁹/l). Some 20 \u0301% of.", ["Count 50", "Some 20"], ["Count", "Some"]),
        # what binds nothing: postfix signs before a quote, dashes, reference marks, plain punctuation
        ("In 15 % 40 people. Stage 2* 60 mg. Brand® 70 mg. Range 8 – 9 mg.", ["In 15"], ["40 people.", "60 mg.", "70 mg.", "9 mg.", "Range 8"]),
        ("Ratio was 0.61 (90% sure).", [], ["Ratio was 0.61"]),
        ("Code \U0001d4007 mg. Then \U0001d401 dose.", ["7 mg"], ["\U0001d401 dose"]),
        # cells are drawn side by side
        (cells(["Adults", "10", "000 IU"], ["Old", "if <", "5 mg"]), ["10", "000 IU", "5 mg"], ["Adults", "Old"]),
        ("x " + cells(["20", "000 IU"], ["a", "IU"]), ["000 IU"], ["IU"]),
        (cells(["10", "Adults"], ["^", "000 IU"]), ["10", "000 IU"], ["Adults"]),
        (cells(["5", "<", "000 mg"], ["x < then", "30 ml", "y"]), ["5", "000 mg", "30 ml"], ["x"]),
        (cells(["30", "%"], ["40", "(%)"]), ["30", "40"], []),
    ],
)
def test_where_quotes_may_begin_and_end(body, cut, whole):
    assert [q for q in cut if quoting.find(body, q)] == []
    for q in whole:
        start, end = quoting.find(body, q)
        assert body[start:end] == q


def test_quotes_that_show_nothing():
    assert not any(map(quoting.searchable, ["", " ", "\u2009\u200b", "a\ufffcb", "a\ufdd2b"]))
    assert quoting.searchable("a b")


def test_code_point_classes():
    assert all(classes.is_gap(ord(c)) for c in " \t\u2009\u2800\u200b\ufe0f") and not any(classes.is_gap(ord(c)) for c in "a1-\u1680\ufffc")
    assert all(classes.is_word(c) for c in "é1\u0301\u200d\u00ad") and not any(classes.is_word(c) for c in " .-°")


@given(s.text(alphabet="ab 1.é😀", max_size=400))
@settings(max_examples=150, deadline=None)
def test_chunks_lose_only_spaces(t):
    spans = quoting.cut(t, 40)
    assert all(len(t[a:b].encode("utf-16-le")) // 2 <= 40 for a, b in spans)
    covered = "".join(t[a:b] for a, b in spans)
    assert covered.replace(" ", "") == t.replace(" ", "")


@given(s.text(max_size=60), s.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_segments_give_both_sides_back(a, b):
    parts = quoting.difference(a, b)
    assert "".join(t for k, t in parts if k in "td") == a
    assert "".join(t for k, t in parts if k in "ti") == b


def test_alignment_score():
    assert quoting.align("a b c d".split(), "a b c d".split()) == 1
    assert quoting.align("a b c d".split(), "a b x d".split()) == pytest.approx(3 / 4)
    assert quoting.align([], []) == 0


@pytest.mark.parametrize(
    "div,want",
    [
        ("<div><b>ﬃ</b></div>", "\nﬃ\n"), ("<div><p>a &amp; b</p></div>", "\n\na & b\n\n"), ("<div>10<sup>9</sup></div>", "\n10⁹\n"),
        ('<div><ol type="i" start="4"><li>x</li></ol></div>', "\n\n\niv. x\n\n\n"), ("<div>a<br/>b</div>", "\na\nb\n"), ("<div><sup>a−2</sup><sub>x(1)</sub></div>", "\na⁻²x₍₁₎\n"),
        ('<div><table><tr><td rowspan="2">a</td><td>b</td></tr><tr><td>c<br/>d</td></tr></table></div>', "\n\n\ufdd0\n\ufdd2\t\ufdd3\ta\t\t\ufdd3\tb\t\n\n\ufdd2\t\ufdd5\t\t\ufdd3\tc\td\t\n\n\ufdd1\n\n"),
        ('<div><table><tr><td colspan="2">a</td></tr><tr><td>b</td><td>c</td></tr></table></div>', "\n\n\ufdd0\n\ufdd2\t\ufdd3\ta\t\t\ufdd4\t\n\n\ufdd2\t\ufdd3\tb\t\t\ufdd3\tc\t\n\n\ufdd1\n\n"),
        ('<div><img src="data:image/png;base64,AAAA"/></div>', "\n\ufffc" + hashlib.sha256(b"data:image/png;base64,AAAA").hexdigest() + "\ufffc\n"),
    ],
)
def test_narrative_text(div, want):
    assert xhtml.to_text(div) == want


@pytest.mark.parametrize(
    "div,code",
    [
        ("<!DOCTYPE html>", "doctype"), ("<div><!-- x --></div>", "comment"), ("<div><u>x</u></div>", "unknown-element"), ("<p>x</p>", "root-not-div"), ("<div>a & b</div>", "stray-amp"),
        ("<div>&nope;</div>", "unknown-entity"), ("<div><b></div>", "misnested-tag"), ("<div>", "unbalanced-tag"), ("<div/>", "void-element"), ("<div><br></div>", "void-element"),
        ("<DIV></DIV>", "uppercase-element"), ('<div onclick="x"></div>', "forbidden-attribute"), ("<div></div><div></div>", "multiple-roots"), ("x<div></div>", "text-outside-root"),
        ("<div><sup>½</sup></div>", "unmappable-script"), ("<div><sub>⁵</sub></div>", "unmappable-script"), ("<div>a\u00adb</div>", "invisible-character"), ("<div>\ufdd0</div>", "reserved-character"),
        ("<div><span style='color: red'>x</span></div>", "forbidden-attribute"), ("<div><img/></div>", "forbidden-attribute"), ("<div><table><tr><td>a</td></tr><tr><td>b</td><td>c</td></tr></table></div>", "table-shape"),
        ('<div><table><tr><td rowspan="2">a</td></tr></table></div>', "table-shape"), ('<div><table><tr><td colspan="1000" rowspan="51">a</td></tr></table></div>', "table-size"),
        ("<div><table><tbody><tr><td>a</td></tr></tbody><thead><tr><td>b</td></tr></thead></table></div>", "table-section-order"), ("<div><table><tr><td>a</td></tr><caption>x</caption></table></div>", "table-structure"),
        ("<div><table><tr><td><table></table></td></tr></table></div>", "table-structure"), ("<div><table><tr><td><hr/></td></tr></table></div>", "table-content"), ("<div><li>x</li></div>", "list-content"), ("<div>1 < 2</div>", "stray-lt"), ("<div>\x01</div>", "forbidden-character"),
    ],
)
def test_narrative_refusals(div, code):
    with pytest.raises(xhtml.Refused) as e:
        xhtml.to_text(div)
    assert e.value.code == code


def test_pages_are_read_leniently():
    assert xhtml.read_paragraphs("<!DOCTYPE html><p>a <b>b</b><p>c<script>x</script><br>d &amp; e") == ["a b", "c", "d & e"]


def test_composition_equals_python(spark):
    rows = ["é", "가", "a" * 10, "ñ"]
    assert [r[0] for r in values(spark, rows, text.compose(F.col("t")))] == [unicodedata.normalize("NFC", r) for r in rows]
