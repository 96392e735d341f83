"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed character 1-, 2- and 3-grams. Each language has
several centroids (spherical k-means of its training vectors); a text goes to the language of the
centroid with the largest cosine (of equal ones, to the language that comes first by name). A text whose cosine is below the cut of that language and of its
number of letters is rejected; cuts stand in the gap between held-out texts and negatives.
"""

from __future__ import annotations

import random
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from ..shipping import map_arrow
from .common import materialize, table
from .texts import slices

DIMENSIONS = 8192
CENTROIDS = 4
#: The documented bound of training: labelled rows a language, and in all.
TRAIN_PER_LANGUAGE, TRAIN_ROWS = 300, 6000
#: Share of a language's quota that is drawn in the mean where it has more rows.
RATE = 0.9
#: Cuts are set for texts of so many letters on. A text of fewer letters, or of a language with fewer
#: than LEAST_HELD held-out texts, is rejected below REJECT_SHARE of the similarity that 99 % of its
#: language's training texts reach.
BANDS = (16, 32, 64, 128, 256, 512)
REJECT_SHARE, LEAST_HELD = 0.25, 10
#: One of HELD texts is held out for the cuts. A cut lies this share of the gap above 99 % of the negatives,
#: but at most at this share of what 99 % of the held-out texts reach.
HELD, GAP_SHARE, CLEAN_SHARE = 4, 0.25, 0.8
#: Made-up strings (random letters, base64) a band.
MADE_UP = 100
UNKNOWN = "und"
#: Texts counted together.
ROWS = 48

_ALPHA: list[np.ndarray] = []


def _alphabetic() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(counts of hashed grams, one row a text; number of letters of each text)."""
    counts = np.zeros((len(texts), DIMENSIONS), dtype=np.int32)
    letters = np.zeros(len(texts), dtype=np.int64)
    alpha = _alphabetic()
    for i, t in enumerate(texts):
        points = np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = alpha[points]
        letters[i] = int(letter.sum())
        if not letters[i]:
            continue
        keep = letter.copy()
        keep[0] = True
        keep[1:] |= letter[:-1]  # one space after each word
        c = np.where(letter, points, 32)[keep].astype(np.uint64)
        tri = (c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ c[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xFF51AFD7ED558CCD)
        two = (c[:-1] * np.uint64(0x27D4EB2F165667C5) ^ c[1:] * np.uint64(0x85EBCA77C2B2AE63)) * np.uint64(0xC4CEB9FE1A85EC53)
        one = (c + np.uint64(77)) * np.uint64(0xD6E8FEB86659FD93)
        at = (np.concatenate([tri, two, one]) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
        counts[i] = np.bincount(at, minlength=DIMENSIONS)
    return counts, letters


class Model:
    """idf (DIMENSIONS), centroids (rows of unit length), the language of each, and its least similarity:
    a row for texts of fewer letters than BANDS, and one for each band."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, of: list[str], least: np.ndarray):
        self.idf, self.centroids, self.of, self.least = idf, centroids, of, least

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts.astype(np.float32)) * self.idf)

    def predict(self, counts: np.ndarray, letters: np.ndarray) -> list[tuple[str, float, bool]]:
        if not self.of:
            return [(UNKNOWN, 0.0, not n) for n in letters]  # nothing to be far from
        cosines = self.vectors(counts) @ self.centroids.T
        best = cosines.argmax(axis=1)
        top = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
        band = np.searchsorted(BANDS, letters, side="right")
        return [(self.of[b], float(s), bool(s < self.least[k, b])) if n else (UNKNOWN, 0.0, True) for b, s, n, k in zip(best, top, letters, band)]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    pick = np.random.default_rng(seed)
    centres = x[pick.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        of = (x @ centres.T).argmax(axis=1)
        sums = np.stack([x[of == j].sum(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))])
        centres = unit(sums)
    return centres


def fit_model(counts: np.ndarray, langs: list[str], k: int = CENTROIDS, seed: int = 7) -> Model:
    n = len(langs)
    if not n:
        return Model(np.zeros(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), [], np.zeros((len(BANDS) + 1, 0)))
    idf = (np.log((1 + n) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = unit(np.log1p(counts.astype(np.float32)) * idf)
    centroids, of, least, names = [], [], [], np.array(langs)
    for lang in sorted(set(langs)):
        own = x[names == lang]
        centres = spherical_kmeans(own, k, seed)
        reach = float(np.quantile((own @ centres.T).max(axis=1), 0.01))
        centroids.append(centres)
        of += [lang] * len(centres)
        least += [REJECT_SHARE * reach] * len(centres)
    return Model(idf, np.concatenate(centroids).astype(np.float32), of, np.tile(np.array(least), (len(BANDS) + 1, 1)))


def piece(text: str, letters: int) -> str:
    """The shortest start of text with so many letters, or "" if it has fewer."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    at = np.flatnonzero(_alphabetic()[points])
    return text[: int(at[letters - 1]) + 1] if len(at) >= letters else ""


def made_up(letters: int, seed: int) -> list[str]:
    """Random letters in words, and base64."""
    pick = random.Random(seed)
    base = string.ascii_letters + string.digits + "+/"
    words = ["".join(pick.choice(string.ascii_lowercase) + " " * (pick.random() < 0.2) for _ in range(letters)) for _ in range(MADE_UP // 2)]
    return words + ["".join(pick.choices(base, k=letters)) for _ in range(MADE_UP // 2)]


def with_cuts(model: Model, trial: Model, held: list[tuple[str, int, bool, np.ndarray]]) -> Model:
    """model with its cuts from held (language, band, negative, counts): starts of held-out texts and
    shuffled ones, scored by trial, which was fitted without those texts.

    Negatives of a language are made-up strings, shuffled texts and other languages' texts that would
    come to it if their own language were unknown. Those of a band are as long as its longest texts.
    """
    least, of, names = model.least.copy(), np.array(trial.of), sorted(set(model.of))
    for k, letters in enumerate(BANDS):
        some = [h for h in held if h[1] == k]
        if not some:
            continue
        fake, _ = gram_counts(made_up(2 * letters, letters))
        counts = np.concatenate([np.stack([h[3] for h in some]), fake])
        lang, negative = np.array([h[0] for h in some] + [""] * len(fake)), np.array([h[2] for h in some] + [True] * len(fake))
        cosines = trial.vectors(counts) @ trial.centroids.T
        foreign = np.where(of[None, :] == lang[:, None], -1.0, cosines)
        for name in names:
            mine = of == name
            clean = (lang == name) & ~negative
            if clean.sum() < LEAST_HELD or not mine.any():
                continue
            low = float(np.quantile(cosines[clean][:, mine].max(axis=1), 0.01))
            to_it = (negative & mine[cosines.argmax(axis=1)]) | (~negative & (lang != name) & mine[foreign.argmax(axis=1)])
            # made-up strings count for every language: few come to each
            high = float(np.quantile(cosines[to_it | (lang == "")][:, mine].max(axis=1), 0.99))
            cut = min(high + GAP_SHARE * max(low - high, 0.0), CLEAN_SHARE * low)
            least[k + 1, np.array(model.of) == name] = cut
    return Model(model.idf, model.centroids, model.of, least)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts (band -1), and of held-out ones also starts of each band and shuffled starts of its greatest length."""
    for part in slices(batches, limit=1 << 20):
        rows = []
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            digest = zlib.crc32(text.encode("utf-8", "replace"))
            held = digest % HELD == 0
            rows.append((lang, text, held, -1, False))
            for k, letters in enumerate(BANDS if held else ()):
                start, longer = piece(text, letters), list(piece(text, 2 * letters))
                random.Random(digest).shuffle(longer)
                rows += [(lang, t, True, k, negative) for t, negative in ((start, False), ("".join(longer), True)) if t]
        for first in range(0, len(rows), ROWS):
            some = rows[first : first + ROWS]
            counts, letters = gram_counts([r[1] for r in some])
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in some], pa.string()),
                    pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                    pa.array([c[a] for c, a in zip(counts, at)], pa.list_(pa.int32())),
                    pa.array(letters > 0),
                    *(pa.array([r[i] for r in some], kind) for i, kind in ((2, pa.bool_()), (3, pa.int32()), (4, pa.bool_()))),
                ],
                ["lang", "at", "n", "lettered", "held", "band", "negative"],
            )


def fit(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, rows: int = TRAIN_ROWS) -> Model:
    """A model of labelled rows (doc_id, text, lang), drawn by hashes.

    The sample is bounded by rows, and drawn at a rate that gives a language RATE of per_language rows; texts are counted on the executors whole, and only
    gram counts (at most DIMENSIONS a row) come to the driver, of one in HELD also those of its starts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    usable = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", text.alias("text"))
    labelled = usable.select("lang", "doc_id", F.xxhash64("text").alias("th"))
    counts = materialize(labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-counts")
    n_langs = counts.count()
    if not n_langs:
        return fit_model(np.zeros((0, DIMENSIONS)), [])
    # A row is in the sample by its hash alone, at the rate that its language's quota asks for: no language is
    # sorted or ranked in one task. Equal rows are in together, and then count once.
    quota = max(1, min(per_language, rows // n_langs))
    draw = F.xxhash64(F.lit(17), "doc_id", "th")
    rate = F.when(F.col("n") <= quota, 1.0).otherwise(RATE * quota / F.col("n"))
    small = F.broadcast(counts) if n_langs <= rows else counts
    chosen = labelled.join(small, "lang").filter(F.pmod(draw, F.lit(1 << 30)) < rate * (1 << 30)).select("lang", "doc_id", "th").distinct()
    chosen = materialize(chosen.orderBy(draw, "lang", "doc_id").limit(rows), "langid-sample")
    # At most `rows` keys: small enough to broadcast at any size of the input. Equal rows count once.
    texts = usable.withColumn("th", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "doc_id", "th"], "left_semi").dropDuplicates(["lang", "doc_id", "th"]).select("lang", "text")
    counted = map_arrow(texts, _count_batches, "lang string, at array<int>, n array<int>, lettered boolean, held boolean, band int, negative boolean").filter("lettered")
    found = sorted((r["lang"], tuple(r["at"]), tuple(r["n"]), r["held"], r["band"], r["negative"]) for r in counted.collect())

    def dense(some: list[tuple]) -> np.ndarray:
        counts = np.zeros((len(some), DIMENSIONS), dtype=np.int32)
        for i, (_, at, n, *_) in enumerate(some):
            counts[i, list(at)] = n
        return counts

    whole = [f for f in found if f[4] < 0]
    counts = dense(whole)
    langs, seen = [f[0] for f in whole], np.array([not f[3] for f in whole], dtype=bool)
    model = fit_model(counts, langs)
    trial = fit_model(counts[seen], [x for x, s in zip(langs, seen) if s])
    if not trial.of:
        return model
    del counts
    for k in range(len(BANDS)):  # one band's counts at a time
        some = [f for f in found if f[4] == k]
        model = with_cuts(model, trial, [(f[0], k, f[5], c) for f, c in zip(some, dense(some))])
    return model


def _predict_batches(batches: Iterator[pa.RecordBatch], model: Model, whole: bool = False) -> Iterator[pa.RecordBatch]:
    """The columns but text (whole: all columns) with lang_pred, score and rejected."""
    for part in slices(batches, fill=not whole):
        found = []
        texts = part.column("text")
        for at in range(0, part.num_rows, ROWS):
            found += model.predict(*gram_counts([t or "" for t in texts.slice(at, ROWS).to_pylist()]))
        lang, score, rejected = zip(*found) if found else ((), (), ())
        kept = [part.column(i) for i, c in enumerate(part.schema.names) if whole or c != "text"]
        names = [c for c in part.schema.names if whole or c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            [*names, *(("_" * whole + c).replace("_score", "_lang_score").replace("_rejected", "_lang_rejected") for c in ("lang_pred", "score", "rejected"))],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, rejected: one row per row of docs.

    Null texts and texts without letters are `und`, with score 0, and rejected. Repeated doc_ids are
    rows of their own. Without any training rows every text is `und`, and those with letters are not
    rejected. Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda it: _predict_batches(it, model), "doc_id long, lang_pred string, score double, rejected boolean")


def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """docs with _lang_pred, _lang_score and _lang_rejected added; rows pass through whole, without a join."""
    kind = StructType([*docs.schema.fields, StructField("_lang_pred", StringType()), StructField("_lang_score", DoubleType()), StructField("_lang_rejected", BooleanType())])
    return map_arrow(docs, lambda it: _predict_batches(it, model, True), kind)


def fold(doc_id) -> object:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold("doc_id") != 2))
    return predict(docs, model).select("doc_id", F.coalesce(fold("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
