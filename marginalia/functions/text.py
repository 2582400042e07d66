"""Text folding, skeletons and identifiers as Column expressions.

Only Unicode normalisation has no built-in: an Arrow UDF does it, for texts that aren't ASCII.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Categories that folding drops: marks, modifier letters and symbols, other symbols, format characters (fixed values).
DROPPED = r"[\p{Mn}\p{Me}\p{Lm}\p{Sk}\p{So}\p{Cf}]"
#: Letters and digits that match_fold sends to one another (fixed values).
MATCH = {
    "آ": "ا", "أ": "ا", "ؤ": "و", "إ": "ا", "ئ": "ي", "ة": "ه", "ى": "ي", "ٱ": "ا",
    "٠": "0", "١": "1", "٢": "2", "٣": "3", "٤": "4", "٥": "5", "٦": "6", "٧": "7", "٨": "8", "٩": "9",
    "۰": "0", "۱": "1", "۲": "2", "۳": "3", "۴": "4", "۵": "5", "۶": "6", "۷": "7", "۸": "8", "۹": "9",
}
#: Letters a loose key leaves out (fixed values).
LOOSE = "اء"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def _normal(text: Column, udf) -> Column:
    """ASCII texts are normal already and cross to Python as nulls: a branch alone would send every text there."""
    return F.coalesce(udf(F.when(~text.rlike(r"^\p{ASCII}*$"), text)), text)


def _spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_marks(text: Column) -> Column:
    return _spaces(F.regexp_replace(text, DROPPED, ""))


def search_key(text: Column) -> Column:
    """NFC, without marks and symbols, white space collapsed and trimmed."""
    return strip_marks(_normal(text, _nfc))


def match_fold(text: Column) -> Column:
    """NFKC, stripped as a search key, then letters and digits folded in one pass."""
    return F.translate(strip_marks(_normal(text, _nfkc)), "".join(MATCH), "".join(MATCH.values()))


def loose_key(text: Column) -> Column:
    """A match fold without the letters that spellings disagree on; lossy."""
    return F.translate(match_fold(text), LOOSE, "")


def search_variants(text: Column) -> Column:
    """Up to six distinct, non-empty spellings to search for, in a fixed order."""
    bases = F.array(match_fold(text), match_fold(F.replace(text, F.lit("ٰ"), F.lit("ا"))))
    folds = F.transform(bases, lambda b: F.array(b, *[F.replace(b, F.lit("ء"), F.lit(to)) for to in ("", "ي")]))
    return F.array_distinct(F.filter(F.flatten(folds), lambda x: x != ""))


def skeleton(text: Column, keep: str = "a-z", source: str = "", target: str = "") -> Column:
    """Letters only, lower-cased, after a fold table of the source."""
    return F.regexp_replace(F.translate(F.lower(text), source, target), f"[^{keep}]", "")


def fold_to_convention(text: Column, sequences: list[tuple[str, str]], source: str = "", target: str = "") -> Column:
    """Replacements of several characters in order, then single ones."""
    for old, new in sequences:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.translate(text, source, target) if source else text


def segments(text: Column, closers: str) -> Column:
    """Pieces of a word: each ends after a closer, the last may lack one."""
    return F.regexp_extract_all(text, F.lit(f"[^{closers}]*[{closers}]|[^{closers}]+"), F.lit(0))


def letter_positions(text: Column) -> Column:
    """``array<struct<ch, place>>``: isolated, initial, medial or final."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars)
    place = lambda i: F.when(n == 1, "isolated").when(i == 0, "initial").when(i == n - 1, "final").otherwise("medial")
    return F.transform(chars, lambda c, i: F.struct(c.alias("ch"), place(i).alias("place")))


def split_identifier(text: Column) -> Column:
    """Lower-cased parts of an identifier: at ``_ . -`` blanks and camel-case humps."""
    humps = F.regexp_replace(text, r"([a-z0-9])([A-Z])", "$1 $2")
    return F.transform(F.filter(F.split(F.regexp_replace(humps, r"[_.\-\s]+", " "), " "), lambda x: x != ""), F.lower)


def ramp(v: Column, a: float, b: float, pa: float, pb: float) -> Column:
    """Linear from (a, pa) to (b, pb), constant outside."""
    t = (v - a) / (b - a)
    return pa + (pb - pa) * F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))


#: Soft probabilities of evidence that isn't a curve (fixed values).
WEIGHTS = {"dots": 0.80, "family": 0.55, "surplus": 0.35, "ref-line": 0.60}
LABELS = {"none": 0.15, "auto": 0.03, "human": 0.0}


def _curve(proof: Column, soft: Column) -> tuple[Column, Column]:
    sure = F.coalesce(proof, F.lit(False))
    return F.when(sure, 1.0).otherwise(F.coalesce(soft, F.lit(0.0))), sure


def p_size(ratio: Column, proof_ok: Column | bool = True) -> tuple[Column, Column]:
    """(probability, proof) of a size over its median: soft beyond 2 times either way, from 3 times on a proof, or 0.6 where a proof isn't
    allowed.  Without a ratio, or at 0, nothing."""
    off, ok = F.greatest(ratio, 1.0 / F.nullif(ratio, F.lit(0.0))), F.lit(proof_ok) if isinstance(proof_ok, bool) else F.coalesce(proof_ok, F.lit(False))
    odd = (ratio != 0) & ((ratio >= 3.0) | (ratio <= 1 / 3))
    return _curve(odd & ok, F.when(odd, 0.60).when(off > 2.0, ramp(off, 2.0, 3.0, 0.15, 0.60)))


def p_stray(gap: Column) -> tuple[Column, Column]:
    """(probability, proof) of a distance from one's own: soft beyond 2, from 40 on a proof."""
    return _curve(gap >= 40.0, F.when(gap > 2.0, ramp(gap, 2.0, 40.0, 0.05, 0.65)))


def p_band(outside: Column) -> tuple[Column, Column]:
    """(probability, proof) of a distance from one's band: 0.05 beyond 5, rising beyond 10, from 15 on a proof."""
    return _curve(outside >= 15.0, F.when(outside > 10.0, ramp(outside, 10.0, 15.0, 0.35, 0.70)).when(outside > 5.0, 0.05))


def p_label(status: Column) -> Column:
    """Of a label by its origin: none, auto or human; others and nulls nothing."""
    p = F.lit(0.0)
    for name, value in LABELS.items():
        p = F.when(status == name, value).otherwise(p)
    return p


def p_width(ratio: Column, off: Column) -> Column:
    """Soft evidence only: a ratio outside [0.70, 1.45] that is off by 4 at least; rising to 2 times either way, 0.85 from there on."""
    far = F.greatest(ratio, 1.0 / F.greatest(ratio, F.lit(1e-6)))
    odd = (off >= 4.0) & ((ratio < 0.70) | (ratio > 1.45))
    return F.when(odd & (far >= 2.0), 0.85).when(odd, ramp(far, 1.45, 2.0, 0.20, 0.60)).otherwise(F.lit(0.0))


def shape_signature(points: Column) -> Column:
    """16 hex digits of an outline (``array<struct<x, y>>``): centred, scaled by its larger span, rounded half-even to 0.1."""
    n = F.size(points)
    centre = lambda f: F.aggregate(points, F.lit(0.0), lambda s, p: s + p[f]) / n
    span = lambda f: F.array_max(F.transform(points, lambda p: p[f])) - F.array_min(F.transform(points, lambda p: p[f]))
    scale = F.greatest(span("x"), span("y"))
    unit = lambda p, f: F.round(F.bround((p[f] - centre(f)) / F.when(scale > 0, scale).otherwise(1.0), 1) * 10).cast("int").cast("string")
    return F.substring(F.md5(F.array_join(F.transform(points, lambda p: F.concat_ws(",", unit(p, "x"), unit(p, "y"))), ";")), 1, 16)


def shape_distance(a: Column, b: Column) -> Column:
    """Mean distance of the points of two outlines; infinite if their lengths differ or there are no points."""
    each = F.zip_with(a, b, lambda p, q: F.sqrt(F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2)))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), F.aggregate(each, F.lit(0.0), lambda s, d: s + d) / F.size(a)).otherwise(F.lit(float("inf")))


def content_sig(*parts: Column) -> Column:
    """8 hex digits of some values; lists count in sorted order."""
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
