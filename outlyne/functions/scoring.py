"""Column functions: robust scale, z-scores, tiers, bands, phrases and tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import BLEND, BLEND_TAGS, EPS, GENUINE, MAD_SCALE, NEUTRAL, NOT_GENUINE, SHORT_TIERS, TIERS


def is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def fallback_spread(mad: Column, std: Column) -> Column:
    """Scaled MAD, or the standard deviation where that is less than half of it."""
    r = MAD_SCALE * F.coalesce(mad, F.lit(0.0))
    std = F.coalesce(std, F.lit(0.0))
    return F.when(r >= 0.5 * std, r).otherwise(std)


def stats_spread(mad: Column, std: Column) -> Column:
    """The spread of a new statistics row."""
    s = fallback_spread(mad, std)
    return F.when(s >= EPS, s).when(std > EPS, std).otherwise(1.0)


def spread(stored: Column, mad: Column, std: Column) -> Column:
    """The spread to divide by: the stored one if it is usable."""
    s = fallback_spread(mad, std)
    return F.when(stored > EPS, stored).when(s > EPS, s).otherwise(1.0)


def zscore(value: Column, median: Column, scale: Column) -> Column:
    return (value - median) / (scale + EPS)


def direction(z: Column) -> Column:
    return F.when(z >= 0, "above").when(z < 0, "below")


def tier(z: Column, capped: Column | None = None) -> Column:
    """Intensity of |z|; capped rows get no more than the third tier."""
    out = F
    for bound, word in TIERS[:-1]:
        hit = F.abs(z) >= bound
        if capped is not None and bound > 1.0:
            hit = hit & ~capped
        out = out.when(hit, word)
    return out.otherwise(TIERS[-1][1])


def level(value: Column, bounds: Sequence[float], words: Sequence[str]) -> Column:
    """The word of the first bound above the value; null for NaN, null, or a value beyond all bounds."""
    out = F
    for b, w in zip(bounds, words):
        out = out.when(value < b, w)
    return F.lit(None).cast("string") if out is F else out


def by_dim(dim: Column, table: Mapping[str, str | None | Sequence], kind: str = "string") -> Column:
    """The entry of a small fixed table for a dimension; null without one.

    One lookup in a literal map, however many dimensions there are: the JVM does not compile methods beyond 8000 bytes, and a branch for each makes them.
    """
    entry = lambda v: F.lit(list(v) if isinstance(v, (list, tuple)) else v).cast(kind)
    return F.element_at(F.create_map(*[x for d, v in table.items() for x in (F.lit(d), entry(v))]), dim) if table else F.lit(None).cast(kind)


def short_tag(intensity: Column, word: Column) -> Column:
    """Short intensity and word; null without a word."""
    return F.when(word.isNotNull(), F.trim(F.concat(F.coalesce(by_dim(intensity, SHORT_TIERS), F.lit("")), F.lit(" "), word)))


def emotion_phrase(z: Column, intensity: Column, word: Column) -> Column:
    return F.when(z >= 0, F.concat(F.lower(intensity), F.lit(" carrying "), word)).otherwise(F.concat(F.lit("notably free of "), word))


def emotion_tag(z: Column, intensity: Column, word: Column) -> Column:
    return F.when(z >= 0, short_tag(intensity, word)).otherwise(F.concat(F.lit("no "), word))


def gate(value: Column, median: Column, z: Column) -> Column:
    """open, capped or dropped; open without a value or a baseline."""
    return F.when(value.isNull() | median.isNull() | (value >= median), "open").when(z > -1.0, "capped").otherwise("dropped")


def genuine_phrase(z: Column) -> Column:
    out = F
    for bound, words in GENUINE[:2]:
        out = out.when(z >= bound, words)
    return out.when(z > GENUINE[2][0], GENUINE[2][1]).when(z.isNotNull(), NOT_GENUINE)


def genuine_tag(z: Column) -> Column:
    return F.when(z >= 0, "genuine").when(z > -1.0, "semi-genuine").when(z.isNotNull(), "performed")


def blend_phrase(z: Column) -> Column:
    return F.when(z >= NEUTRAL, BLEND[0]).when(z <= -NEUTRAL, BLEND[1])


def blend_tag(z: Column) -> Column:
    return F.when(z >= NEUTRAL, BLEND_TAGS[0]).when(z <= -NEUTRAL, BLEND_TAGS[1])


def clamp(x: Column, lo: float, hi: float) -> Column:
    """Into [lo, hi]; NaN stays."""
    return F.when(F.isnan(x), x).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def first_upper(s: Column) -> Column:
    """Only the first character of the trimmed text."""
    t = F.trim(s)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)))


def draw(seed: Column, salt: str, key: Column | None = None) -> Column:
    """A seeded 32-bit draw: the first eight hex digits of md5(seed|salt|key); a null seed is 0."""
    parts = [F.coalesce(seed, F.lit(0)).cast("string"), F.lit(salt), *([key.cast("string")] if key is not None else [])]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def pick(options: Sequence[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), F.pmod(n, F.lit(len(options))).cast("int") + 1)


def one_decimal(x: Column) -> Column:
    """Text with one decimal, ties away from zero; what a difference of times leaves beyond the sixth place does not count."""
    return F.round(F.round(x, 6), 1).cast("decimal(20,1)").cast("string")


def pause_text(gap: Column) -> Column:
    return F.concat(F.lit("[pause "), one_decimal(gap), F.lit("s]"))


def html_escape(s: Column) -> Column:
    """& < > and both quotes."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def emphasise(s: Column) -> Column:
    """Parenthesised parts marked."""
    return F.regexp_replace(s, r"\(([^)]+)\)", '<span class="burst">($1)</span>')


def scalar_cell(text: Column) -> Column:
    """A number, or an object with a number under value, reg_score, reg, r or score (the first that is present); null if neither."""
    keys = ("value", "reg_score", "reg", "r", "score")
    obj = F.startswith(F.trim(text), F.lit("{"))
    inner = F.lit(None).cast("string")
    for k in reversed(keys):
        inner = F.when(F.array_contains(F.json_object_keys(text), k), F.get_json_object(text, f"$.{k}")).otherwise(inner)
    return F.when(obj, inner.try_cast("double")).otherwise(F.trim(text, F.lit('"')).try_cast("double"))


def segment(start: Column, end: Column, duration: Column, pad: float) -> tuple[Column, Column]:
    """Padded bounds inside [0, duration]; the whole clip if a time is missing or the end is not after the start."""
    ok = start.isNotNull() & end.isNotNull() & (end > start)
    return F.when(ok, F.greatest(F.lit(0.0), start - pad)).otherwise(0.0), F.when(ok, F.least(duration, end + pad)).otherwise(duration)


def fit_length(samples: Column, n: int) -> Column:
    """Cut, or filled with zeros, to n samples."""
    return F.slice(F.concat(samples, F.array_repeat(F.lit(0.0), n)), 1, n)


def cut_samples(samples: Column, start: Column, end: Column, rate: int) -> Column:
    a, b = (start * rate).cast("int"), (end * rate).cast("int")
    return F.slice(samples, a + 1, F.greatest(F.lit(0), b - a))


def level_count(levels: Column) -> Column:
    """Number of levels of a head, seven if none are named."""
    n = F.size(levels)
    return F.when(levels.isNotNull() & (n > 0), n).otherwise(7)
