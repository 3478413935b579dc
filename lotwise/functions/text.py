"""Text expressions: folding of accents, keys, tokens, overlaps, similarity."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin() -> tuple[str, str]:
    """Accented Latin letters that one ASCII letter remains of, and those letters; made from the Unicode data."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    found = [(c, d[0]) for c, d in pairs if d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:]) and len(d) > 1]
    return "".join(c for c, _ in found), "".join(d for _, d in found)


ACCENTED, PLAIN = _latin()
#: Combining marks, for texts that come decomposed.
MARKS = "[\\u0300-\\u036F]"


def fold(c: Column) -> Column:
    """Without the accents of Latin letters; stays in generated code."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), MARKS, "")


def _fold_series(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))


def fold_exact(c: Column) -> Column:
    """Full compatibility decomposition without combining marks, for alphabets beyond Latin."""
    return F.pandas_udf(_fold_series, "string")(c)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[\\s\\u00A0]+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def upper_key(c: Column) -> Column:
    """Upper case, no accents, no punctuation, single spaces; null if nothing is left."""
    return F.nullif(squeeze(F.regexp_replace(fold(F.upper(F.trim(c))), "[^A-Za-z0-9_\\s]", "")), F.lit(""))


def lower_key(c: Column) -> Column:
    """Lower case, no accents, punctuation as space, single spaces; empty for null."""
    return F.coalesce(squeeze(F.regexp_replace(fold(F.lower(F.trim(c))), "[^a-z0-9]+", " ")), F.lit(""))


def plain_lower(c: Column) -> Column:
    """Lower case without accents, outer spaces trimmed; empty for null."""
    return F.coalesce(fold(F.lower(F.trim(c))), F.lit(""))


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def ascii_upper(c: Column) -> Column:
    """Upper case with accents folded and what isn't ASCII dropped."""
    return F.regexp_replace(fold(F.upper(c)), "[^\\x00-\\x7F]", "")


def tokens(c: Column, stop: tuple[str, ...] = ()) -> Column:
    """Words of the lower key without stop words; repeats stay."""
    parts = F.filter(F.split(lower_key(c), " "), lambda t: t != "")
    return F.filter(parts, lambda t: ~t.isin(*stop)) if stop else parts


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def shared_terms(a: Column, b: Column) -> Column:
    return F.array_join(F.array_sort(F.array_intersect(a, b)), " ")


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(overlap(a, b).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def either_contains(a: Column, b: Column) -> Column:
    """One text holds the other; the empty text is in every text."""
    return F.contains(a, b) | F.contains(b, a)


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence; the rows of the table are the bits of one number."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & at.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    """100 less the share of letters to take out of both until they are equal."""
    return 200.0 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


def _token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (x - y, y - x))
    if not x or not y:
        return 0.0
    return max(_ratio(both, left), _ratio(both, right), _ratio(left, right)) if both else _ratio(left, right)


def _partial(a: str, b: str) -> float:
    """The best ratio of the shorter text and a piece of the longer one as long as it, or what is left of one at an end."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    m = len(short)
    return max(_ratio(short, long[max(0, s) : s + m]) for s in range(1 - m, len(long)))


def _token_set_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if x is None or y is None else _token_set(x, y) for x, y in zip(a, b)])


def token_set_ratio(a: Column | str, b: Column | str) -> Column:
    """0-100: similarity of the words that both have with those of either. Meant for distinct pairs of short labels."""
    return F.pandas_udf(_token_set_series, "double")(a, b)


def fuzzy_ratio(a: Column | str, b: Column | str) -> Column:
    """0-100: the better of token-set and partial similarity. Meant for distinct pairs of short labels."""
    return F.pandas_udf(_fuzzy_series, "double")(a, b)


def _fuzzy_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([0.0 if x is None or y is None else max(_token_set(x, y), _partial(x, y)) for x, y in zip(a, b)])


def year_in(c: Column) -> Column:
    """The first year from 1900 to 2099 that stands in the text."""
    return F.try_to_number(F.nullif(F.regexp_extract(c, "((?:19|20)\\d{2})", 1), F.lit("")), F.lit("9999")).cast("int")


def location_head(c: Column) -> Column:
    """The place before the first dash between spaces, then before the first comma, without outer punctuation."""
    dashed = F.regexp_replace(c, "[\\u2010-\\u2015\\u2212]", "-")
    head = F.get(F.split(dashed, "\\s+-\\s+"), F.lit(0))
    return F.trim(F.regexp_replace(F.substring_index(head, ",", 1), "^[\\s.;:-]+|[\\s.;:-]+$", ""))


def zip_candidate(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "\\b(\\d{4,6})\\b", 1), F.lit(""))


def id_text(c: Column) -> Column:
    """An id as text, without the ``.0`` of a number that was read as a decimal."""
    return F.regexp_replace(F.trim(c.cast("string")), "\\.0$", "")


def file_safe(name: str) -> str:
    """A file name of letters, digits, dash, dot and underscore."""
    return "".join(ch if ch.isalnum() or ch in "-._" else "_" for ch in name).strip("_") or "query"


def first_filled(*columns: Column) -> Column:
    """The first of the texts that is neither null nor blank."""
    return F.coalesce(*(blank_to_null(c) for c in columns))


def labelled_pair(a: Column, b: Column) -> Column:
    """Both texts with a dash between, or the one that is there."""
    return F.concat_ws(" - ", blank_to_null(a), blank_to_null(b))
