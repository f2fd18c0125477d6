"""Column functions on text: normal forms, tokens, similarity, clean-up."""

from __future__ import annotations

import json
import re
import unicodedata
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that NFKD leaves whole.
FOLDS = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "đ": "d", "æ": "ae", "œ": "oe"})


@F.pandas_udf(T.StringType())
def fold_unicode(s: pd.Series) -> pd.Series:
    """NFKD, case-folded, without combining marks, every run of other characters one space. Spark has no built-in NFKD."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", x.casefold()) if not unicodedata.combining(c)).translate(FOLDS)
        return re.sub(r"[\W_]+", " ", plain).strip()

    return s.map(one)


@F.pandas_udf(T.StringType())
def compat_fold(s: pd.Series) -> pd.Series:
    """NFKC and case-folded; only letters, numbers and marks stay."""

    def one(x: str | None) -> str | None:
        return None if x is None else " ".join("".join(c if unicodedata.category(c)[0] in "LNM" else " " for c in unicodedata.normalize("NFKC", x).casefold()).split())

    return s.map(one)


def plain(c: Column) -> Column:
    """Lower case, punctuation to spaces, spaces collapsed. ASCII classes, so all engines agree."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(plain(c), " "), lambda t: t != "")


def core_tokens(c: Column, generic: list[str]) -> Column:
    """Tokens without the generic ones, in order."""
    return F.filter(tokens(c), lambda t: ~t.isin(generic))


def is_generic(c: Column, generic: list[str]) -> Column:
    """At most one distinctive token."""
    return F.size(core_tokens(c, generic)) <= 1


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct tokens; 0 for two empty arrays."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def is_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, with one bit per character of b."""
    at: dict[str, int] = {}
    for i, c in enumerate(b):
        at[c] = at.get(c, 0) | 1 << i
    row, full = 0, (1 << len(b)) - 1
    for c in a:
        x = row | at.get(c, 0)
        row = x & ~(x - (row << 1 | 1)) & full
    return row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs_length(a, b) / (len(a) + len(b))


def sort_ratio(a: str, b: str) -> float:
    """Indel ratio of the sorted tokens."""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def set_ratio(a: str, b: str) -> float:
    """Best indel ratio among the shared tokens and each side's shared plus own tokens."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if shared and (not left or not right):
        return 100.0
    base, one, two = " ".join(shared), " ".join(shared + left), " ".join(shared + right)
    best = indel_ratio(one, two)
    return max(best, indel_ratio(base, one), indel_ratio(base, two)) if shared else best


@F.pandas_udf(T.StructType([T.StructField("strict", T.DoubleType()), T.StructField("loose", T.DoubleType())]))
def name_scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """strict: the lesser of sort and set ratio; loose: the greater. Only for pairs that a block join proposes."""
    rows = [(sort_ratio(x or "", y or ""), set_ratio(x or "", y or "")) for x, y in zip(a, b)]
    return pd.DataFrame({"strict": [min(r) for r in rows], "loose": [max(r) for r in rows]})


@F.pandas_udf(T.DoubleType())
def count_cosine(ta: pd.Series, na: pd.Series, tb: pd.Series, nb: pd.Series) -> pd.Series:
    """Cosine of two term counts: sorted distinct terms and the count of each; 0 without terms."""

    def one(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> float:
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        size = float((n * n).sum()) * float((m * m).sum())
        return float((n[i] * m[j]).sum()) / size**0.5 if size else 0.0

    return pd.Series([one(*map(np.asarray, r)) for r in zip(ta, na, tb, nb)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio, direct or of the sorted tokens, whichever is more."""

    def one(x: str, y: str) -> float:
        s, t = " ".join(sorted(x.split())), " ".join(sorted(y.split()))
        return max(SequenceMatcher(None, x, y, autojunk=False).ratio(), SequenceMatcher(None, s, t, autojunk=False).ratio())

    return pd.Series([one(x or "", y or "") for x, y in zip(a, b)])


@F.pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts as they stand, from 0 to 1."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_leaves(s: pd.Series) -> pd.Series:
    """path=value of every leaf of a JSON text, in order; null for null, an empty array for what is no JSON. Depth has no bound in Spark's JSON functions."""

    def walk(value: object, path: str, out: list[str]) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                walk(v, f"{path}.{k}" if path else k, out)
        elif isinstance(value, list):
            for i, v in enumerate(value):
                walk(v, f"{path}[{i}]", out)
        else:
            out.append(f"{path}={value if isinstance(value, str) else json.dumps(value)}")

    def one(x: str | None) -> list[str] | None:
        if x is None:
            return None
        out: list[str] = []
        try:
            walk(json.loads(x), "", out)
        except (ValueError, RecursionError):
            return []
        return out

    return s.map(one)


def clean_controls(c: Column) -> Column:
    """Control characters out, runs of blanks to one."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]", ""), "[ \\t]+", " "))


def has_mojibake(c: Column) -> Column:
    """UTF-8 that was read as a one-byte code page."""
    return c.rlike("Ã[\\u0080-\\u00BF]|â\\u0080|\\uFFFD")


def strip_affixes(c: Column) -> Column:
    """Without a leading 'by', a trailing date and a trailing role in brackets."""
    out = F.regexp_replace(c, "(?i)^\\s*by\\s+", "")
    out = F.regexp_replace(out, "\\s*\\([^()]*\\)\\s*$", "")
    return F.trim(F.regexp_replace(out, "[,\\s]+(1[89]|20)[0-9]{2}\\s*$", ""))


def search_keywords(c: Column, stop: list[str], least: int = 3) -> Column:
    """Distinct tokens of at least so many characters that are no stop words, sorted."""
    return F.array_sort(F.array_distinct(F.filter(tokens(c), lambda t: (F.length(t) >= least) & ~t.isin(stop))))


def truncated(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)


def joined(*cs: Column, most: int | None = None) -> Column:
    """Non-empty parts joined by a space."""
    out = F.concat_ws(" ", *(F.nullif(F.trim(c), F.lit("")) for c in cs))
    return truncated(out, most) if most else out
