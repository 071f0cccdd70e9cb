"""Text functions of record linkage as column expressions.

Null counts as the empty string everywhere. Only Unicode normalisation and case folding need Python (Arrow
batches); all else is built-in and stays in generated code. Lengths and orders are by code point.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space as Python's str.isspace has it.
SPACE = r"\p{Z}\t-\r\x1c-\x1f\x85"
PAIR_SEPARATOR = "\x1e"

#: Words of business names that carry no identity.
STOPWORDS = (
    "ltd", "limited", "llc", "inc", "incorporated", "corp", "corporation", "co", "company",
    "pvt", "private", "plc", "llp", "lp", "services", "service",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space at both ends; null as the empty string."""
    return F.regexp_replace(text_of(c), rf"^[{SPACE}]+|[{SPACE}]+$", "")


def _folding(form: str, fold: bool, drop_marks: bool):
    def one(s: str) -> str:
        if s.isascii():
            return s.lower() if fold else s
        s = unicodedata.normalize(form, s)
        if drop_marks:
            s = "".join(c for c in s if not unicodedata.combining(c))
        return s.casefold() if fold else s

    @F.pandas_udf(T.StringType())  # no iterator: each of those has Python workers of its own, these share
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run


# ---- normalised and fingerprint forms


def normalize_text(c: Column | str) -> Column:
    """NFKC, case-folded; punctuation, symbols and white space become single spaces; marks stay."""
    folded = _folding("NFKC", True, False)(text_of(c))
    return F.trim(F.regexp_replace(folded, rf"[\p{{P}}\p{{S}}{SPACE}]+", " "))


normalize_business_name = normalize_business_address = normalize_country = normalize_text


def fingerprint_text(c: Column | str) -> Column:
    """Letters, marks and numbers only, in order."""
    return F.regexp_replace(text_of(c), r"[^\p{L}\p{M}\p{N}]", "")


fingerprint_name = fingerprint_address = fingerprint_country = fingerprint_text


# ---- tokens and signatures


def tokens(c: Column | str, least: int = 1) -> Column:
    """Runs of letters and numbers, at least ``least`` long, in order with repeats."""
    found = F.regexp_extract_all(strip(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.filter(found, lambda t: F.length(t) >= least) if least > 1 else found


def _by_length(words: Column) -> Column:
    """Distinct words, longest first, then in code point order."""
    pairs = F.transform(F.array_distinct(words), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.transform(F.array_sort(pairs), lambda s: s["t"])


def token_signatures(c: Column | str, least: int = 3, most: int = 3) -> Column:
    """The ``most`` longest distinct tokens."""
    return F.slice(_by_length(tokens(c, least)), 1, most)


def token_signature(c: Column | str, least: int = 3) -> Column:
    """The longest token; of equals the first in order; empty if there is none."""
    return F.coalesce(F.try_element_at(token_signatures(c, least, 1), F.lit(1)), F.lit(""))


def prefix_signature(c: Column | str, least: int = 3, length: int = 4) -> Column:
    """The first characters of the token signature."""
    return F.left(token_signature(c, least), F.lit(length))


def _significant(words: Column) -> Column:
    return F.filter(words, lambda t: ~F.lower(t).isin(*STOPWORDS))


def token_pair_signature(c: Column | str, least: int = 2) -> Column:
    """The two longest distinct tokens that are no stopwords, in order, joined; empty if there are fewer."""
    top = F.slice(_by_length(_significant(tokens(c, least))), 1, 2)
    return F.when(F.size(top) == 2, F.array_join(F.array_sort(top), PAIR_SEPARATOR)).otherwise("")


def soundex(c: Column | str) -> Column:
    """Four-character sound code in which every non-coded letter, H and W too, separates equal codes.

    Other characters than A-Z count for nothing; empty without letters. Not Spark's ``soundex``.
    """
    letters = F.upper(F.regexp_replace(text_of(c), "[^A-Za-z]", ""))
    digits = F.translate(letters, "BFPVCGJKQSXZDTLMNRAEIOUHWY", "11112222222233455600000000")
    runs = F.regexp_replace(digits, r"(.)\1+", "$1")
    code = F.concat(F.left(letters, F.lit(1)), F.replace(F.substr(runs, F.lit(2)), F.lit("0"), F.lit("")))
    return F.when(letters == "", "").otherwise(F.rpad(F.left(code, F.lit(4)), 4, "0"))


def soundex_signatures(c: Column | str, least: int = 3, most: int = 3) -> Column:
    """Distinct codes of the ``most`` longest tokens that are no stopwords."""
    top = F.slice(_by_length(_significant(tokens(c, least))), 1, most)
    return F.filter(F.array_distinct(F.transform(top, soundex)), lambda s: s != "")


def name_tokens(c: Column | str, least: int = 4) -> Column:
    """Distinct white-space words of a normalised name, long enough and no stopwords."""
    words = F.filter(F.split(text_of(c), " "), lambda t: F.length(t) >= least)
    return F.array_distinct(_significant(words))


def token_set(c: Column | str) -> Column:
    """Distinct words between white space."""
    return F.array_distinct(F.filter(F.split(text_of(c), f"[{SPACE}]+"), lambda t: t != ""))


# ---- forms of the recovery steps


def _spaced_ascii(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "[^a-z0-9]+", " "))


def recovery_normalize(c: Column | str) -> Column:
    """Lower-cased and decomposed without combining marks; runs of anything but a-z and 0-9 become spaces."""
    return _spaced_ascii(_folding("NFKD", False, True)(F.lower(strip(c))))


def ascii_encode_normalize(c: Column | str) -> Column:
    """Decomposed, everything outside ASCII deleted, lower-cased, the rest as in ``recovery_normalize``."""
    kept = F.regexp_replace(_folding("NFKD", False, False)(text_of(c)), r"[^\x00-\x7F]", "")
    return _spaced_ascii(F.lower(kept))


def ascii_regex_normalize(c: Column | str) -> Column:
    """Lower-cased; runs of anything but a-z and 0-9 become spaces."""
    return _spaced_ascii(F.lower(text_of(c)))


def compact_text(c: Column | str) -> Column:
    """``recovery_normalize`` without its spaces."""
    return F.replace(recovery_normalize(c), F.lit(" "), F.lit(""))


def number_tokens(c: Column | str) -> Column:
    """Distinct runs of digits of the recovery form."""
    return F.array_distinct(F.regexp_extract_all(recovery_normalize(c), F.lit(r"\d+"), F.lit(0)))


def char_ngrams(c: Column | str, n: int = 3) -> Column:
    """Distinct character n-grams without spaces; a shorter text is one; empty text none."""
    compact = F.replace(text_of(c), F.lit(" "), F.lit(""))
    grams = F.transform(F.sequence(F.lit(1), F.length(compact) - n + 1), lambda i: F.substr(compact, i, F.lit(n)))
    none = F.array().cast("array<string>")
    return F.when(compact == "", none).when(F.length(compact) < n, F.array(compact)).otherwise(F.array_distinct(grams))


def sorted_tokens(c: Column | str) -> Column:
    """Distinct words in order, joined by spaces."""
    return F.array_join(F.array_sort(token_set(c)), " ")


def leading_text(c: Column | str, length: int = 8) -> Column:
    return F.left(text_of(c), F.lit(length))


def match_ids(c: Column | str) -> Column:
    """A comma-separated list of ids as an array: trimmed, without empties, repeats stay."""
    return F.filter(F.transform(F.split(text_of(c), ","), lambda x: F.trim(x)), lambda x: x != "")
