"""Text normal forms. What is ASCII stays in the JVM; only the rest crosses to Python, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms at the end of company names.
LEGAL_SUFFIXES = ("inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company", "lp", "llp", "plc", "ulc", "ltee", "ltée")
# Mail domains of private persons.
PERSONAL_MAIL = (
    "aol.com", "gmail.com", "googlemail.com", "hotmail.com", "icloud.com", "live.com", "me.com", "msn.com", "outlook.com", "proton.me", "protonmail.com", "yahoo.com", "ymail.com",
)


@F.arrow_udf(T.StringType())
def _nfkc_casefold(values: pa.Array) -> pa.Array:
    coded = pc.dictionary_encode(values)
    folded = pa.array([None if v is None else unicodedata.normalize("NFKC", v).casefold() for v in coded.dictionary.to_pylist()], pa.string())
    return folded.take(coded.indices)


def compatibility_fold(value: Column) -> Column:
    """NFKC and case folding; null stays null."""
    ascii_only = ~value.rlike(r"[^\x00-\x7F]")
    return F.coalesce(F.when(ascii_only, F.lower(value)), _nfkc_casefold(F.when(~ascii_only, value)))


def collapse(value: Column) -> Column:
    """White space of any kind trimmed and collapsed; null where nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(value, r"[\s\x1c-\x1f\u0085\p{Z}]+", " ")), F.lit(""))


def normalize_text(value: Column) -> Column:
    """Fold, spell out ampersands, keep letters, numbers and single spaces; null for null, blank and sign-only text."""
    spelt = F.regexp_replace(compatibility_fold(value), "&", " and ")
    return collapse(F.regexp_replace(spelt, r"[^\p{L}\p{N}\s\x1c-\x1f\u0085\p{Z}]", " "))


def normalize_company_name(value: Column) -> Column:
    """normalize_text without the legal forms at its end, however many; null when nothing else is there."""
    suffix = "|".join(LEGAL_SUFFIXES)
    return F.nullif(F.regexp_replace(normalize_text(value), rf"(?:(?:^| )(?:{suffix}))+$", ""), F.lit(""))


def normalize_person_name(value: Column) -> Column:
    """Fold and collapse white space."""
    return collapse(compatibility_fold(value))


def normalize_title(value: Column) -> Column:
    """Fold, spell out ampersands, drop full stops, turn other signs into spaces."""
    spelt = F.regexp_replace(F.regexp_replace(compatibility_fold(value), "&", " and "), r"\.", "")
    return collapse(F.regexp_replace(spelt, r"[_\p{Pd}]|[^\p{L}\p{N}_\s\x1c-\x1f\u0085\p{Z}]", " "))


def usable_work_email(value: Column) -> Column:
    """The trimmed, lower-cased address if it has the form of one and no private person's domain, else null."""
    mail = F.lower(F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+\z", ""))
    return F.when(mail.rlike(r"^[^@\s]+@[^@\s.]+(\.[^@\s.]+)+\z") & ~F.substring_index(mail, "@", -1).isin(*PERSONAL_MAIL), mail)


def formula_safe(value: Column) -> Column:
    """Text that a spreadsheet will not take for a formula: an apostrophe before a leading =, +, - or @; '' for null."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike(r"^[\s\p{Z}]*[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)


def clauses(value: Column) -> Column:
    """The non-blank clauses of a text, split at sentence signs, line breaks and coordinating words; null for null."""
    parts = F.split(value, r"(?i)(?:[.!?;:\n]+|\b(?:and|but|however|whereas|while|yet)\b)")
    return F.filter(F.transform(parts, collapse), lambda x: x.isNotNull())


def phrase_count(value: Column, phrase: str) -> Column:
    """How often a phrase stands in a text as whole words, in any case, its spaces of any length; null for null."""
    words = r"\s+".join(re.escape(w) for w in phrase.split())
    return F.regexp_count(value, F.lit(rf"(?iU)(?<!\w){words}(?!\w)"))
