"""Names as columns: cleaning, predicates and derived identifiers. A null is treated as an absent name: predicates are false for it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of well-formed and of noisy names.
SAFE_PART = r"^[A-Za-z0-9._\-]+\z"
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*\z"
NOISE = [r"\.\.", r"\\mathcal", r"\\ldots", r"\^\s*\{", r"\$\d+", r"\s+\\cup\s+", r"\s+\\in\s+", r"\s*\\Z\s*", r"\s*\\R\s*"]
NOISY_HEADER = r"\$|\\|\^\s*\{"
NOISY_ATTRIBUTE = "[：—（「」]"
NOISY_TARGET = "[：—（]"
PLACEHOLDER = "ocr_noise_attr"
LONGEST = 64


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def clean_inline(c: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def blank(c: Column) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def _match(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def is_safe_iri_part(c: Column) -> Column:
    return _match(strip(c), SAFE_PART)


def is_identifier(c: Column) -> Column:
    return _match(strip(c), IDENTIFIER)


def has_ocr_noise(c: Column) -> Column:
    return _match(c, "|".join(NOISE))


def is_separator(c: Column) -> Column:
    """A rule of dashes; white space alone counts too, an empty name doesn't."""
    s = strip(c)
    return F.coalesce((c != "") & ((s == "") | s.rlike(r"^[-:|]*-[-:|]*\z")), F.lit(False))


def is_noisy_header(c: Column) -> Column:
    return _match(c, NOISY_HEADER)


def has_ascii(c: Column) -> Column:
    return _match(c, r"[\x00-\x7f]")


def is_noisy_target(c: Column) -> Column:
    """A target that can't be a class: blank, a rule, nothing in ASCII, a multiplicity, digits only, or a piece of description."""
    s = strip(c)
    return blank(c) | is_separator(s) | ~has_ascii(s) | _match(s, r"^\d+\.\.|(?U)^\d+\z") | _match(s, NOISY_TARGET)


def attribute_noise(c: Column) -> Column:
    """Kind of noise of an attribute's name, null if there is none; a blank name has none."""
    s = strip(c)
    kinds = F.when(is_separator(s), "separator").when(_match(s, r"[$\\]"), "latex").when(~has_ascii(s), "cjk").when(_match(s, NOISY_ATTRIBUTE), "mixed_punct")
    return F.when(~blank(c), kinds)


def attribute_slug(c: Column) -> Column:
    """A name fit for keys; blank and noisy names become a placeholder."""
    s = strip(c)
    return F.when(blank(c) | has_ocr_noise(s), F.lit(PLACEHOLDER)).otherwise(F.left(F.regexp_replace(s, r"[^A-Za-z0-9._]", "_"), F.lit(LONGEST)))


def property_iri(cls: Column, name: Column, prefix: str = "cim:") -> Column:
    """Prefix, class and name; null if the name is blank, noisy or no identifier."""
    s = strip(name)
    return F.when(~blank(name) & ~has_ocr_noise(s) & is_identifier(s), F.concat(F.lit(prefix), cls, F.lit("."), F.left(s, F.lit(LONGEST))))


def slug(c: Column) -> Column:
    """Lower case, runs of other characters than letters and digits as one dash, none at the ends."""
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"(?U)[^\p{Alnum}]+", "-")), r"^-+|-+\z", "")


def safe_local(c: Column) -> Column:
    """Letters, digits, ``-`` and ``_``; everything else as ``_``; ``_`` for an empty name."""
    s = F.regexp_replace(c, r"(?U)[^\p{Alnum}\-_]", "_")
    return F.when(s == "", F.lit("_")).otherwise(s)


def local_name(iri: Column) -> Column:
    """What follows the last ``#``, and of that what follows the last ``/``."""
    return F.substring_index(F.substring_index(iri, "#", -1), "/", -1)


def attribute_id(package_id: Column, name: Column) -> Column:
    """Not qualified by the class, so that names may collide within a package."""
    return F.concat_ws(".", package_id, name)


def camel_case(c: Column) -> Column:
    return _match(strip(c), r"^[A-Z][A-Za-z0-9]+\z")


def prefixes(c: Column) -> Column:
    """Namespace prefixes used in a text, in order."""
    return F.regexp_extract_all(c, F.lit(r"\b([a-z]+):[A-Z]\w+"), F.lit(1))
