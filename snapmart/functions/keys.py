"""Entity keys, identifier normalisation and row fingerprints (native expressions).

All of these run inside whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapmart.functions.util import as_col

# Fixed values that must equal the published pipeline's for keys to match:
# the entity key is the first 12 hex digits of SHA-1 over the normalised name;
# the lake key is the full 64-digit SHA-256; the row fingerprint joins the
# sorted column texts with "|" and prints missing values as "nan".
ENTITY_KEY_HEX_DIGITS = 12
RECORD_HASH_SEPARATOR = "|"
RECORD_HASH_NULL_TEXT = "nan"


def normalized_entity_name(name: Column | str) -> Column:
    """Lower-case name with every run of non letters/digits turned into one ``_``.

    Letters and digits are Unicode-aware (``\\p{L}``, ``\\p{N}``), leading and
    trailing separators are dropped, so ``"Taber, M.D."`` becomes ``taber_m_d``.
    """
    replaced = F.regexp_replace(as_col(name), r"[^\p{L}\p{N}]+", "_")
    return F.lower(F.trim(replaced, F.lit("_")))


def entity_key(name: Column | str) -> Column:
    """Stable 12-hex entity key: ``sha1(normalized_entity_name)[:12]`` (F1)."""
    return F.substring(F.sha1(normalized_entity_name(name)), 1, ENTITY_KEY_HEX_DIGITS)


def lake_key(name: Column | str) -> Column:
    """The lake path's key (F2): ASCII-only, edges kept, full SHA-256.

    Deliberately different from :func:`entity_key`; ``"Taber, M.D."`` maps to
    the hash of ``taber_m_d_``. Kept as its own function so the two never mix.
    """
    cleaned = F.regexp_replace(F.trim(as_col(name)), "[^A-Za-z0-9]+", "_")
    return F.sha2(F.lower(cleaned), 256)


def normalize_identifier(value: Column | str) -> Column:
    """Upper-case, keep only ``A-Z0-9``; empty result and null become null."""
    cleaned = F.regexp_replace(F.upper(F.trim(as_col(value))), "[^A-Z0-9]", "")
    return F.nullif(cleaned, F.lit(""))


def sha256_hex(value: Column | str) -> Column:
    """SHA-256 of the UTF-8 text, 64 lower-case hex digits."""
    return F.sha2(as_col(value).cast("string"), 256)


def record_hash(columns: Iterable[str], null_text: str = RECORD_HASH_NULL_TEXT) -> Column:
    """Row fingerprint over the *sorted* column names.

    Each value is taken as text (hash raw source strings, not re-rendered
    doubles) and a missing value prints as ``null_text`` so that nulls are not
    silently skipped the way ``concat_ws`` would skip them.
    """
    parts = [
        F.coalesce(F.col(name).cast("string"), F.lit(null_text)) for name in sorted(columns)
    ]
    return sha256_hex(F.concat_ws(RECORD_HASH_SEPARATOR, *parts))
