"""Vault hash keys as JVM-side Column expressions (no Python UDF on the hot path).

Two hashing conventions exist and both are kept:

* ``hash_key`` / ``composite_key`` – the implemented convention: MD5 in upper-case
  hex of the stripped value; composite parts joined by ``;``; a null **or empty**
  part makes the composite key null (emptiness is tested before stripping).
* ``hash_key_std`` – the documented standard: lower-case MD5 over the columns in
  alphabetical order, each ``UPPER(TRIM(COALESCE(CAST(c AS STRING), '^^NULL^^')))``,
  joined by U+001F.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# The characters Python's str.strip() removes (str.isspace() is True):
# U+0009..U+000D, U+001C..U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000..U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")

# Fixed values of the documented standard.
STD_DELIMITER = "\u001f"
STD_NULL_TOKEN = "^^NULL^^"
COMPOSITE_DELIMITER = ";"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()`` semantics (plain ``trim`` only removes spaces).

    ``btrim`` with an explicit character set is a codegen'd scan of both ends.
    """
    return F.btrim(_col(c).cast("string"), F.lit(PY_WHITESPACE))


def hash_key(c) -> Column:
    """Upper-hex MD5 of the stripped value; null stays null; '' hashes the empty string."""
    return F.upper(F.md5(py_strip(c)))


def composite_key(*parts) -> Column:
    """Upper-hex MD5 of stripped parts joined by ';'; null or '' in any part → null."""
    cols = [_col(p).cast("string") for p in parts]
    missing = None
    for c in cols:
        cond = c.isNull() | (c == F.lit(""))
        missing = cond if missing is None else (missing | cond)
    token = F.concat_ws(COMPOSITE_DELIMITER, *[py_strip(c) for c in cols])
    return F.when(missing, F.lit(None).cast("string")).otherwise(F.upper(F.md5(token)))


def _std_part(c: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(STD_NULL_TOKEN))))


def hash_key_std(columns: Iterable[str]) -> Column:
    """Documented standard hash (lower hex, U+001F, ^^NULL^^, TRIM, UPPER, sorted names)."""
    names = sorted(columns)
    if not names:
        raise ValueError("hash_key_std needs at least one column")
    return F.md5(F.concat_ws(STD_DELIMITER, *[_std_part(c) for c in names]))


def hash_diff(columns: Iterable[str]) -> Column:
    """Hash diff over all descriptive attributes; same rules as ``hash_key_std``."""
    return hash_key_std(columns)


#: Stands before a text that is no hash, so that it is longer than a packed hash.
_NO_HASH = bytes(17)


def packed_hash(c) -> Column:
    """An upper-case MD5 text as its 16 bytes, any other text as longer bytes: half the size wherever it is shuffled."""
    c = _col(c)
    return F.when((F.length(c) == 32) & (F.hex(F.unhex(c)) == c), F.unhex(c)).otherwise(
        F.concat(F.lit(_NO_HASH), c.cast("binary")))


def unpacked_hash(c) -> Column:
    """The text that ``packed_hash`` was given."""
    c = _col(c)
    return F.when(F.octet_length(c) == 16, F.hex(c)).otherwise(
        F.substring(c, len(_NO_HASH) + 1, 2 ** 31 - 1).cast("string"))


def with_packed_hashes(df: DataFrame) -> DataFrame:
    """``df`` with its ``hk_`` texts packed; equal texts stay equal, null stays null."""
    keys = [f.name for f in df.schema if f.name.startswith("hk_") and isinstance(f.dataType, StringType)]
    return df.withColumns({k: packed_hash(k) for k in keys})


def with_hashes(df: DataFrame) -> DataFrame:
    """``df`` with its packed ``hk_`` columns as texts again."""
    keys = [f.name for f in df.schema if f.name.startswith("hk_") and isinstance(f.dataType, BinaryType)]
    return df.withColumns({k: unpacked_hash(k) for k in keys})
