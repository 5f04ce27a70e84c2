"""Cleaning of string columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _string_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return strings if columns is None else [c for c in columns if c in strings]


def strip_nul(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Delete every NUL character from the string columns; other types are left alone."""
    return df.withColumns({c: F.translate(F.col(c), "\x00", "") for c in _string_columns(df, columns)})


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn empty strings into nulls."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in _string_columns(df, columns)})


def fixed_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep a fixed list of columns: a missing one becomes null, an extra one is dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def decrypt_columns(
    df: DataFrame, targets: Mapping[str, str], key: Column | bytes, strict: bool = True
) -> DataFrame:
    """Add decrypted copies of encrypted columns (AES-GCM).

    ``targets`` maps encrypted column to new column. String columns hold base64 text, binary columns the raw
    cipher. A value that cannot be decrypted fails the job, or gives null with ``strict=False``. Give ``key``
    as a column of the data where a constant must not show in plans.
    """
    secret = key if isinstance(key, Column) else F.lit(bytearray(key))
    decrypt = F.aes_decrypt if strict else F.try_aes_decrypt

    def plain(name: str) -> Column:
        cipher = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            cipher = F.unbase64(cipher) if strict else F.try_to_binary(cipher, F.lit("base64"))
        return decrypt(cipher, secret).cast("string")

    return df.withColumns({new: plain(name) for name, new in targets.items()})
