"""Encryption of sensitive columns with Spark's built-in AES functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def encrypt_columns(df: DataFrame, names: Sequence[str], key: Column) -> DataFrame:
    """Replace each column by the base64 text of its AES-GCM encryption; null stays null.

    ``key`` is a binary column of 16, 24 or 32 bytes. Every run draws new initial values, so
    equal inputs give different texts.
    """
    return df.withColumns(
        {name: F.base64(F.aes_encrypt(F.col(name).cast("string"), key, F.lit("GCM"))) for name in names}
    )


def decrypt_columns(df: DataFrame, types: dict[str, str], key: Column) -> DataFrame:
    """Undo ``encrypt_columns``; ``types`` gives each column's type."""
    return df.withColumns(
        {
            name: F.aes_decrypt(F.unbase64(name), key, F.lit("GCM")).cast("string").cast(type_name)
            for name, type_name in types.items()
        }
    )
