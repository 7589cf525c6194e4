"""Decryption of the personal columns with keys from a caller-supplied key export.

One pass: every row gets the key named by its mobile's alias through a left join against the
key export (``key_path``, ``keys_json``), and each of the seven columns is decrypted with that key
under its own alias. Plain rows pass through untouched, so plain and decrypted rows come out of
the same scan without a split and a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.config import JobConfig, KeyPathFormat
from addrflow.functions.cipher import decrypt_value, first_key_or_null, key_alias, key_path, undecryptable, used_key
from addrflow.operators.filters import is_cipher_row
from addrflow.operators.lookup import unique_by
from addrflow.schema import ENCRYPTED_FIELDS


def export_keys(key_export: DataFrame) -> DataFrame:
    """(key_path, found): one row per path with the first keys of its entries.

    Nothing is judged here: an entry without a key, or entries that contradict one another, are an
    error only when a row uses them (``used_key``).
    """
    key = first_key_or_null(F.col("keys_json"))
    holds = F.coalesce(F.size(F.map_values(F.from_json("keys_json", "map<string,string>"))) != 0, F.lit(True))
    keyed = key_export.select("key_path", key.alias("_first"), holds.alias("_holds"))
    return unique_by(
        keyed,
        "key_path",
        F.struct(F.min("_first").alias("keys_lo"), F.max("_first").alias("keys_hi"), F.bool_and("_holds").alias("whole")).alias("found"),
    )


def distinct_key_pairs(df: DataFrame) -> DataFrame:
    """Distinct (tenant_code, key_alias) of the encrypted rows (partial aggregation map-side)."""
    return (
        df.filter(is_cipher_row(F.col("mobile")))
        .select("tenant_code", key_alias(F.col("mobile")).alias("key_alias"))
        .distinct()
    )


def key_table(pairs: DataFrame, key_export: DataFrame, fmt: KeyPathFormat) -> DataFrame:
    """(tenant_code, key_alias, vault_key) for each pair; a key missing from the export is NULL."""
    keyed = pairs.withColumn("key_path", key_path(F.col("key_alias"), F.col("tenant_code"), fmt))
    joined = keyed.join(export_keys(key_export), "key_path", "left")
    return joined.select("tenant_code", "key_alias", used_key(F.col("found")).alias("vault_key"))


def attach_keys(df: DataFrame, key_export: DataFrame, cfg: JobConfig) -> DataFrame:
    """Add ``_key`` (NULL for plain rows, for alias 2 and for keys missing from the export)."""
    path = F.when(
        is_cipher_row(F.col("mobile")), key_path(key_alias(F.col("mobile")), F.col("tenant_code"), cfg.key_path)
    )
    keys = export_keys(key_export).select(F.col("key_path").alias("_kp"), F.col("found").alias("_found"))
    joined = df.withColumn("_path", path).join(keys, F.col("_path") == F.col("_kp"), "left")
    return joined.withColumn("_key", used_key(F.col("_found"))).drop("_path", "_kp", "_found")


def decrypt_rows(df: DataFrame, key_export: DataFrame, cfg: JobConfig, flag_failures: bool = False) -> DataFrame:
    """Decrypt the seven personal columns of encrypted rows (same columns out, same order).

    With ``flag_failures`` an int column ``_undecrypted`` counts the ciphertext values that came out
    unreadable (bare payload or unchanged), read off the result rather than decrypting twice.
    """
    keyed = attach_keys(df, key_export, cfg)
    enc = is_cipher_row(F.col("mobile"))
    key = F.col("_key")
    out = keyed.withColumns(
        {f"_d_{c}": F.when(enc, decrypt_value(F.col(c), key)).otherwise(F.col(c)) for c in ENCRYPTED_FIELDS}
    )
    cols = [F.col(f"_d_{c}").alias(c) if c in ENCRYPTED_FIELDS else F.col(c) for c in df.columns]
    if flag_failures:
        fails = [
            F.when(enc & undecryptable(F.col(c), F.col(f"_d_{c}")), 1).otherwise(0) for c in ENCRYPTED_FIELDS
        ]
        total = fails[0]
        for f in fails[1:]:
            total = total + f
        cols.append(total.alias("_undecrypted"))
    return out.select(*cols)
