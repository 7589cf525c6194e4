"""Ciphertext handling: ``cipher:<alias>:<base64 payload>`` values and AES-256/ECB/PKCS5 decryption.

Keys are supplied by the caller as a DataFrame; nothing here reads or logs a key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrflow.config import KeyPathFormat

# Fixed values of the ciphertext format:
CIPHER_PREFIX = "cipher:"
TENANT_KEY_ALIAS = "1"  # keyed per tenant (legacy triple-DES values)
RETIRED_ALIAS = "2"  # values under this alias are passed through unchanged
AES_KEY_BYTES = 32


def is_encrypted(c: Column) -> Column:
    """Non-empty and starting with ``cipher:``; NULL -> false."""
    return F.coalesce(c.startswith(CIPHER_PREFIX), F.lit(False))


def key_alias(c: Column) -> Column:
    """Second ':' part of a ciphertext ('' for 'cipher:'); NULL when there is none."""
    return F.get(F.split(c, ":"), 1)


def _parts(c: Column) -> Column:
    return F.split(c, ":", 3)


def payload(c: Column) -> Column:
    """Third part of a 3-limit split on ':' (may itself contain ':'); NULL when absent."""
    return F.get(_parts(c), 2)


def is_pii_encrypted(c: Column) -> Column:
    """Encrypted under a per-alias key (alias neither 1 nor 2)."""
    alias = F.get(_parts(c), 1)
    return is_encrypted(c) & F.coalesce(~alias.isin(TENANT_KEY_ALIAS, RETIRED_ALIAS), F.lit(False))


def key_path(alias: Column, tenant: Column, fmt: KeyPathFormat) -> Column:
    """Name of the key export entry for a (alias, tenant) pair; NULL for the retired alias."""
    return (
        F.when(alias == F.lit(RETIRED_ALIAS), F.lit(None).cast("string"))
        .when(alias == F.lit(TENANT_KEY_ALIAS), F.concat(F.lit(fmt.prefix), tenant, F.lit(f"{fmt.tenant_suffix}/{TENANT_KEY_ALIAS}")))
        .otherwise(F.concat(F.lit(fmt.prefix), alias, F.lit(f"/{fmt.version}")))
    )


def first_key_or_null(keys_json: Column) -> Column:
    """First value of a JSON object ``{"<version>": "<key>", ...}``; NULL when it holds none."""
    return F.get(F.map_values(F.from_json(keys_json, "map<string,string>")), 0)


def first_key(keys_json: Column) -> Column:
    """First value of a JSON object ``{"<version>": "<key>", ...}``; an empty object is an error."""
    values = F.map_values(F.from_json(keys_json, "map<string,string>"))
    return F.when(F.size(values) == 0, F.raise_error(F.lit("key export entry holds no key"))).otherwise(
        F.get(values, 0)
    )


def used_key(found: Column) -> Column:
    """The key of an export entry that a row uses: an error when it holds none or several.

    ``found`` is the entry's struct (keys_lo, keys_hi, whole), NULL when there is none.
    """
    return (
        F.when(found.isNull(), F.lit(None).cast("string"))
        .when(found["keys_lo"] != found["keys_hi"], F.raise_error(F.lit("key export holds different keys for one path")))
        .when(~found["whole"], F.raise_error(F.lit("key export entry holds no key")))
        .otherwise(found["keys_lo"])
    )


def aes_key_bytes(key: Column) -> Column:
    """UTF-8 bytes of the key, zero-padded or cut to 32 bytes."""
    return F.rpad(F.encode(key, "UTF-8"), AES_KEY_BYTES, F.lit(bytes(1)))


def lenient_base64(p: Column) -> Column:
    """Bytes of a base64 text decoded leniently, as the source job's decoder does.

    URL-safe letters count as '+' and '/', decoding stops at the first '=', any other character
    outside the alphabet (line breaks, spaces, junk) is skipped, and a dangling last character
    (6 bits, not a byte) is dropped. Text that strict decoding accepts (nearly all) decodes to the
    same bytes either way, so the string clean-up runs only for the rest.
    """
    body = F.regexp_replace(F.substring_index(F.translate(p, "-_", "+/"), "=", 1), r"[^A-Za-z0-9+/]", "")
    n = F.length(body)
    body = F.when(n % 4 == 1, F.substring(body, 1, n - 1)).otherwise(body)
    return F.coalesce(F.try_to_binary(p, F.lit("base64")), F.try_to_binary(body, F.lit("base64")))


def aes_decrypt_or_keep(p: Column, key: Column) -> Column:
    """AES/ECB/PKCS5 decrypt of a base64 payload; any failure gives the payload back."""
    data = lenient_base64(p)
    clear = F.try_aes_decrypt(data, aes_key_bytes(key), F.lit("ECB"), F.lit("PKCS"))
    return F.coalesce(F.make_valid_utf8(clear.cast("string")), p)


def decrypt_value(c: Column, key: Column) -> Column:
    """Decrypt one value with the row's key.

    not ciphertext -> unchanged; alias 2 -> unchanged (prefix kept); no payload part -> unchanged
    (kept rather than failing the job); alias 1 -> payload (legacy cipher not supported);
    NULL key -> payload; otherwise AES, or the payload when that fails.
    """
    alias = F.get(_parts(c), 1)
    p = payload(c)
    return (
        F.when(~is_encrypted(c), c)
        .when(alias == F.lit(RETIRED_ALIAS), c)
        .when(p.isNull(), c)
        .when(alias == F.lit(TENANT_KEY_ALIAS), p)
        .when(key.isNull(), p)
        .otherwise(aes_decrypt_or_keep(p, key))
    )


def undecryptable(c: Column, decrypted: Column) -> Column:
    """True when ciphertext ``c`` came out of ``decrypt_value`` as ``decrypted`` still unreadable.

    Unreadable = bare payload (legacy alias, no key, failed AES) or unchanged (no payload part);
    values under the retired alias are unchanged by design and not counted.
    """
    alias = F.get(_parts(c), 1)
    p = payload(c)
    return is_encrypted(c) & F.coalesce(
        (alias != F.lit(RETIRED_ALIAS)) & (p.isNull() | (decrypted == p)),
        F.lit(False),
    )


def encrypt_value(clear: Column, alias: Column, key: Column) -> Column:
    """``cipher:<alias>:<base64(AES/ECB/PKCS5(clear))>`` (for tests and fixtures)."""
    enc = F.aes_encrypt(F.encode(clear, "UTF-8"), aes_key_bytes(key), F.lit("ECB"), F.lit("PKCS"))
    return F.concat(F.lit(CIPHER_PREFIX), alias, F.lit(":"), F.base64(enc))
