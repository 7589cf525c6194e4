"""Row cleanup, pincode validation and the mobile x e-mail contact explode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.functions.email import email_set
from addrflow.functions.phone import mobile_set
from addrflow.functions.text import clean_field, compact, normalize_country, remove_control
from addrflow.operators.counting import counts_by
from addrflow.operators.decrypt import decrypt_rows
from addrflow.operators.filters import is_cipher_row
from addrflow.operators.lookup import with_pincode_check
from addrflow.schema import CONTACT_FIELDS, ENCRYPTED_FIELDS

_FIELD_CLEANUP = ("address_line1", "address_line2", "city", "district", "state_code")


def clean_rows(df: DataFrame) -> DataFrame:
    """Per-column cleanup of a canonical shipment row (pincode is cleaned by the lookup step)."""
    updates = {"name": remove_control(F.col("name")), "country_code": normalize_country(F.col("country_code"))}
    updates.update({c: compact(F.col(c)) for c in ("mobile", "notification_mobile", "email", "notification_email")})
    updates.update({c: clean_field(F.col(c)) for c in _FIELD_CLEANUP})
    return df.withColumns(updates)


def explode_contacts(df: DataFrame, cfg: JobConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (mobile, e-mail) pair of a cleaned row, with the columns ``keep`` behind the contact's.

    only e-mails -> mobile ''; only mobiles -> e-mail ''; both -> every pair; none -> no row.
    Pairs never leave their input row (at most two e-mails per row), so this needs no shuffle.

    The "none" case is an empty array in the first explode, not a filter: Catalyst pushes a
    filter on the sets below their projection, which would build both sets (and decrypt their
    columns) twice per row; a generator keeps them computed once.
    """
    sets = df.withColumns(
        {
            "_ms": mobile_set(F.col("mobile"), F.col("notification_mobile"), cfg.recover_mobiles),
            "_es": email_set(F.col("email"), F.col("notification_email")),
        }
    )
    blank = F.array(F.lit(""))
    none = F.array().cast("array<string>")
    mobiles = F.when(F.size("_ms") > 0, F.col("_ms")).when(F.size("_es") > 0, blank).otherwise(none)
    emails = F.when(F.size("_es") > 0, F.col("_es")).otherwise(blank)
    pairs = sets.withColumn("contact_mobile", F.explode(mobiles)).withColumn("contact_email", F.explode(emails))
    return pairs.withColumns(
        {
            "enabled": F.lit(True),
            "record_created": F.lit(cfg.run_ts),
            "record_updated": F.lit(cfg.run_ts),
        }
    ).select(*CONTACT_FIELDS, *keep)


def contact_rows(
    df: DataFrame,
    pincodes: DataFrame,
    cfg: JobConfig,
    key_export: DataFrame | None = None,
    watch: tuple[Observation, Observation] | None = None,
    sources: int = 0,
) -> DataFrame:
    """Canonical shipment rows -> contact rows: pincode gate, (decryption), cleanup, explode.

    The pincode is never encrypted, so rows with an invalid pincode are dropped *before* the
    decryption: the same rows come out as decrypting first, with less AES work.

    ``watch`` is filled by whatever action runs the result: the first observation gets ``rows_read``
    and ``rows_encrypted``, the second ``rows_valid`` (after the pincode gate) and
    ``values_undecrypted`` (ciphertext values of those rows that came out unreadable).

    With ``sources`` the rows have a column ``source`` of at most so many values: it stays, and the
    observations also hold ``read_by``, ``encrypted_by``, ``valid_by`` and ``undecrypted_by`` (rows by source
    and number of unreadable values, see ``metrics.counts_by``), in the same pass.
    """
    source = F.col("source")
    rows = df
    if watch:
        enc = F.count_if(is_cipher_row(F.col("mobile")))
        by = [counts_by(source, sources).alias("read_by"), counts_by(F.when(is_cipher_row(F.col("mobile")), source), sources).alias("encrypted_by")]
        rows = rows.observe(watch[0], F.count(F.lit(1)).alias("rows_read"), enc.alias("rows_encrypted"), *(by if sources else []))
    if cfg.transform_partitions:
        rows = rows.repartition(cfg.transform_partitions)
    checked = with_pincode_check(rows, pincodes)
    kept = checked.filter(F.col("_pincode_ok")).drop("_pincode_ok")
    failures = F.lit(0)
    if key_export is not None:
        kept = decrypt_rows(kept, key_export, cfg, flag_failures=watch is not None)
        failures = F.col("_undecrypted") if watch else failures
    if watch:
        lost = F.coalesce(F.sum(failures), F.lit(0)).alias("values_undecrypted")
        unread = F.when(failures > 0, F.concat_ws("\t", failures.cast("string"), source))
        by = [counts_by(source, sources).alias("valid_by"), counts_by(unread, len(ENCRYPTED_FIELDS) * sources).alias("undecrypted_by")] if sources else []
        kept = kept.observe(watch[1], F.count(F.lit(1)).alias("rows_valid"), lost, *by).drop("_undecrypted")
    return explode_contacts(clean_rows(kept), cfg, ("source",) if sources else ())
