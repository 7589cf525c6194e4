"""Counts: id bounds, per-stage row counts, and same-pass observation of a running job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.functions.cipher import key_alias
from addrflow.functions.email import email_set
from addrflow.functions.phone import mobile_set
from addrflow.operators.contacts import clean_rows
from addrflow.operators.counting import counts_by
from addrflow.operators.decrypt import decrypt_rows
from addrflow.operators.filters import is_cipher_row
from addrflow.operators.lookup import with_pincode_check


def id_bounds(df: DataFrame, column: str = "id") -> DataFrame:
    """One row: min and max of ``column`` (sizes a partitioned read)."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))


def _long(agg: DataFrame) -> DataFrame:
    cols = agg.columns
    return agg.select(*[F.col(c).cast("long").alias(c) for c in cols]).unpivot([], cols, "stage", "rows")


def stage_counts(rows: DataFrame, key_export: DataFrame, pincodes: DataFrame, cfg: JobConfig) -> DataFrame:
    """(stage, rows) of a whole run from ONE pass over the rows (no explode, no re-reads).

    Contact counts follow from the per-row set sizes: a row with m mobiles and e e-mails
    (m + e > 0) yields max(m,1)*max(e,1) rows, m*max(e,1) of them with a mobile and
    e*max(m,1) with an e-mail.
    """
    enc = is_cipher_row(F.col("mobile"))
    tagged = rows.withColumns(
        {"_enc": enc, "_pair": F.when(enc, F.struct(F.col("tenant_code"), key_alias(F.col("mobile"))))}
    )
    # As in the job, only rows behind the pincode gate are decrypted: without a mobile that is
    # ciphertext nothing is attempted on the others.
    gated = with_pincode_check(tagged, pincodes)
    shown = F.when(F.col("_pincode_ok"), F.col("mobile")).otherwise(F.lit(""))
    checked = clean_rows(decrypt_rows(gated.withColumn("mobile", shown), key_export, cfg, flag_failures=True))
    m = F.size(mobile_set(F.col("mobile"), F.col("notification_mobile"), cfg.recover_mobiles))
    e = F.size(email_set(F.col("email"), F.col("notification_email")))
    sized = checked.select("_enc", "_pair", "_undecrypted", "_pincode_ok", m.alias("_m"), e.alias("_e"))
    live = F.col("_pincode_ok") & ((F.col("_m") + F.col("_e")) > 0)
    m1, e1 = F.greatest(F.col("_m"), F.lit(1)), F.greatest(F.col("_e"), F.lit(1))
    agg = sized.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("_enc")).alias("rows_encrypted"),
        F.count_if(~F.col("_enc")).alias("rows_plain"),
        F.count_distinct(F.col("_pair")).alias("key_pairs"),
        F.count(F.lit(1)).alias("rows_union"),
        F.coalesce(F.sum("_undecrypted"), F.lit(0)).alias("values_undecrypted"),
        F.coalesce(F.sum(F.when(live, m1 * e1)), F.lit(0)).alias("contact_rows"),
        F.coalesce(F.sum(F.when(live, F.col("_m") * e1)), F.lit(0)).alias("with_mobile"),
        F.coalesce(F.sum(F.when(live, F.col("_e") * m1)), F.lit(0)).alias("with_email"),
    )
    return _long(agg)


def observed(df: DataFrame, name: str, sources: int = 0) -> tuple[DataFrame, Observation]:
    """Attach row counters that are filled by whatever action runs ``df`` (no extra job).

    With ``sources``, the rows have a column ``source`` of at most so many values, and are counted by it too.
    """
    obs = Observation(name)
    mobile, email = F.col("contact_mobile") != "", F.col("contact_email") != ""
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(mobile).alias("with_mobile"), F.count_if(email).alias("with_email")]
    if sources:
        s = F.col("source")
        metrics += [
            counts_by(s, sources).alias("rows_by"),
            counts_by(F.when(mobile, s), sources).alias("with_mobile_by"),
            counts_by(F.when(email, s), sources).alias("with_email_by"),
        ]
    return df.observe(obs, *metrics), obs
