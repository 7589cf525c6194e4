"""URL filter: path rules first, then a ratio of two character language models.

Rules decide every URL they fit. The URLs that a rule allows train one character model, those that
a rule blocks another; both are variable-order Markov models of up to ``order`` characters of
context with Witten-Bell smoothing, so an unseen context falls back to the longest seen one. The
score of a URL is the mean over its characters (and an end mark) of the log-likelihood difference.
The threshold is calibrated by cross-fitting: each half of the ruled URLs is scored by the models
of the other half, and the bin of the score that separates the two kinds best (balanced error over
all ruled URLs) becomes the threshold. URLs without a rule are judged by the models of both halves.

Counts cover every distinct URL and never leave the cluster; the driver gets the calibration
histogram of at most ``BINS`` rows. All is DataFrame code: grams come from ``explode``, models from
aggregations and equi-joins whose partitions Spark may split.

Nulls and odd input: a null URL is an empty one; host and path are empty without ``://``. Repeated
rows each get the verdict of their URL. Without URLs of both kinds the threshold is 0 and scores
are 0, which allows. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrflow.llm._io import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"
#: Chance of a character that no context has seen: one in so many.
ALPHABET = 256.0
BINS, SPAN = 4096, 8.0

#: (verdict, rule) of the query; a rule is a host and a path prefix.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, r in sorted(rules, key=lambda x: len(x[1])):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """One row per character of each URL: the character behind ``order`` characters of context."""
    text = F.concat(F.lit(START * order), F.col("url"), F.lit(END))
    at = F.sequence(F.lit(1), F.length("url") + 1)
    return urls.withColumn("text", text).withColumn("at", F.explode(at)).withColumn("gram", F.substring("text", F.col("at"), order + 1))


def _models(grams: DataFrame, order: int) -> DataFrame:
    """gram, and for each variant of the models the log-likelihood difference of its last character.

    Variants: 0 and 1 use the other half of the ruled URLs, 2 uses both halves.
    """
    kinds = ("allow", "block")
    counted = {
        f"{kind}{half}": F.sum(F.when((F.col("verdict") == kind) & (F.col("half") == 1 - half), 1).otherwise(0))
        for kind in kinds
        for half in (0, 1)
    }
    names = [f"{kind}{v}" for kind in kinds for v in (0, 1, 2)]
    full = stage(
        grams.groupBy("gram").agg(*[c.alias(n) for n, c in counted.items()])
        .withColumns({f"{kind}2": F.col(f"{kind}0") + F.col(f"{kind}1") for kind in kinds}),
        "grams",
    )
    lower = None
    for k in range(order + 1):
        level = full.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("g")).agg(*[F.sum(n).alias(n) for n in names])
        level = level.withColumn("ctx", F.substring("g", 1, k))
        seen = level.groupBy("ctx").agg(
            *[F.sum(n).alias(f"n_{n}") for n in names],
            *[F.sum((F.col(n) > 0).cast("long")).alias(f"t_{n}") for n in names],
        )
        joined = level.join(seen, "ctx")
        if lower is not None:
            joined = joined.withColumn("below", F.substring("g", 2, k)).join(lower, "below")
        chance = []
        for n in names:
            base = F.col(f"p_{n}") if lower is not None else F.lit(1 / ALPHABET)
            all_, kinds_seen = F.col(f"n_{n}"), F.col(f"t_{n}")
            chance.append(F.when(all_ > 0, (F.col(n) + kinds_seen * base) / (all_ + kinds_seen)).otherwise(base).alias(f"q_{n}"))
        lower = stage(joined.select("g", *chance), f"order{k}").select(
            F.col("g").alias("below"), *[F.col(f"q_{n}").alias(f"p_{n}") for n in names]
        )
    return lower.select(
        F.col("below").alias("gram"),
        *[(F.log(F.col(f"p_allow{v}")) - F.log(F.col(f"p_block{v}"))).alias(f"d{v}") for v in (0, 1, 2)],
    )


def _threshold(scored: DataFrame) -> float | None:
    """The bin edge of least balanced error between ruled URLs of both kinds; None without one of them."""
    step = SPAN / BINS
    at = F.least(F.greatest(F.floor((F.col("own") + SPAN / 2) / step), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = (
        scored.filter("verdict is not null")
        .groupBy(at.alias("bin"))
        .agg(F.sum((F.col("verdict") == "allow").cast("long")).alias("a"), F.sum((F.col("verdict") == "block").cast("long")).alias("b"))
        .orderBy("bin")
        .collect()  # at most BINS rows
    )
    allowed, blocked = sum(r["a"] for r in rows), sum(r["b"] for r in rows)
    if not allowed or not blocked:
        return None
    best, found, a, b = 2.0, 0.0, 0, 0
    for r in rows:  # threshold below this bin: a allowed URLs lie under it, blocked - b above
        error = a / allowed + (blocked - b) / blocked
        if error < best - 1e-12:
            best, found = error, r["bin"] * step - SPAN / 2
        a, b = a + r["a"], b + r["b"]
    return found


def judge(pages: DataFrame, rules=RULES, order: int = 4, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    urls = stage(
        pages.select(url.alias("url")).distinct().withColumns(
            {"verdict": verdict_of(rules), "half": F.pmod(F.xxhash64("url"), F.lit(2)).cast("int"), "uid": F.monotonically_increasing_id()}
        ),
        "urls",
    )
    grams = _grams(urls, order)
    models = _models(grams, order)
    own = F.when(F.col("verdict").isNull(), F.col("d2")).when(F.col("half") == 0, F.col("d0")).otherwise(F.col("d1"))
    scored = stage(
        grams.select("uid", "gram", "verdict", "half")
        .join(models, "gram")
        .groupBy("uid")
        .agg(F.round(F.avg(own), 9).alias("own"))
        .join(urls, "uid")
        .select("url", "verdict", "own"),
        "scores",
    )
    limit = _threshold(scored)
    if limit is None:  # nothing to compare with
        limit, scored = 0.0, scored.withColumn("own", F.lit(0.0))
    judged = scored.select(
        F.col("url").alias("u"),
        F.coalesce("verdict", F.when(F.col("own") >= limit, "allow").otherwise("block")).alias("verdict"),
        F.round("own", 6).alias("score"),
    )
    rows = pages.select(F.col(id_col), url.alias("u")).join(judged, "u")
    host, path = host_and_path(F.col("u"))
    rule, _ = match_rule(host, path, rules)
    return rows.select(id_col, host.alias("host"), path.alias("path"), rule.alias("rule"), "verdict", "score")


def verdict_of(rules) -> Column:
    return match_rule(*host_and_path(F.col("url")), rules)[1]
