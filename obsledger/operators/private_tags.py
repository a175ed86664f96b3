"""Vendor-private tags: policy, later redaction, reading, summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsledger.functions import values as V
from obsledger.functions.rules import text_of_bytes
from obsledger.functions.text import strip


@dataclass(frozen=True)
class PrivateTagPolicy:
    """Which creators to redact, interpret or preserve, in this precedence, and the default."""

    redact: Sequence[str] = field(default_factory=tuple)
    interpret: Sequence[str] = field(default_factory=tuple)
    preserve: Sequence[str] = field(default_factory=tuple)
    default: str = "preserve"
    max_raw_value: int | None = None


def apply_policy(tags: DataFrame, policy: PrivateTagPolicy) -> DataFrame:
    """Tags as they are stored under the policy.

    `tags`: observation_id, creator, tag, vr, raw_value (binary). Text of interpretable
    kinds is read. Preserved values are kept whole; only under a policy with
    `max_raw_value` are longer ones cut to it and marked.
    """
    creator = F.coalesce("creator", F.lit(""))
    action = (
        F.when(creator.isin(list(policy.redact)), "redact")
        .when(creator.isin(list(policy.interpret)), "interpret")
        .when(creator.isin(list(policy.preserve)), "preserve")
        .otherwise(policy.default)
    )
    raw = F.col("raw_value")
    text = F.when(F.col("vr").isin(V.TEXT_VRS), strip(text_of_bytes(raw)))
    read = (F.col("_action") == "interpret") & (F.coalesce(text, F.lit("")) != "")
    kept = raw
    if policy.max_raw_value is not None:
        cut = F.concat(F.substring(raw, 1, policy.max_raw_value), F.lit(bytearray(V.TRUNCATED.encode())))
        kept = F.when((F.col("_action") == "preserve") & (F.octet_length(raw) > policy.max_raw_value), cut).otherwise(raw)
    return tags.withColumn("_action", action).select(
        "observation_id", creator.alias("creator"), "tag", "vr",
        F.when(F.col("_action") != "redact", kept).alias("raw_value"),
        F.when(read, text).alias("interpreted_value"),
        F.when(F.col("_action") == "redact", "redacted").when(read, "interpreted").otherwise("preserved")
        .alias("redaction_status"),
        F.when(F.col("_action") == "redact", F.concat(F.lit("policy: "), creator, F.lit(" in redact list")))
        .alias("redaction_reason"),
    )


def redact(tags: DataFrame, requests: DataFrame) -> DataFrame:
    """Null the values of the requested observations, of one creator or, with a null creator, of all.

    Requests are brought to one row per observation and per observation and creator, so
    no tag is matched twice.
    """
    whole = requests.where(F.col("creator").isNull()).groupBy("observation_id").agg(F.min("reason").alias("_whole"))
    single = (
        requests.where(F.col("creator").isNotNull())
        .groupBy("observation_id", "creator")
        .agg(F.min("reason").alias("_single"))
    )
    reason = F.coalesce("_whole", "_single")
    hit = reason.isNotNull()
    return (
        tags.join(whole, "observation_id", "left")
        .join(single, ["observation_id", "creator"], "left")
        .select(
            "observation_id", "creator", "tag", "vr",
            F.when(~hit, F.col("raw_value")).alias("raw_value"),
            F.when(~hit, F.col("interpreted_value")).alias("interpreted_value"),
            F.when(hit, "redacted").otherwise(F.col("redaction_status")).alias("redaction_status"),
            F.when(hit, reason).otherwise(F.col("redaction_reason")).alias("redaction_reason"),
        )
    )


def readable(tags: DataFrame, include_redacted: bool = False) -> DataFrame:
    """Tags that may be shown."""
    return tags if include_redacted else tags.where(F.col("redaction_status") != "redacted")


def summary(tags: DataFrame) -> DataFrame:
    """Tags per observation and creator, all and by status."""
    return tags.groupBy("observation_id", "creator").agg(
        F.count(F.lit(1)).alias("total_tags"),
        F.count_if(F.col("redaction_status") == "redacted").alias("redacted_count"),
        F.count_if(F.col("redaction_status") == "interpreted").alias("interpreted_count"),
    )
