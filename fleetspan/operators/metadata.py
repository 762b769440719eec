"""Metric definitions inferred from descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.extract import description_text

# Unit words in the order they are tried.
UNIT_WORDS = [
    (r"(?i)\bk(ilo)?bytes", "kilobytes"),
    (r"\bKB", "kilobytes"),
    (r"(?i)\bm(ega)?bytes", "megabytes"),
    (r"\bMB", "megabytes"),
    (r"(?i)\bmilliseconds", "milliseconds"),
    (r"(?i)\bminutes", "minutes"),
    (r"(?i)\bseconds", "seconds"),
    (r"(?i)\bbytes", "bytes"),
    (r"(?i)\bpercent", "percentage"),
]
TRAIT_WORDS = r"(?i)\b(port|version|id\b|identi|indicat|status|state)"
GAUGE_WORDS = r"(?i)\b(number|count)"
COUNTER_WORDS = r"(?i)\btotal"
LAST_WORDS = r"(?i)\b(last|recent|previous|prior)"
NUMERIC_SYNTAX = ("Integer32", "UnsignedInteger32", "Counter", "Counter32", "Gauge", "Gauge32", "TimeTicks")


def units(description: Column) -> Column:
    """Unit named in a description; null when none is."""
    out = None
    for pattern, unit in UNIT_WORDS:
        hit = description.rlike(pattern)
        out = F.when(hit, unit) if out is None else out.when(hit, unit)
    return out


def reads_as_trait(description: Column) -> Column:
    return description.rlike(TRAIT_WORDS)


def clean_description(description: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(description, r"[\n\r\t]", " "), " +", " ")


def infer_definition(df: DataFrame, description: str = "descr", syntax: str = "syntax", has_codes: Column | None = None) -> DataFrame:
    """Add data_type, measurement_type, units and the shortened description of each symbol."""
    text = F.col("_clean")
    declared = F.col(syntax)
    tag = F.when(text.rlike(COUNTER_WORDS), "Counter").when(text.rlike(GAUGE_WORDS), "Gauge").otherwise(declared)
    coded = F.lit(False) if has_codes is None else has_codes
    unit = units(text)
    trait = (unit.isNull() & (F.col("_tag") == declared) & reads_as_trait(text)) | coded
    numeric = F.col("_tag").isin(*NUMERIC_SYNTAX)
    is_counter = F.col("_tag").isin("Counter", "Counter32")
    return (
        df.withColumn("_clean", clean_description(F.col(description)))
        .withColumn("_tag", tag)
        .withColumns(
            {
                "data_type": F.when(numeric & ~trait, "measurement").otherwise("trait"),
                "measurement_type": F.when(is_counter & ~text.rlike(LAST_WORDS), "trendsup"),
                "units": F.when(F.col("_tag") == "TimeTicks", "milliseconds").otherwise(unit),
                "description": description_text(text),
            }
        )
        .drop("_clean", "_tag")
    )
