"""A bounded training sample of labelled rows, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, by: str, per_value: int, most_rows: int, order: str = "doc_id", most_chars: int = 1 << 17) -> list:
    """At most `per_value` rows (text, `by`) of each value of `by`, those of the smallest hash of `order`: fewer where
    there are so many values that they would be more than `most_rows`, but at least one of each. Of a longer text the
    first `most_chars` are learnt from. So the bounds are on rows and their length, and no value is left out.

    Counts come first, so that only rows under each value's share of the hash range are compared; no task takes all
    rows of a frequent value.
    """
    rows = rows.filter(f"{by} is not null and text is not null")
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    values = counts.count()
    if not values:
        return []
    per_value = max(1, min(per_value, most_rows // values))
    rate = F.least(F.lit(1 << 30), F.floor(F.lit((1 << 30) * (per_value + 4 * int(per_value**0.5) + 20)) / F.col("_n")) + 1)
    rates = counts.select(by, rate.alias("_rate"))
    rates = F.broadcast(rates) if values <= 10_000 else rates
    hashed = F.pmod(F.xxhash64(F.lit("sample"), order, "text"), F.lit(1 << 30))
    few = rows.withColumn("_h", hashed).join(rates, by).filter(F.col("_h") < F.col("_rate")).select(F.substring("text", 1, most_chars).alias("text"), by, "_h")
    kept: dict = {}
    for r in few.collect():  # a little over per_value rows of each value
        kept.setdefault(r[1], []).append((r["_h"], r["text"]))
    return [(text, value) for value in sorted(kept) for _, text in sorted(kept[value])[:per_value]]
