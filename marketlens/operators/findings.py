"""One-row findings: the numbers of a report and the sentence made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reports import pair_corr, row_at_extreme, share_of_total

# Strength words and their upper limits on the absolute correlation.
STRENGTH_LIMITS = (0.2, 0.5)
STRENGTH_WORDS = ("practically none", "weak", "considerable")


def finding_segment(summary: DataFrame, by: str, products: DataFrame) -> DataFrame:
    """The segment with most products, its mean price and the number of products in all."""
    total = products.agg(F.count(F.lit(1))).scalar()
    top = row_at_extreme(summary, "n", tie=[by])
    name = F.replace(F.col(by), F.lit("\n"), F.lit(" "))
    text = F.format_string(
        "segment '%s' holds most products (%d of %d), at a mean price of $%.2f",
        F.col("segment"), F.col("n"), F.col("total"), F.col("mean_price"),
    )
    return top.select(name.alias("segment"), "n", total.alias("total"), "mean_price").withColumn("finding", text)


def finding_brand(totals: DataFrame, brand: str, sales: str) -> DataFrame:
    """The leading brand, its units and its share of all sales."""
    top = row_at_extreme(share_of_total(totals, sales), sales, tie=[brand])
    text = F.format_string(
        "'%s' leads with %,d estimated units sold, %.2f%% of the total",
        F.col("brand"), F.col("units"), F.col("share_pct"),
    )
    return top.select(
        F.col(brand).alias("brand"), F.col(sales).cast("bigint").alias("units"), "share_pct"
    ).withColumn("finding", text)


def finding_trend(trend: DataFrame, ts: str = "date", value: str = "price") -> DataFrame:
    """First and last mean price with dates, change in percent, highest and lowest with dates."""
    row = F.struct(ts, value)
    ends = trend.agg(
        F.min_by(row, ts).alias("first"),
        F.max_by(row, ts).alias("last"),
        F.max_by(row, F.struct(F.col(value), -F.unix_micros(F.col(ts).cast("timestamp")))).alias("top"),
        F.min_by(row, F.struct(F.col(value), F.col(ts))).alias("low"),
    )
    day = lambda c: F.date_format(F.col(c)[ts], "dd/MM/yyyy")
    change = F.try_divide(F.col("last")[value] - F.col("first")[value], F.col("first")[value]) * 100
    text = F.format_string(
        "mean price went from $%.2f (%s) to $%.2f (%s), a change of %+.2f%%; "
        "highest $%.2f on %s, lowest $%.2f on %s",
        F.col("first_price"), F.col("first_day"), F.col("last_price"), F.col("last_day"), F.col("change_pct"),
        F.col("max_price"), F.col("max_day"), F.col("min_price"), F.col("min_day"),
    )
    return ends.select(
        F.col("first")[value].alias("first_price"), day("first").alias("first_day"),
        F.col("last")[value].alias("last_price"), day("last").alias("last_day"),
        change.alias("change_pct"),
        F.col("top")[value].alias("max_price"), day("top").alias("max_day"),
        F.col("low")[value].alias("min_price"), day("low").alias("min_day"),
    ).withColumn("finding", text)


def finding_corr(df: DataFrame, a: str, b: str, words: Sequence[str] = STRENGTH_WORDS, digits: int = 3) -> DataFrame:
    """Correlation of two columns (rounded, as reported), its strength word and a yes/no at 0.5."""
    weak, strong = STRENGTH_LIMITS
    size = F.abs("corr")
    strength = F.when(size < weak, words[0]).when(size < strong, words[1]).otherwise(words[2])
    return (
        df.agg(F.round(pair_corr(F.col(a), F.col(b)), digits).alias("corr"))
        .withColumn("strength", strength)
        .withColumn("linked", size >= strong)
    )
