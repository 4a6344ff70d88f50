"""A risk score: how likely a transaction is to fail, learnt from the transactions before it.

What is known of a customer and a merchant at the start of a day (their profile) is all that a
transaction of that day is judged by, besides its amount: nothing of the day itself, let alone of later ones, gets
into it. A profile is a sum over days, so it comes from counts per day: one shuffle of rows that are combined in each task
first, and running totals over days only, of which even a customer or merchant with a third of all
transactions has no more than there are days.

The features are bands, each a column of 0 and 1; the model is a pipeline of ``pyspark.ml`` that puts them into a
vector and fits naive Bayes over them. It is fitted on the transactions before a day and judges those from that day on.
The definitions are this library's own.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskstream.functions import period_start, usable_amount

#: Upper ends of bands: share of failures in hundredths, number of transactions, amount in hundredths of the mean, days.
SHARES, COUNTS, RATIOS, DAYS = (10, 25, 50), (5, 20), (50, 100, 200), (2, 8, 31)
#: What a profile holds, all of days before its own.
MEASURES = ("n", "failed", "cents", "amounts")


def _cents() -> Column:
    return F.round(usable_amount() * 100).cast("long")


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", period_start("day"))


def daily_totals(df: DataFrame, by: str, failed: str = "FAILED") -> DataFrame:
    """(by, day) with numbers of transactions and failures, and sum and number of amounts in cents."""
    rows = with_day(df).where(F.col(by).isNotNull() & F.col("day").isNotNull())
    return rows.groupBy(by, "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status") == failed).alias("failed"),
        F.coalesce(F.sum(_cents()), F.lit(0)).alias("cents"),
        F.count(_cents()).alias("amounts"),
    )


def past_profiles(df: DataFrame, by: str, failed: str = "FAILED") -> DataFrame:
    """(by, as_of) for every day with a transaction: the totals of the days before it, and the last of these (``last_day``)."""
    before = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in MEASURES]
    return daily_totals(df, by, failed).select(by, F.col("day").alias("as_of"), *totals, F.max("day").over(before).alias("last_day"))


def profiles_of(df: DataFrame, by: str, day: Column, failed: str = "FAILED") -> DataFrame:
    """(by, as_of): the totals of all days before one day, for everyone there was by then."""
    rows = daily_totals(df, by, failed).where(F.col("day") < day)
    totals = rows.groupBy(by).agg(*(F.sum(c).alias(c) for c in MEASURES), F.max("day").alias("last_day"))
    return totals.withColumn("as_of", day)


def _band(value: Column, ends: tuple[int, ...], known: Column) -> Column:
    """0 if nothing is known, then 1 and so on; a band ends before its upper end."""
    out = F.lit(len(ends) + 1)
    for i, end in reversed(list(enumerate(ends, 1))):
        out = F.when(value < end, i).otherwise(out)
    return F.when(known, out).otherwise(0)


#: The features and their numbers of bands, the unknown one included.
FEATURES = {
    "customer_failures": len(SHARES) + 2,
    "merchant_failures": len(SHARES) + 2,
    "customer_count": len(COUNTS) + 2,
    "amount_to_mean": len(RATIOS) + 2,
    "days_since": len(DAYS) + 2,
}
INDICATORS = [f"{name}_{band}" for name, bands in FEATURES.items() for band in range(bands)]


def features(df: DataFrame, customers: DataFrame, merchants: DataFrame) -> DataFrame:
    """Transactions, which have ``day`` and ``as_of``, with their indicators.

    ``customers`` and ``merchants`` are profiles: at most one for each (id, as_of).
    """
    out = df
    for by, short, profiles in (("customer_id", "c", customers), ("merchant", "m", merchants)):
        named = profiles.select(by, "as_of", F.struct(*MEASURES, "last_day").alias(f"_{short}"))
        out = out.join(named, [by, "as_of"], "left")

    def share(of: str) -> Column:
        # whole numbers: a share at the very end of a band isn't a matter of rounding
        band = F.lit(len(SHARES) + 1)
        for i, end in reversed(list(enumerate(SHARES, 1))):
            band = F.when(F.col(f"{of}.failed") * 100 < end * F.col(f"{of}.n"), i).otherwise(band)
        return F.when(F.col(f"{of}.n") > 0, band).otherwise(0)

    ratio = F.lit(len(RATIOS) + 1)
    for i, end in reversed(list(enumerate(RATIOS, 1))):
        ratio = F.when(_cents() * F.col("_c.amounts") * 100 < end * F.col("_c.cents"), i).otherwise(ratio)
    bands = {
        "customer_failures": share("_c"),
        "merchant_failures": share("_m"),
        "customer_count": _band(F.col("_c.n"), COUNTS, F.col("_c.n") > 0),
        "amount_to_mean": F.when((F.col("_c.amounts") > 0) & _cents().isNotNull(), ratio).otherwise(0),
        "days_since": _band(F.datediff("day", "_c.last_day"), DAYS, F.col("_c.last_day").isNotNull()),
    }
    out = out.withColumns({f"_{name}": band for name, band in bands.items()})
    found = {f"{name}_{b}": (F.col(f"_{name}") == b).cast("double") for name, n in FEATURES.items() for b in range(n)}
    return out.withColumns(found).drop("_c", "_m", *(f"_{name}" for name in bands))


def past_features(df: DataFrame, failed: str = "FAILED") -> DataFrame:
    """Transactions with the indicators that the others of the table give them. One without a day is left out."""
    rows = with_day(df).where(F.col("day").isNotNull()).withColumn("as_of", F.col("day"))
    return features(rows, past_profiles(df, "customer_id", failed), past_profiles(df, "merchant", failed))


def fit(rows: DataFrame, failed: str = "FAILED", smoothing: float = 1.0) -> PipelineModel:
    """A model of rows with indicators and a status; those without a status are left out, and one must have it.

    One pass of sums; nothing but the sums of each class comes to the driver.
    """
    labelled = rows.where(F.col("status").isNotNull()).withColumn("label", (F.col("status") == failed).cast("double"))
    vector = VectorAssembler(inputCols=INDICATORS, outputCol="_features")
    bayes = NaiveBayes(featuresCol="_features", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted", smoothing=smoothing)
    return Pipeline(stages=[vector, bayes]).fit(labelled)


def score(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with indicators get ``risk``, from 0 to 1; the indicators go."""
    found = model.transform(rows)
    made = [c for c in found.columns if c.startswith("_") and c not in rows.columns]
    return found.withColumn("risk", F.coalesce(F.get(vector_to_array("_probability"), F.lit(1)), F.lit(0.0))).drop(*made, *INDICATORS)
