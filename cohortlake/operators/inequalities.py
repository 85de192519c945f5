"""Activity rates by deprivation: eligibility, weighted regression and adjustment factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.expressions import quintile, share
from cohortlake.functions.materialise import materialise
from cohortlake.functions.stats import t_two_sided

GROUP = ["icb", "provider", "fyear", "sushrg_trimmed"]


def quintile_population(population: DataFrame) -> DataFrame:
    """Population of each ICB and provider by deprivation quintile, with its share and the total."""
    place = Window.partitionBy("icb", "provider")
    return (
        population.groupBy("icb", "provider", quintile(F.col("imd19")).alias("imd_quintile"))
        .agg(F.sum("pop").alias("pop"))
        .filter(F.col("pop") > 0)
        .withColumn("population_share", share("pop", "icb", "provider"))
        .withColumn("total_catchment_pop", F.sum("pop").over(place))
    )


def rate_table(population: DataFrame, ip: DataFrame, op: DataFrame) -> DataFrame:
    """Elective spells and outpatient procedures per head, by quintile and HRG.

    `op` has sushrg_trimmed and attendances (the outpatient rollup).
    """
    keys = ["icb", "provider", "imd_quintile", "sushrg_trimmed", "fyear"]
    spells = ip.filter(F.col("admimeth").startswith("1")).select(
        *keys[:3], F.substring("sushrg", 1, 4).alias("sushrg_trimmed"), "fyear", F.lit(1).cast("long").alias("count")
    )
    visits = op.filter(F.col("has_procedures")).select(*keys, F.col("attendances").cast("long").alias("count"))
    return materialise(
        spells.unionByName(visits)
        .groupBy(*keys)
        .agg(F.sum("count").alias("count"))
        .join(quintile_population(population), ["icb", "provider", "imd_quintile"])
        .withColumn("activity_rate", F.col("count") / F.col("pop"))
    )


def eligible(rates: DataFrame, min_count: int = 50, min_quintiles: int = 3) -> DataFrame:
    """Groups with enough quintiles, each with enough activity."""
    return (
        rates.groupBy(*GROUP)
        .agg(F.countDistinct("imd_quintile").alias("n_quintiles"), F.min("count").alias("min_count"))
        .filter((F.col("n_quintiles") >= min_quintiles) & (F.col("min_count") >= min_count))
    )


def regressions(rates: DataFrame, min_count: int = 50) -> DataFrame:
    """Weighted least squares of the rate on the quintile (weight: population) for each eligible group.

    A line through at most five points has a closed form in weighted sums, and its t statistic has
    one to three degrees of freedom, whose distribution is elementary. So this is two aggregates.
    """
    w, x, y = F.col("pop"), F.col("imd_quintile"), F.col("activity_rate")
    centred = (
        rates.join(eligible(rates, min_count).select(*GROUP), GROUP, "left_semi")
        .groupBy(*GROUP)
        .agg(
            F.sum(w).alias("sw"),
            F.sum(w * x).alias("swx"),
            F.sum(w * y).alias("swy"),
            F.count(F.lit(1)).alias("points"),
            F.collect_list(F.struct(w.alias("w"), x.alias("x"), y.alias("y"))).alias("rows"),
        )
        .withColumn("mx", F.col("swx") / F.col("sw"))
        .withColumn("my", F.col("swy") / F.col("sw"))
    )

    def total(term):
        return F.aggregate("rows", F.lit(0.0), lambda acc, r: acc + term(r))

    fitted = (
        centred.withColumn("sxx", total(lambda r: r["w"] * (r["x"] - F.col("mx")) * (r["x"] - F.col("mx"))))
        .withColumn("sxy", total(lambda r: r["w"] * (r["x"] - F.col("mx")) * (r["y"] - F.col("my"))))
        .withColumn("slope", F.col("sxy") / F.col("sxx"))
        .withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
    )
    residual = lambda r: r["y"] - F.col("intercept") - F.col("slope") * r["x"]
    free = F.col("points") - 2
    error = F.sqrt(total(lambda r: r["w"] * residual(r) * residual(r)) / free / F.col("sxx"))
    t = F.try_divide(F.col("slope"), error)
    # an exact fit has no error: certain if there is a slope, undecided if there is none
    pvalue = F.when((error == 0) & (F.col("slope") != 0), 0.0).otherwise(t_two_sided(t, free))
    return fitted.select(*GROUP, pvalue.alias("pvalue"), "slope", "intercept")


def adjustments(rates: DataFrame, fits: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Factors that level up, level down or even out activity where it rises with affluence."""
    rising = fits.filter((F.col("pvalue") < alpha) & (F.col("slope") > 0)).select(*GROUP, "slope", "intercept")
    group = Window.partitionBy(*GROUP)
    line, rate, q = F.col("fitted_line"), F.col("activity_rate"), F.col("imd_quintile")
    level_up = F.when(q == F.max(q).over(group), 1.0).otherwise(F.try_divide(F.max(line).over(group), rate))
    lowest = F.min(line).over(group)
    level_down = F.when(q == F.min(q).over(group), 1.0).when(lowest < 0, 0.0).otherwise(F.try_divide(lowest, rate))
    return (
        rates.join(rising, GROUP)
        .withColumn("fitted_line", F.col("intercept") + F.col("slope") * q)
        .withColumn("level_up", level_up)
        .withColumn("level_down", level_down)
        .withColumn("zero_sum", F.try_divide(F.avg(line).over(group), rate))
        .select(*GROUP, "imd_quintile", "activity_rate", "fitted_line", "level_up", "level_down", "zero_sum")
    )
