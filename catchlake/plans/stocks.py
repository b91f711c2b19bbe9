"""Stock status of every EEZ at once; the area is part of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchlake import constants as C
from catchlake.functions.columns import percent2
from catchlake.operators.aggregates import pivot_categories
from catchlake.operators.clean import exclude_keys
from catchlake.operators.joins import densify
from catchlake.operators.windows import centred_mean, with_peak, with_post_peak_min, with_run

AREA, TAXON, YEAR, CATCH = "main_area_id", "taxon_key", "year", "catch_sum"
STOCK = [AREA, TAXON]


def annual_series(fact: DataFrame, years: DataFrame) -> DataFrame:
    """Whole tonnes per area, taxon and calendar year, years without catch included as NULL."""
    rows = fact.filter(F.col("marine_layer_id").isin(C.EEZ, C.HIGH_SEAS) & F.col(AREA).isNotNull())
    rows = exclude_keys(rows, TAXON, C.AGGREGATE_TAXA)
    annual = rows.groupBy(AREA, TAXON, YEAR).agg(F.sum(CATCH).cast("decimal(20,0)").alias(CATCH))
    return densify(annual, STOCK, YEAR, CATCH, years, "time_business_key")


def stock_collate(fact, years, min_total: int = 1000, min_span: int = 10, min_run: int = 5) -> DataFrame:
    """Years with catch of the stocks that are large, long and steady enough, with peak and post-peak minimum.

    Everything after the annual sums is partitioned by (area, taxon), so the windows share one shuffle.
    """
    series = with_run(with_peak(annual_series(fact, years), STOCK, YEAR, CATCH), STOCK, YEAR, CATCH)
    stock = Window.partitionBy(*STOCK)
    caught = F.col(CATCH) > 0

    def over_caught(aggregate, column: str) -> Column:
        return aggregate(F.when(caught, F.col(column))).over(stock)

    kept = series.withColumns({
        "final_year": over_caught(F.max, YEAR),
        "_first_year": over_caught(F.min, YEAR),
        "_total": over_caught(F.sum, CATCH),
        "_run": over_caught(F.max, "positive_catch_count"),
    }).filter(
        (F.col("_total") >= min_total)
        & (F.col("final_year") - F.col("_first_year") + 1 >= min_span)
        & (F.col("_run") >= min_run)
        & (F.coalesce(F.col(CATCH), F.lit(0)) != 0)
    )
    collated = with_post_peak_min(kept, STOCK, YEAR, CATCH)
    return collated.select(AREA, TAXON, YEAR, CATCH, "peak_year", "peak_catch_sum", "final_year",
                           "post_peak_min_year", "post_peak_min_catch_sum")


def stock_category(collated: DataFrame) -> DataFrame:
    """Category per stock and year; the first rule that holds decides. Exactly half the peak after it holds none."""
    catch, peak, year = F.col(CATCH), F.col("peak_catch_sum"), F.col(YEAR)
    half, tenth = peak * F.lit("0.5").cast("decimal(2,1)"), peak * F.lit("0.1").cast("decimal(2,1)")
    between = (catch > tenth) & (catch < half)
    recovered = (F.col("post_peak_min_catch_sum") < tenth) & (year > F.col("post_peak_min_year"))
    after = year > F.col("peak_year")
    category = (
        F.when((F.col("peak_year") == F.col("final_year")) | (~after & (catch <= half)), 4)
        .when(catch > half, 3)
        .when(between & recovered, 5)
        .when(between & after, 2)
        .when((catch <= tenth) & after, 1)
        .otherwise(C.NO_CATEGORY)
    )
    return collated.withColumn("category_id", category)


def _tally(categorized: DataFrame) -> DataFrame:
    """Catch and stocks per area, category and year: the only grain the reports need.

    A stock has one row a year, so counting rows counts stocks. Each stock is marked once, at its first year, so that
    the number of stocks of an area is a sum too and no distinct count or second read is needed.
    """
    first = F.min(YEAR).over(Window.partitionBy(*STOCK))
    marked = categorized.withColumn("_first", (F.col(YEAR) == first).cast("int"))
    tally = marked.groupBy(AREA, "category_id", YEAR).agg(
        F.sum(CATCH).alias("category_catch"), F.count(F.lit(1)).alias("stocks"), F.sum("_first").alias("_stocks"))
    area, named = Window.partitionBy(AREA), F.col("category_id") != C.NO_CATEGORY
    return tally.withColumns({
        "taxa_count": F.sum("_stocks").over(area),
        "begin_year": F.min(F.when(named, F.col(YEAR))).over(area),
        "end_year": F.max(F.when(named, F.col(YEAR))).over(area),
    }).filter(named).drop("_stocks")


def _per_year(tally: DataFrame) -> DataFrame:
    """Smoothed catch and share of stocks for the years a category occurs in."""
    rows = centred_mean(tally, [AREA, "category_id"], YEAR, "category_catch", "begin_year", "end_year", "css")
    in_year = F.sum("stocks").over(Window.partitionBy(AREA, YEAR))
    return rows.withColumn("nss", F.col("stocks") * F.lit(100.0) / in_year)


def _all_years(per_year: DataFrame, years: DataFrame) -> DataFrame:
    """Every occurring category in every calendar year, gaps at zero, with catch as a share of the year's total."""
    values = per_year.withColumn("value", F.struct("css", "nss"))
    rows = densify(values, [AREA, "category_id"], YEAR, "value", years, "time_business_key")
    rows = rows.select(AREA, "category_id", YEAR, F.coalesce("value.css", F.lit(0.0)).alias("catch"),
                       F.coalesce("value.nss", F.lit(0.0)).alias("nss"))
    year_total = F.sum("catch").over(Window.partitionBy(AREA, YEAR))
    share = F.when(year_total != 0, F.col("catch") * 100.0 / year_total).otherwise(0.0)
    return rows.select(AREA, "category_id", YEAR, share.alias("css"), "nss")


def stock_css(categorized: DataFrame, years: DataFrame) -> DataFrame:
    """Catch by status, per cent of the smoothed total of the year."""
    return _all_years(_per_year(_tally(categorized)), years).select(AREA, "category_id", YEAR, F.col("css").alias("value"))


def stock_nss(categorized: DataFrame, years: DataFrame) -> DataFrame:
    """Number of stocks by status, per cent of the stocks with a category in the year."""
    return _all_years(_per_year(_tally(categorized)), years).select(AREA, "category_id", YEAR, F.col("nss").alias("value"))


def shown_areas(area: DataFrame, min_cells: int = 30) -> DataFrame:
    cells = area.filter(F.col("marine_layer_id") == C.EEZ).groupBy(AREA).agg(F.sum("number_of_cells").alias("cell_count"))
    return cells.filter(F.col("cell_count") > min_cells)


def stock_gate(categorized: DataFrame, area: DataFrame, min_cells: int = 30, min_taxa: int = 10) -> DataFrame:
    """Areas to show: more than min_cells cells and more than min_taxa taxa, those without a category included."""
    taxa = categorized.groupBy(AREA).agg(F.countDistinct(TAXON).alias("taxa_count"))
    shown = taxa.filter(F.col("taxa_count") > min_taxa).join(shown_areas(area, min_cells), AREA)
    return shown.select(AREA, "taxa_count", "cell_count")


def stock_status(fact, years, area, min_cells: int = 30, min_taxa: int = 10, **thresholds: int) -> DataFrame:
    """The report: per area, data set (css or nss) and year, one column per category.

    One read of the fact, one tally; both data sets come out of the same rows.
    """
    tally = _tally(stock_category(stock_collate(fact, years, **thresholds)))
    shown = tally.filter(F.col("taxa_count") > min_taxa).join(shown_areas(area, min_cells), AREA, "left_semi")
    shares = _all_years(_per_year(shown), years)
    both = F.array(*[F.struct(F.lit(n).alias("data_set"), F.col(n).alias("value")) for n in ("css", "nss")])
    rows = shares.select(AREA, YEAR, "category_id", F.inline(both))
    rows = rows.withColumn("value", percent2(F.col("value")))
    return pivot_categories(rows, [AREA, "data_set", YEAR], "category_id", "value", C.STOCK_HEADINGS)
