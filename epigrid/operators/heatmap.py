"""Geohash heatmaps, monthly reports and their overlay with risk zones.

Counting runs on 64-bit cell keys with a partial aggregate before the shuffle; the cell's text and rectangle are made
from the key afterwards, once per result row.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from epigrid.constants import SEVERE, SEVERITIES
from epigrid.functions.geo import is_severe, round_half_up
from epigrid.functions.geohash import (
    bit_counts,
    cell_box,
    cell_index,
    cell_text,
    index_box,
    index_key,
    parent_key,
    text_key,
)
from epigrid.functions.rings import box_ring, buffer_meets_box, ring_wkt
from epigrid.operators.scoring import count_if

FINEST = 7


def with_cells(cases: DataFrame, precisions: tuple[int, ...] = (5, 6, 7)) -> DataFrame:
    """Add the geohash of every case as `cell_<precision>`; coarse cells are prefixes of the finest.

    A case without coordinates keeps its row and has no cell.
    """
    finest = max(precisions)
    keyed = with_key(cases, finest, keep=True)
    texts = {
        f"cell_{p}": cell_text(parent_key(F.col("_cell"), finest, p), p) for p in precisions
    }
    return keyed.withColumns(texts).drop("_cell")


def with_key(cases: DataFrame, precision: int, keep: bool = False) -> DataFrame:
    """Add the cell key as `_cell`; rows without coordinates have none and are left out, or kept if asked for."""
    located = cases if keep else cases.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    ix, iy = cell_index(F.col("lon"), F.col("lat"), precision)
    # Two projections: the indexes are computed once and then read bit by bit.
    indexed = located.withColumns({"_ix": ix, "_iy": iy})
    key = index_key(F.col("_ix"), F.col("_iy"), precision)
    if keep:
        # Only here: a key that may be NULL would make a join on it test its whole expression below both projections.
        key = F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), key)
    return indexed.withColumn("_cell", key).drop("_ix", "_iy")


def cell_rings(df: DataFrame, precision: int) -> DataFrame:
    """Add the rectangle of the key `_cell` as `ring`."""
    corners = ("x0", "y0", "x1", "y1")
    boxed = df.withColumns({f"_{c}": column for c, column in cell_box(F.col("_cell"), precision).items()})
    return boxed.withColumn("ring", box_ring(*[F.col(f"_{c}") for c in corners])).drop(*[f"_{c}" for c in corners])


def cell_heatmap(
    cases: DataFrame, precision: int = 6, polygons: bool = False, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per cell: cases, severe cases, first and last date, duration in days; the rectangle as text if asked for.

    `by` adds grouping columns, for instance the region.
    """
    counted = (
        with_key(cases, precision)
        .groupBy(*by, "_cell")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            count_if(is_severe("severity", SEVERE)).alias("severe_count"),
            F.min("infection_date").alias("first_case_date"),
            F.max("infection_date").alias("last_case_date"),
        )
        .withColumn("outbreak_duration_days", F.date_diff("last_case_date", "first_case_date").cast("bigint"))
    )
    return _name_cells(counted, precision, polygons)


def resolution_counts(cases: DataFrame, labels: dict[int, str]) -> DataFrame:
    """Cases per cell at several precisions with a label each.

    The cases are counted once, at the finest precision; coarser counts add those up.
    """
    finest = max(labels)
    counts = with_key(cases, finest).groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    levels = F.array(
        *[
            F.struct(
                F.lit(p).alias("grid_precision"),
                F.lit(label).alias("level"),
                parent_key(F.col("_cell"), finest, p).alias("cell"),
            )
            for p, label in sorted(labels.items())
        ]
    )
    rolled = (
        counts.select(F.explode(levels).alias("_l"), "_n")
        .select("_l.*", "_n")
        .groupBy("grid_precision", "level", "cell")
        .agg(F.sum("_n").alias("case_count"))
    )
    text = F.coalesce(*[F.when(F.col("grid_precision") == p, cell_text(F.col("cell"), p)) for p in sorted(labels)])
    return rolled.select("level", text.alias("cell_id"), "case_count")


def compare_resolutions(
    cases: DataFrame, precisions: tuple[int, ...] = (5, 6, 7), by: tuple[str, ...] = ()
) -> DataFrame:
    """Per precision (and `by`): occupied cells, cases, and cases per cell, by two counts instead of a distinct one."""
    finest = max(precisions)
    counts = with_key(cases, finest).groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    levels = F.array(
        *[
            F.struct(F.lit(p).alias("grid_precision"), parent_key(F.col("_cell"), finest, p).alias("cell"))
            for p in precisions
        ]
    )
    per_cell = (
        counts.select(*by, F.explode(levels).alias("_l"), "_n")
        .select(*by, "_l.*", "_n")
        .groupBy(*by, "grid_precision", "cell")
        .agg(F.sum("_n").alias("_n"))
    )
    return per_cell.groupBy(*by, "grid_precision").agg(
        F.count(F.lit(1)).alias("cell_count"),
        F.sum("_n").alias("total_cases"),
        round_half_up(F.sum("_n") * F.lit(1.0) / F.count(F.lit(1)), 1).alias("avg_per_cell"),
    )


def monthly_cells(cases: DataFrame, precision: int = 6, polygons: bool = True) -> DataFrame:
    """Cases and severe cases per month and cell."""
    counted = (
        with_key(_with_month(cases), precision)
        .groupBy("report_month", "_cell")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            count_if(is_severe("severity", SEVERE)).alias("severe_count"),
        )
    )
    return _name_cells(counted, precision, polygons)


def cell_report(cases: DataFrame, precision: int = 6) -> DataFrame:
    """Monthly cell report: cases by severity, average age, and the rectangle as text."""
    counted = (
        with_key(_with_month(cases), precision)
        .groupBy("report_month", "_cell")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            *[count_if(F.col("severity") == s).alias(f"{s.lower()}_count") for s in SEVERITIES],
            round_half_up(F.avg("patient_age"), 1).alias("avg_age"),
        )
        .withColumn("grid_precision", F.lit(precision))
    )
    named = _name_cells(counted, precision, polygons=True)
    return named.withColumnRenamed("cell_polygon_wkt", "wkt")


def monthly_trend(cases: DataFrame) -> DataFrame:
    """Cases, severe cases and average age per month."""
    return (
        _with_month(cases)
        .groupBy("report_month")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            count_if(is_severe("severity", SEVERE)).alias("severe_cases"),
            round_half_up(F.avg("patient_age"), 1).alias("avg_patient_age"),
        )
    )


def month_change(cases: DataFrame, precision: int = 6) -> DataFrame:
    """Change of each cell's cases against its previous month with cases (0 before the first)."""
    monthly = with_key(_with_month(cases), precision).groupBy("_cell", "report_month").agg(
        F.count(F.lit(1)).alias("case_count")
    )
    before = F.lag("case_count", 1, 0).over(Window.partitionBy("_cell").orderBy("report_month"))
    changes = monthly.withColumn("prev_month_cases", before).withColumn(
        "month_change", F.col("case_count") - F.col("prev_month_cases")
    )
    return _name_cells(changes, precision, polygons=False)


def latest_month(report: DataFrame) -> DataFrame:
    """Rows of the newest month of a stored report. On a table partitioned by month the filter prunes the partitions."""
    return report.filter(F.col("report_month") == report.agg(F.max("report_month")).scalar())


def latest_month_report(cases: DataFrame, precision: int = 6) -> DataFrame:
    """The report of the newest month alone: the month is found from one column, and older cases are not grouped."""
    month = cases.agg(F.trunc(F.max("infection_date"), "MM").alias("m")).scalar()
    return cell_report(cases.filter((F.col("infection_date") >= month) & (F.col("infection_date") < F.add_months(month, 1))), precision)


def touched_cells(centres: DataFrame, radius_deg: Column, group: list[str], precision: int = 6) -> DataFrame:
    """Cells met by at least one buffer of each group, as `group` columns and the key `_cell`.

    A merged zone meets a cell exactly if one of its member buffers does, so the zone is not built. A buffer is tested
    against the cells under its own box only, and duplicates fall away before the shuffle.
    """
    x, y, r = F.col("lon"), F.col("lat"), F.col("_r")
    low = cell_index(x - r, y - r, precision)
    high = cell_index(x + r, y + r, precision)
    last = [(1 << bits) - 1 for bits in bit_counts(precision)]

    def span(axis: int) -> Column:
        # One cell more on each side: contact counts, also at the edge of the box.
        first = F.greatest(low[axis] - F.lit(1), F.lit(0).cast("bigint"))
        return F.sequence(first, F.least(high[axis] + F.lit(1), F.lit(last[axis]).cast("bigint")))

    box = index_box(F.col("_ix"), F.col("_iy"), precision)
    return (
        centres.select(*group, "lon", "lat", radius_deg.alias("_r"))
        .withColumn("_ix", F.explode(span(0)))
        .withColumn("_iy", F.explode(span(1)))
        .filter(buffer_meets_box(x, y, r, box["x0"], box["y0"], box["x1"], box["y1"]))
        .select(*group, "_ix", "_iy")
        .distinct()
        .select(*group, index_key(F.col("_ix"), F.col("_iy"), precision).alias("_cell"))
    )


def overlap_join(report: DataFrame, touched: DataFrame, precision: int = 6) -> DataFrame:
    """Join report rows with the zones that meet their cell."""
    keyed = report.withColumn("_cell", text_key(F.col("cell_id"), precision))
    return keyed.join(touched, "_cell").drop("_cell")


def severity_mix(cases: DataFrame) -> DataFrame:
    return cases.groupBy("severity").agg(
        F.count(F.lit(1)).alias("case_count"), round_half_up(F.avg("patient_age"), 1).alias("avg_age")
    )


def _with_month(cases: DataFrame) -> DataFrame:
    return cases.withColumn("report_month", F.trunc("infection_date", "MM"))


def _name_cells(df: DataFrame, precision: int, polygons: bool) -> DataFrame:
    named = df.withColumn("cell_id", cell_text(F.col("_cell"), precision))
    if polygons:
        named = cell_rings(named, precision).withColumn("cell_polygon_wkt", ring_wkt(F.col("ring"))).drop("ring")
    return named.drop("_cell")
