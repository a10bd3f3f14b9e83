"""Case load, tiers and risk scores of facilities."""

from pyspark.sql import Column, DataFrame, functions as F

from epigrid.constants import RISK_TIERS, SEVERE
from epigrid.functions.geo import is_severe, round_half_up, to_degrees, to_metres
from epigrid.operators.counting import ring_counts
from epigrid.operators.proximity import within_distance

# Tier labels, tier points, and the severity scores with the radius in metres up to which they count.
TIER_LABELS = {"RED": "RED (0-500m)", "ORANGE": "ORANGE (500m-1km)", "YELLOW": "YELLOW (1-2km)"}
TIER_POINTS = {"RED": 3, "ORANGE": 2, "YELLOW": 1}
SEVERITY_SCORES = (("DSS", 500, 3), ("DHF", 1000, 2), ("DF", 2000, 1))


def case_load(
    facilities: DataFrame, cases: DataFrame, metres: float, severe=SEVERE, by: tuple[str, ...] = ("name", "district")
) -> DataFrame:
    """Cases within a radius of each facility: how many, how many severe, and how near the nearest is.

    Facilities without a case do not appear. Rows are grouped on `by`; pass the id to keep namesakes apart.
    """
    near = ring_counts(facilities, cases, [metres], by=("severity",))
    return near.groupBy(*by).agg(
        F.sum("_n").alias("case_count"),
        _total_if(is_severe("severity", severe)).alias("severe_count"),
        round_half_up(to_metres(F.min("_near"))).alias("nearest_case_meters"),
    )


def tier_label(dist: Column, names: dict[str, str] = TIER_LABELS) -> Column:
    """Exclusive tier of a distance: the first tier whose radius holds it, NULL beyond the last."""
    return _first_tier(dist, {tier: F.lit(names[tier]) for tier, _ in RISK_TIERS})


def tiered_pairs(facilities: DataFrame, cases: DataFrame) -> DataFrame:
    """Facility-case pairs within the widest tier, each with its exclusive tier."""
    pairs = within_distance(facilities, cases, RISK_TIERS[-1][1])
    return pairs.withColumns(
        {
            "distance_meters": round_half_up(to_metres("dist_deg")),
            "risk_tier": tier_label(F.col("dist_deg")),
        }
    )


def cumulative_tiers(facilities: DataFrame, cases: DataFrame, by: tuple[str, ...] = ("name",)) -> DataFrame:
    """Cases up to each tier's radius; a case counts in its own tier and in every wider one. One search serves all."""
    near = ring_counts(facilities, cases, [radius for _, radius in RISK_TIERS])
    counts = [_total_if(F.col("_ring") <= k).alias(f"{tier.lower()}_cases") for k, (tier, _) in enumerate(RISK_TIERS)]
    return near.groupBy(*by).agg(
        F.sum("_n").alias("threatening_cases"),
        *counts,
        round_half_up(to_metres(F.min("_near"))).alias("nearest_case_m"),
    )


def severity_score(facilities: DataFrame, cases: DataFrame, by: tuple[str, ...] = ("name",)) -> DataFrame:
    """Score of every facility, zero included: each severity counts up to its own radius."""
    radii = sorted({radius for _, radius, _ in SEVERITY_SCORES})
    near = ring_counts(facilities, cases, radii, by=("severity",), nearest=False)
    counted = [
        (severity, points, (F.col("severity") == severity) & (F.col("_ring") <= radii.index(radius)))
        for severity, radius, points in SEVERITY_SCORES
    ]
    score = sum((F.when(cond, points).otherwise(0) for _, points, cond in counted), F.lit(0))
    # Aggregated before the outer join, so that only one row per facility meets the preserved side.
    scores = near.groupBy("id").agg(
        F.sum(score * F.col("_n")).cast("bigint").alias("total_risk_score"),
        *[_total_if(cond).alias(f"{severity.lower()}_cases") for severity, _, cond in counted],
    )
    measures = [c for c in scores.columns if c != "id"]
    joined = facilities.join(scores, "id", "left")
    return joined.groupBy(*by).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in measures])


def fogging_score(facilities: DataFrame, cases: DataFrame, by: tuple[str, ...] = ("name", "district")) -> DataFrame:
    """Fogging priority: tier points of every case within 2 km, doubled for severe cases."""
    near = ring_counts(facilities, cases, [radius for _, radius in RISK_TIERS], by=("severity",), nearest=False)
    points = F.element_at(F.array(*[F.lit(TIER_POINTS[tier]) for tier, _ in RISK_TIERS]), F.col("_ring") + 1)
    weight = F.when(is_severe("severity", SEVERE), 2).otherwise(1)
    return near.groupBy(*by).agg(
        F.sum("_n").alias("case_count"),
        F.sum(points * weight * F.col("_n")).cast("bigint").alias("risk_score"),
        _total_if(F.col("_ring") == 0).alias("red_cases"),
    )


def fogging_summary(scores: DataFrame) -> DataFrame:
    """One row: number of scored facilities, their average score, and how many have a case in the RED tier."""
    return scores.agg(
        F.count(F.lit(1)).alias("schools"),
        round_half_up(F.sum("risk_score").cast("double") / F.count(F.lit(1)), 2).alias("avg_risk_score"),
        count_if(F.col("red_cases") > 0).alias("schools_in_red"),
    )


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _total_if(condition: Column) -> Column:
    """Cases of the rows of `ring_counts` that meet a condition."""
    return F.sum(F.when(condition, F.col("_n")).otherwise(F.lit(0).cast("bigint")))


def _first_tier(dist: Column, values: dict[str, Column]) -> Column:
    result = None
    for tier, radius in RISK_TIERS:
        inside = dist <= to_degrees(float(radius))
        result = F.when(inside, values[tier]) if result is None else result.when(inside, values[tier])
    return result
