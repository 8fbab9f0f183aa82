"""Lifecycle, price, service and risk features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import band, code_map, cut_points, first_match, range_of, round_away, yes_count


def value_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
    ranges: int | None = 64,
) -> DataFrame:
    """Linear-interpolated quantiles as one array column ``quantiles``, per group if any; NULL
    without a value. With ``accuracy`` they come from the mergeable sketch, else they are exact.

    Values are counted, and the counts are added up in ranges of values that a sketch lays out.
    That shows which range holds a quantile's two neighbours; only those ranges are ordered,
    each on its own, so no task holds the values of a group. How well the sketch cuts decides how
    even the ranges are, not what is found. Without ``ranges`` one task takes the counts of a
    group, an entry for each distinct value: enough for money, whose cents are as many as the
    price range, and with no join in the plan.
    """
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    if accuracy is not None:
        return df.groupBy(*by).agg(F.percentile_approx(column, points, accuracy).alias("quantiles"))
    counts = df.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    if ranges is None:
        return counts.groupBy(*by).agg(F.percentile(F.col("_v"), points, F.col("_n")).alias("quantiles"))
    keys = [*by, "_one"]
    whole = counts.groupBy(*by).agg(cut_points("_v", ranges).alias("_cuts"), F.sum("_n").alias("_total")).withColumn("_one", F.lit(1))
    placed = counts.withColumn("_one", F.lit(1)).join(whole.select(*keys, "_cuts"), keys)
    placed = placed.select(*keys, "_v", "_n", range_of(F.col("_v"), F.col("_cuts")).alias("_range"))
    in_range = placed.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in"))
    before = F.sum("_in").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_in")
    in_range = in_range.withColumn("_before", before).join(whole.select(*keys, "_total"), keys)
    # the two neighbours of quantile i are those of place 2i and 2i + 1
    position = [float(p) * (F.col("_total") - 1) for p in probabilities]
    ranks = [f(at).cast("long") for at in position for f in (F.floor, F.ceil)]
    wanted = F.inline(F.array(*[F.struct(F.lit(i).alias("_t"), rank.alias("_rank")) for i, rank in enumerate(ranks)]))
    wanted = in_range.select(*keys, "_range", "_before", "_in", wanted)
    wanted = wanted.filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in")))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_t").orderBy("_v"))
    ordered = placed.join(wanted, [*keys, "_range"]).withColumn("_upto", upto)
    held = ordered.filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    held = held.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_t", F.col("_v").cast("double")))).alias("_at"))
    low, high = (lambda i: F.col("_at")[F.lit(2 * i)]), (lambda i: F.col("_at")[F.lit(2 * i + 1)])
    between = lambda i, at: F.when(F.ceil(at) == F.floor(at), low(i)).otherwise((F.ceil(at) - at) * low(i) + (at - F.floor(at)) * high(i))
    quantiles = F.when(F.col("_at").isNotNull(), F.array(*[between(i, at) for i, at in enumerate(position)]))
    return whole.join(held, keys, "left").select(*by, quantiles.alias("quantiles"))


def charge_thresholds(
    df: DataFrame,
    column: str = "monthly_charges",
    probabilities: Sequence[float] = spec.CHARGE_QUANTILES,
    accuracy: int | None = None,
) -> DataFrame:
    """One row: the cut points q1, q2, ... of the charge tiers."""
    quantiles = value_quantiles(df, column, probabilities, accuracy=accuracy, ranges=None)
    return quantiles.select(*[F.col("quantiles")[i].alias(f"q{i + 1}") for i in range(len(probabilities))])


def charge_tier(charge: Column, cuts: Sequence[Column | float], labels: Sequence[str] = spec.CHARGE_TIERS) -> Column:
    """Label of the first cut point that is not below the charge; NULL charge gives NULL."""
    return band(charge, [*zip(cuts, labels[:-1], strict=True), (None, labels[-1])])


def average_spend(total: Column, months: Column, charge: Column, mode: str = "charge_when_new") -> Column:
    """``charge_when_new``: total per month, the monthly charge for month 0.
    ``at_least_one``: total over at least one month, in whole cents."""
    if mode == "charge_when_new":
        return F.when(months > 0, total / months).otherwise(charge)
    return round_away(total / F.greatest(months, F.lit(1)), 2)


def tenure_segment(months: Column, bands: Sequence = spec.TENURE_BANDS) -> Column:
    return band(months, bands)


def engineer(
    clean: DataFrame,
    cuts: Sequence[float] | DataFrame | None = None,
    services: Sequence[str] = spec.ADDON_SERVICES,
    spend_mode: str = "charge_when_new",
) -> DataFrame:
    """Add the eight engineered columns.

    ``cuts`` are fixed charge cut points, a one-row frame of saved ones, or None to fit
    quartiles on this frame. Fitted cuts arrive as a scalar subquery: no join, and none at
    all in plans that do not ask for the tier.
    """
    fitted = charge_thresholds(clean) if cuts is None else cuts
    if isinstance(fitted, DataFrame):
        packed = fitted.select(F.struct(*fitted.columns).alias("cuts")).scalar()
        clean = clean.withColumn("_cuts", packed)
        points: Sequence = [F.col("_cuts")[c] for c in fitted.columns]
    else:
        points = [float(c) for c in fitted]
    return clean.withColumns(
        {
            "tenure_segment": tenure_segment(F.col("tenure")),
            "monthly_charges_tier": charge_tier(F.col("monthly_charges"), points),
            "num_services": yes_count(services),
            "has_fiber": F.coalesce((F.col("internet_service") == "Fiber optic").cast("int"), F.lit(0)),
            "revenue_at_risk": F.col("monthly_charges"),
            "avg_monthly_spend": average_spend(
                F.col("total_charges"), F.col("tenure"), F.col("monthly_charges"), spend_mode
            ),
            "contract_risk_score": code_map(F.col("contract"), spec.CONTRACT_RISK),
            "support_score": yes_count(spec.SUPPORT_SERVICES),
        }
    ).drop("_cuts")


def online_features(
    clean: DataFrame, cuts: Sequence[float] = spec.LIVE_CHARGE_CUTS, services: Sequence[str] = spec.ALL_SERVICES
) -> DataFrame:
    """Features as the live form derives them: fixed cut points, phone counted as a service. Requests
    to a model count the ``services`` it was trained on (``spec.ADDON_SERVICES``)."""
    full = engineer(clean, cuts, services=services, spend_mode="at_least_one")
    return full.select(spec.KEY, *spec.FEATURES)


def contract_risk_lookup(df: DataFrame, codes: DataFrame, key: str = spec.KEY, column: str = "contract") -> DataFrame:
    """Code from a lookup table; values the table does not hold keep NULL."""
    return df.select(key, column).join(codes, column, "left")


def service_flags(df: DataFrame, keep: Sequence[str] = (spec.KEY, spec.LABEL, "monthly_charges")) -> DataFrame:
    """One 0/1 column per service rule."""
    return df.select(*keep, *[_flag(rule).alias(rule[0]) for rule in spec.SERVICE_FLAGS.values()])


def _flag(rule: tuple) -> Column:
    _, column, comparison, value = rule
    test = F.col(column) == value if comparison == "==" else F.col(column) != value
    return F.when(test, 1).otherwise(0)


def services_long(flags: DataFrame, keep: Sequence[str] = (spec.LABEL,)) -> DataFrame:
    """One row per record and service, from a single scan."""
    return flags.select(
        *keep,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("service"), F.col(rule[0]).alias("subscribed"))
                    for name, rule in spec.SERVICE_FLAGS.items()
                ]
            )
        ),
    )


def segments(df: DataFrame) -> DataFrame:
    """Value tier, risk tier and the segment they make."""
    charge, months = F.col("monthly_charges"), F.col("tenure")
    monthly = F.col("contract") == "Month-to-month"
    tiers = df.withColumns(
        {
            "value_tier": F.when((charge > 65) & (months > 24), "High Value").otherwise("Low Value"),
            "risk_tier": first_match(
                [(monthly & (months <= 12), "High Risk"), (monthly & (months <= 24), "Medium Risk")], "Low Risk"
            ),
        }
    )
    # Segment by (value tier, risk tier).
    names = {
        ("High Value", "Low Risk"): "Champions",
        ("High Value", "High Risk"): "At Risk",
        ("High Value", "Medium Risk"): "Needs Attention",
        ("Low Value", "High Risk"): "Lost Cause",
        ("Low Value", "Medium Risk"): "Promising",
    }
    rules = [((F.col("value_tier") == v) & (F.col("risk_tier") == r), name) for (v, r), name in names.items()]
    return tiers.withColumn("customer_segment", first_match(rules, "Sleepers"))
