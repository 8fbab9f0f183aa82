"""Reports on per-feature contributions in long form: (id, feature, value, contribution)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import spec
from holdfast.functions import round_away, title_words
from holdfast.operators.features import value_quantiles
from holdfast.operators.risk import risk_terms

# The column each score term reads.
TERM_COLUMNS = {
    "contract": "contract_risk_score",
    "tenure": "tenure",
    "fiber": "has_fiber",
    "charges": "monthly_charges",
    "support": "support_score",
    "services": "num_services",
}


def score_contributions(
    rows: DataFrame,
    population: DataFrame,
    key: str = spec.KEY,
    terms: Mapping[str, Column] | None = None,
    columns: Mapping[str, str] = TERM_COLUMNS,
) -> DataFrame:
    """Contribution of each term of an additive score: the term minus its population mean.

    For an additive score these are its exact Shapley values.
    """
    terms = terms or risk_terms()
    means = population.agg(F.struct(*[F.avg(t).alias(name) for name, t in terms.items()])).scalar()
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(columns[name]).cast("double").alias("value"),
            (term - F.col("_means")[name]).alias("contribution"),
        )
        for name, term in terms.items()
    ]
    return rows.withColumn("_means", means).select(F.col(key), F.inline(F.array(*entries)))


def base_value(population: DataFrame, terms: Mapping[str, Column] | None = None) -> DataFrame:
    """Mean score of the population, the point contributions start from."""
    total = sum(terms.values() if terms else risk_terms().values(), F.lit(0))
    return population.agg(F.avg(total).alias("base"))


def _impacts(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean_signed")
    )


def driver_ranking(long: DataFrame, k: int = 10) -> DataFrame:
    """Top features by mean absolute contribution; a mean of zero (to nine decimals) counts as
    decreasing, as over the very population the contributions are centred on."""
    impact = round_away("mean_abs", 4)
    order = [F.desc("impact"), "feature"]
    top = _impacts(long).withColumn("impact", impact).orderBy(*order).limit(k)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("place"),
        "feature",
        "impact",
        F.when(F.round("mean_signed", 9) > 0, "increases").otherwise("decreases").alias("direction"),
    )


def bar_label(feature: Column) -> Column:
    """First word in title case, the rest after a colon as it is."""
    parts = F.split(feature, "_", 2)
    return F.when(F.size(parts) > 1, F.concat(title_words(parts[0]), F.lit(": "), parts[1])).otherwise(title_words(feature))


def card_label(feature: Column, width: int = 20) -> Column:
    return F.left(title_words(F.replace(feature, F.lit("_"), F.lit(" "))), F.lit(width))


def feature_labels(features: DataFrame) -> DataFrame:
    return features.select("feature", bar_label(F.col("feature")).alias("bar_label"), card_label(F.col("feature")).alias("card_label"))


def driver_cards(drivers: DataFrame, k: int = 5) -> DataFrame:
    """First drivers with a short label, the impact to four decimals and an arrow."""
    arrow = F.when(F.col("direction") == "increases", "▲").otherwise("▼")
    top = drivers.orderBy("place").limit(k)
    return top.select(
        "place",
        card_label(F.col("feature")).alias("card"),
        F.format_string("%.4f", "impact").alias("impact"),
        F.concat(arrow, F.lit(" "), "direction", F.lit(" churn")).alias("note"),
    )


def driver_bars(long: DataFrame, k: int = 15) -> DataFrame:
    """Top features with their label and whether they lie above the median of those shown."""
    top = _impacts(long).select("feature", round_away("mean_abs", 6).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature").limit(k)
    middle = F.percentile("mean_abs", 0.5).over(Window.partitionBy())
    return top.select("feature", bar_label(F.col("feature")).alias("label"), "mean_abs", (F.col("mean_abs") > middle).alias("above_median"))


def waterfall(long: DataFrame, key_of: DataFrame, base: DataFrame, key: str = spec.KEY, k: int = 15) -> DataFrame:
    """One record's contributions from base to score: the largest ones, the rest as one line.

    ``key_of`` and ``base`` are one-row frames. With more than k features the k - 1 largest
    are shown.
    """
    mine = long.filter(F.col(key) == key_of.select(key).scalar())
    by_size = Window.orderBy(F.desc(F.abs("contribution")), "feature")
    ranked = mine.withColumn("place", F.row_number().over(by_size)).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy())
    )
    shown = F.col("n") <= k
    kept = shown | (F.col("place") < k)
    line = ranked.groupBy(
        F.when(kept, F.col("place")).otherwise(k).cast("bigint").alias("place"),
        F.when(kept, F.col("feature")).otherwise("other").alias("feature"),
        F.when(kept, F.col("value")).alias("value"),
    ).agg(F.sum("contribution").alias("contribution"))
    ends = base.select(
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("place"), F.lit("base").alias("feature"), F.col("base").alias("contribution")),
            )
        )
    )
    total = mine.agg(F.sum("contribution").alias("s"))
    score = total.select(
        F.lit(k + 1).cast("bigint").alias("place"), F.lit("score").alias("feature"),
        (F.col("s") + base.select("base").scalar()).alias("contribution"),
    )
    return (
        line.unionByName(ends, allowMissingColumns=True)
        .unionByName(score, allowMissingColumns=True)
        .select("place", "feature", "value", round_away("contribution", 6).alias("contribution"))
        .orderBy("place")
    )


def dependence(long: DataFrame, rows: DataFrame, feature: str = "tenure", colour: str = "contract_risk_score", key: str = spec.KEY) -> DataFrame:
    """Value and contribution of one feature per record, with the column that colours the point."""
    points = long.filter(F.col("feature") == feature).select(key, F.col("value"), round_away("contribution", 6).alias("contribution"))
    return points.join(rows.select(key, colour), key)


def dependence_by_value(long: DataFrame, feature: str = "tenure") -> DataFrame:
    """Mean contribution and size per value, for tables too large to draw point by point."""
    return (
        long.filter(F.col("feature") == feature)
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("contribution").alias("mean_contribution"))
    )


def distribution(
    long: DataFrame, k: int = 20, probabilities: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), accuracy: int | None = None
) -> DataFrame:
    """Quantiles of value and contribution for the k features of largest mean impact.

    They are exact; with ``accuracy`` they come from the mergeable sketch.
    """
    names = [f"p{round(p * 100)}" for p in probabilities]
    top = _impacts(long).orderBy(F.desc("mean_abs"), "feature").limit(k)
    rows = long.join(top, "feature", "left_semi")
    spread = lambda c: value_quantiles(rows, c, probabilities, by=["feature"], accuracy=accuracy).select(
        "feature", *[round_away(F.col("quantiles")[i], 6).alias(f"{c}_{n}") for i, n in enumerate(names)]
    )
    return spread("value").join(spread("contribution"), "feature")


def impact_text(impact: Column) -> Column:
    """At most four decimals, at least one."""
    return F.regexp_replace(F.format_string("%.4f", impact), r"(\.\d+?)0+$", "$1")


def report_lines(drivers: DataFrame, title: str = "Drivers of churn", sentences: DataFrame | None = None) -> DataFrame:
    """Numbered text lines of a driver ranking."""
    head = drivers.groupBy().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).cast("bigint").alias("line_no"), F.lit(title).alias("line")
    )
    arrow = F.when(F.col("direction") == "increases", "↑").otherwise("↓")
    body = drivers.select(
        F.col("place").alias("line_no"),
        F.concat(
            F.col("place").cast("string"), F.lit(". "), arrow, F.lit(" "), "feature",
            F.lit(" (impact="), impact_text(F.col("impact")), F.lit(")"),
        ).alias("line"),
    )
    out = head.unionByName(body)
    return out if sentences is None else out.unionByName(sentences)


def sentence(feature: Column, impact: Column, direction: Column) -> Column:
    return F.concat(
        card_label(feature, 60), F.lit(" "), direction, F.lit(" churn, by "), impact_text(impact), F.lit(" on average.")
    )


def insight_document(drivers: DataFrame, sentences: int = 5) -> DataFrame:
    """One row: the drivers as an array of structs and a sentence for the first of them."""
    entry = F.struct("place", "feature", "impact", "direction")
    ordered = F.array_sort(F.collect_list(entry))
    return drivers.groupBy().agg(ordered.alias("d")).select(
        F.transform("d", lambda e: F.struct(e["feature"].alias("feature"), e["impact"].alias("impact"), e["direction"].alias("direction"))).alias("top_churn_drivers"),
        F.transform(F.slice("d", 1, sentences), lambda e: sentence(e["feature"], e["impact"], e["direction"])).alias("plain_english_summary"),
    )


def aligned(names: Sequence[str], values: Column, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pair names with an array column by position."""
    paired = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), values.alias("x"))
    return rows.select(*keep, F.posexplode(paired).alias("position", "_p")).select(
        *keep, "position", F.col("_p.feature").alias("feature"), F.col("_p.x").alias("x")
    )
