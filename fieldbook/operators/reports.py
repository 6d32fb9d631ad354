"""Scores with ranks and categories, insight tables, segment profiles and reports as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import right_closed_bin
from fieldbook.operators.ranking import decile, dense_rank_desc, exact_quantiles, quantile_bucket, quantile_values, top_n, top_n_per_key

SCORE_EDGES = [0, 0.3, 0.6, 0.8, 1.0]


def score_category(score: Column) -> Column:
    return right_closed_bin(score, SCORE_EDGES, ["Low", "Medium", "High", "Very High"])


def risk_category(score: Column) -> Column:
    return right_closed_bin(score, SCORE_EDGES, ["Low", "Medium", "High", "Critical"])


def rank_leads(scored: DataFrame, score: str = "lead_score") -> DataFrame:
    """Decile 1–10, dense rank (1 = best) and category of a lead score."""
    out = dense_rank_desc(decile(scored, score, "score_decile"), score, "lead_rank")
    return out.withColumn("score_category", score_category(F.col(score)))


def rank_churn(scored: DataFrame, score: str = "churn_risk_score") -> DataFrame:
    """Risk category, equal-frequency percentile bucket and attention flags.

    Ten buckets, or at most three when fewer than ten distinct scores exist.
    """
    distinct = scored.select(score).distinct().limit(10).count()
    q = 10 if distinct >= 10 else max(1, min(distinct, 3))
    out = quantile_bucket(scored, score, q, "churn_risk_percentile")
    return out.withColumns(
        {
            "churn_risk_category": risk_category(F.col(score)),
            "high_churn_risk": (F.col(score) > 0.7).cast("int"),
            "immediate_attention": (F.col(score) > 0.8).cast("int"),
        }
    )


def top_scored(scored: DataFrame, score: str, key: str, n: int, minimum: float) -> DataFrame:
    return top_n(scored.where(F.col(score) >= minimum), [F.desc(score), F.col(key)], n)


def mean_by(scored: DataFrame, dimension: str, score: str, n: int = 5) -> DataFrame:
    """The n members of a dimension with the highest mean score."""
    means = scored.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("member")).agg(F.avg(score).alias("mean_score"))
    return top_n(means, [F.desc(F.round("mean_score", 9)), F.col("member")], n)


def lead_insights(scored: DataFrame, score: str = "lead_score") -> DataFrame:
    """Totals, mean, high-score count and rates among high scorers; one pass."""
    s = F.col(score)
    high = s > 0.7
    return scored.agg(
        F.count(F.lit(1)).alias("total_leads"),
        F.avg(s).alias("average_score"),
        F.count_if(high).alias("high_quality_leads"),
        F.avg(F.when(high, F.col("completeness_score"))).alias("avg_completeness"),
        F.avg(F.when(high, F.col("is_business_email").cast("double"))).alias("business_email_rate"),
        F.avg(F.when(high, F.col("has_phone").cast("double"))).alias("has_phone_rate"),
    )


def churn_summary(scored: DataFrame, score: str = "churn_risk_score") -> DataFrame:
    s = F.col(score)
    return scored.agg(
        F.count(F.lit(1)).alias("total_customers"), F.avg(s).alias("avg_risk_score"),
        F.count_if(s > 0.7).alias("high_risk_count"), F.count_if(s > 0.8).alias("critical_risk_count"),
    )


def churn_by_month(scored: DataFrame, created: str, score: str = "churn_risk_score") -> DataFrame:
    month = F.date_format(F.trunc(F.col(created).cast("date"), "month"), "yyyy-MM").alias("month")
    return scored.groupBy(month).agg(F.avg(score).alias("avg_risk"), F.count(F.lit(1)).alias("customers"))


def value_counts(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("customers"))


def score_distribution(scored: DataFrame, score: str) -> DataFrame:
    """Count, mean, exact median, range, and counts per score band (0–100 scale)."""
    s = F.col(score)
    one = scored.agg(
        F.count(s).alias("total"), F.avg(s).alias("mean"), F.max(s).alias("highest"), F.min(s).alias("lowest"),
        F.count_if(s >= 80).alias("high"), F.count_if((s >= 50) & (s < 80)).alias("medium"), F.count_if(s < 50).alias("low"),
    )
    return one.withColumn("median", F.lit((quantile_values(scored, score, [0.5]) or [None])[0]).cast("double"))


def segment_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumn("_n", total).withColumn("percentage", F.col("size") / F.col("_n") * 100).drop("_n")


def segment_features(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean, exact median and deviation of every feature per segment, in long form."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    long = df.select(cluster, F.inline(pairs))
    stats = long.groupBy(cluster, "feature").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    medians = exact_quantiles(long, "value", {"median": 0.5}, [cluster, "feature"])
    return stats.join(medians, [cluster, "feature"], "left")


def segment_shares(df: DataFrame, column: str, n: int = 5, cluster: str = "cluster") -> DataFrame:
    """The n most frequent values of a column per segment, as shares of the segment's filled rows.

    Totals come from the counts, not from a window over the rows of a segment.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(cluster, F.col(column).alias("member")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(cluster).agg(F.sum("n").alias("_total"))
    shares = counts.join(totals, cluster).withColumn("share", F.col("n") / F.col("_total")).drop("_total")
    return top_n_per_key(shares, [cluster], [F.desc("n"), F.col("member")], n)


def segment_business(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(
        F.avg("total_deals").alias("avg_deals"),
        (F.avg((F.col("total_deals") > 0).cast("double")) * 100).alias("deal_creators_pct"),
        F.avg("total_deal_value").alias("avg_deal_value"),
        F.avg("company_size").alias("avg_company_size"),
        (F.avg("converted") * 100).alias("conversion_rate"),
    )


def as_rows(section: str, one_row: DataFrame) -> DataFrame:
    """(section, key, value) rows of a one-row table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in one_row.columns])
    return one_row.select(F.lit(section).alias("section"), F.inline(pairs))


def counts_as_rows(section: str, counts: DataFrame, key: str, value: str) -> DataFrame:
    return counts.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def recommendation_report(recommended: DataFrame) -> DataFrame:
    """Report rows: totals, priorities and strategies, from one pass per grouping."""
    totals = recommended.agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if(F.col("priority") != "low").alias("requiring_action")
    )
    priorities = recommended.groupBy("priority").agg(F.count(F.lit(1)).alias("n"))
    strategies = top_n(
        recommended.groupBy("primary_strategy").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.col("primary_strategy")], 5
    )
    return (
        as_rows("summary", totals)
        .unionByName(counts_as_rows("priority", priorities, "priority", "n"))
        .unionByName(counts_as_rows("strategy", strategies, "primary_strategy", "n"))
    )


def churn_report(scored: DataFrame, key: str, score: str = "churn_risk_score", importance: DataFrame | None = None, n: int = 5) -> DataFrame:
    """Report rows: summary, customers and shares by risk, the customers most at risk, and the factors that weigh most where given."""
    total = scored.agg(F.count(F.lit(1)).alias("_n")).scalar()
    risks = scored.groupBy(risk_category(F.col(score)).alias("category")).agg(F.count(F.lit(1)).alias("n")).where(F.col("category").isNotNull())
    risks = risks.withColumn("percentage", F.col("n") / total * 100)
    worst = top_n(scored.select(key, score), [F.desc(score), F.col(key)], n)
    out = (
        as_rows("summary", churn_summary(scored, score))
        .unionByName(counts_as_rows("risk_distribution", risks, "category", "n"))
        .unionByName(counts_as_rows("risk_percentage", risks, "category", "percentage"))
        .unionByName(counts_as_rows("top_at_risk", worst, key, score))
    )
    if importance is None:
        return out
    return out.unionByName(counts_as_rows("risk_factors", top_n(importance, [F.desc("importance"), F.col("feature")], n), "feature", "importance"))


def segment_report(df: DataFrame, scores: Sequence[str], business: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Report rows, a section for each segment: size, share, mean scores and business figures."""
    means = df.groupBy(cluster).agg(*[F.avg(c).alias(f"avg_{c}") for c in scores])
    one = segment_sizes(df, cluster).join(means, cluster).join(business, cluster)
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in one.columns if c != cluster])
    return one.select(F.col(cluster).cast("string").alias("section"), F.inline(pairs))


def model_rows(metrics: DataFrame, name: str) -> DataFrame:
    """Report rows of trained models: a section for each, a row for each figure."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in metrics.columns if c != name])
    return metrics.select(F.col(name).alias("section"), F.inline(pairs))


def analytics_report(metrics: DataFrame, forecast: DataFrame) -> DataFrame:
    """Report rows of deal models (``model`` and its figures) and of the revenue forecast."""
    total = F.coalesce(F.sum("forecasted_revenue"), F.lit(0.0))
    one = forecast.agg(
        F.count(F.lit(1)).alias("months"), total.alias("total_forecasted_revenue"), (total / F.count(F.lit(1))).alias("average_monthly_revenue")
    )
    return model_rows(metrics, "model").unionByName(as_rows("forecast", one))


def training_report(best: DataFrame, sessions: DataFrame) -> DataFrame:
    """Report rows of a training session: its overall grade, the best model of each family, and every model that was trained."""
    overall = best.agg(F.avg("grade").alias("overall_score"), F.count(F.lit(1)).alias("families"))
    families = model_rows(best.select(F.concat_ws(": ", "family", "model").alias("name"), "metric", "grade"), "name")
    each = counts_as_rows("trained", sessions.withColumn("name", F.concat_ws(": ", "family", "model")), "name", "metric")
    return as_rows("session", overall).unionByName(families).unionByName(each)
