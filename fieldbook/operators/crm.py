"""CRM objects: flattening, typing, cleaning, lead extraction and features."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import (
    float_ratio, is_business_mail, mail_domain, mapped, null_if_token, right_closed_bin, share_filled, text_bucket, whole_days,
)
from fieldbook.operators.ranking import latest_by, quantile_or_width_bucket, quantile_values, top_n_per_key, with_group_size
from fieldbook.session import cut_lineage

OBJECT_TYPE = (
    "id string, properties map<string,string>, "
    "associations map<string, struct<results: array<struct<id: string>>>>, "
    "archived boolean, createdAt string, updatedAt string"
)
# Order of lifecycle and deal stages; unknown stages count as 0.
LIFECYCLE_ORDER = {
    "subscriber": 1, "lead": 2, "marketingqualifiedlead": 3, "salesqualifiedlead": 4, "opportunity": 5, "customer": 6,
}
DEAL_STAGE_ORDER = {
    "appointmentscheduled": 1, "qualifiedtobuy": 2, "presentationscheduled": 3, "decisionmakerboughtin": 4,
    "contractsent": 5, "closedwon": 6, "closedlost": 0,
}
CONTACT_FIELDS = ["firstname", "lastname", "email", "phone", "company", "jobtitle"]
# Name tokens that decide a column's type.
TIME_TOKENS = {"date", "time", "createdate", "closedate", "lastmodifieddate", "lastmodified", "timestamp"}
NUMBER_TOKENS = {"amount", "revenue", "value", "count", "number", "score", "probability"}
BOOLEAN_NAMES = {"archived", "hs_is_unworked", "hs_is_closed"}
TEXT_NAMES = {"phone_number"}


def explode_pages(pages: DataFrame, text: str, max_results: int | None = None) -> DataFrame:
    """Objects of landed result pages, one row each; ``max_results`` is the caller's own limit."""
    parsed = F.from_json(text, f"results array<struct<{OBJECT_TYPE}>>")
    out = pages.select(F.explode(parsed["results"]).alias("o")).select("o.*")
    return out.limit(max_results) if max_results else out


# Object types of the service, and the properties that are asked for by default.
OBJECT_TYPES = ["contacts", "companies", "deals", "tickets", "products", "line_items", "quotes", "calls", "emails", "meetings", "notes", "tasks"]
DEFAULT_PROPERTIES = {
    "contacts": [
        "firstname", "lastname", "email", "phone", "company", "website", "jobtitle", "lifecyclestage", "lead_status", "hs_lead_status", "createdate",
        "lastmodifieddate", "hs_analytics_source", "hs_analytics_source_data_1", "hs_analytics_source_data_2", "hubspot_owner_id",
        "hubspot_owner_assigneddate", "hubspot_team_id", "hs_all_owner_ids",
    ],
    "companies": [
        "name", "domain", "industry", "phone", "city", "state", "country", "numberofemployees", "annualrevenue", "type", "website", "createdate",
        "hs_lastmodifieddate", "lifecyclestage",
    ],
    "deals": [
        "dealname", "amount", "dealstage", "pipeline", "closedate", "createdate", "hs_lastmodifieddate", "hubspot_owner_id", "dealtype",
        "hs_analytics_source", "hs_deal_stage_probability",
    ],
    "tickets": [
        "subject", "content", "hs_pipeline", "hs_pipeline_stage", "hs_ticket_priority", "hs_ticket_category", "hs_ticket_id", "createdate",
        "hs_lastmodifieddate", "hubspot_owner_id",
    ],
}


def typed_objects(pages: DataFrame, text: str, kind: str, order: str, lists: dict[str, Sequence[str]] | None = None, max_results: int | None = None) -> DataFrame:
    """Objects of pages of mixed types in one pass, each with the properties its type's list names and the others apart.

    ``kind`` names the column with the object type, ``order`` the one that orders pages. ``listed`` holds every property of the
    list (null where the object lacks it), ``others`` what the list does not name; a type without a list keeps all there, and
    ``is_known_type`` tells types that the service does not have. ``max_results`` bounds the objects of each type, first pages
    first.
    """
    lists = DEFAULT_PROPERTIES if lists is None else lists
    parsed = F.from_json(text, f"results array<struct<{OBJECT_TYPE}>>")
    out = pages.select(F.col(kind).alias("object_type"), F.col(order).alias("_page"), F.posexplode(parsed["results"]).alias("_position", "o"))
    out = out.select("object_type", "_page", "_position", "o.*")
    if max_results:
        out = top_n_per_key(out, ["object_type"], [F.col("_page"), F.col("_position")], max_results).drop("rank")
    names = F.create_map(*[x for t, ps in lists.items() for x in (F.lit(t), F.array(*[F.lit(p) for p in ps]))])
    own = F.coalesce(names[F.col("object_type")], F.array().cast("array<string>"))
    have = F.coalesce(F.col("properties"), F.create_map().cast("map<string,string>"))
    out = out.withColumns({"_own": own, "properties": have})
    return out.withColumns(
        {
            "listed": F.map_from_arrays("_own", F.transform("_own", lambda p: F.col("properties")[p])),
            "others": F.map_filter("properties", lambda p, _: ~F.array_contains("_own", p)),
            "is_known_type": F.col("object_type").isin(OBJECT_TYPES),
        }
    ).drop("_own", "properties", "_page", "_position")


def objects_of_type(objects: DataFrame, kind: str, lists: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One column for each listed property of one type; the other properties stay a map."""
    names = (DEFAULT_PROPERTIES if lists is None else lists).get(kind, [])
    rest = [c for c in objects.columns if c not in ("listed", "object_type", "is_known_type")]
    return objects.where(F.col("object_type") == kind).select(*rest, *[F.col("listed")[n].alias(n) for n in names])


def modified_since(objects: DataFrame, column: str, last_success: dt.datetime | None, as_of: dt.datetime) -> DataFrame:
    """Objects changed since the last successful run, or in the last seven days without one."""
    since = last_success or as_of - dt.timedelta(days=7)
    return objects.where(F.col(column) >= F.lit(since))


def flatten_objects(objects: DataFrame, kind: str, properties: Sequence[str], links: Sequence[str]) -> DataFrame:
    """One column per property; for each link type its JSON, its count and its first five ids."""
    cols = [F.col("id"), F.lit(kind).alias("object_type")]
    cols += [F.col("properties").getItem(p).alias(p) for p in properties]
    for link in links:
        results = F.col("associations").getItem(link)["results"]
        ids = F.slice(F.transform(results, lambda r: r["id"]), 1, 5)
        cols += [
            F.to_json(results).alias(f"{link}_associations"),
            F.coalesce(F.size(results), F.lit(0)).alias(f"{link}_count"),
            F.array_join(ids, ",").alias(f"{link}_ids"),
        ]
    return objects.select(*cols, "archived", F.col("createdAt").alias("created_at"), F.col("updatedAt").alias("updated_at"))


def value_kind(text: Column) -> Column:
    """Kind of one property text: empty, boolean, integer, number, json or string."""
    t = F.trim(text)
    return (
        F.when(text.isNull() | (t == ""), "empty")
        .when(F.lower(t).isin("true", "false"), "boolean")
        .when(t.rlike(r"^-?\d+$"), "integer")
        .when(t.rlike(r"^-?\d*\.\d+$"), "number")
        .when(t.rlike(r"^[\[{]") & F.try_parse_json(t).isNotNull(), "json")
        .otherwise("string")
    )


def epoch_millis(text: Column) -> Column:
    return F.timestamp_millis(text.try_cast("bigint"))


def type_of_name(name: str) -> str:
    """Type a column gets from its name; whole name tokens are compared, so ``country`` is no count."""
    tokens = set(name.lower().split("_"))
    if name.lower() == "id" or "id" in tokens or name.lower() in TEXT_NAMES:
        return "string"
    if tokens & TIME_TOKENS:
        return "timestamp"
    if "bool" in tokens or name.lower() in BOOLEAN_NAMES:
        return "boolean"
    if tokens & NUMBER_TOKENS:
        return "double"
    return "string"


def apply_types(df: DataFrame) -> DataFrame:
    """Cast every text column by its name; values that do not fit become null."""
    out = []
    for f in df.schema.fields:
        col, want = F.col(f.name), type_of_name(f.name)
        if f.dataType.simpleString() != "string" or want == "string":
            out.append(col)
        elif want == "timestamp":
            millis = F.when(col.rlike(r"^\d{11,}$"), epoch_millis(col))
            out.append(F.coalesce(millis, F.try_to_timestamp(col)).alias(f.name))
        else:
            out.append(col.try_cast(want).alias(f.name))
    return df.select(*out)


def add_load_metadata(df: DataFrame, as_of: dt.datetime, source: str, version: str = "1.0") -> DataFrame:
    return df.withColumns(
        {"etl_loaded_at": F.lit(as_of), "etl_source": F.lit(source), "etl_version": F.lit(version)}
    )


def warehouse_ready(df: DataFrame) -> DataFrame:
    """Null tokens to null, times to text, upper-case column names."""
    out = []
    for f in df.schema.fields:
        kind, col = f.dataType.simpleString(), F.col(f.name)
        if kind == "string":
            col = null_if_token(col)
        elif kind in ("timestamp", "timestamp_ntz"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(f.name.upper()))
    return df.select(*out)


# Lead extract -----------------------------------------------------------------------------------


def join_companies(contacts: DataFrame, companies: DataFrame) -> DataFrame:
    """Company columns by company name; a repeated name contributes its lowest id, so contacts never multiply."""
    rest = [c for c in companies.columns if c != "company_name"]
    one = companies.groupBy("company_name").agg(F.min_by(F.struct(*rest), F.col("company_id")).alias("_c"))
    one = one.select("company_name", *[F.col(f"_c.{c}").alias(c) for c in rest])
    return contacts.join(one, contacts["company"] == one["company_name"], "left")


def owner_summary(deals: DataFrame) -> DataFrame:
    return deals.groupBy("owner_id").agg(
        F.count("deal_id").alias("total_deals"),
        F.sum("amount").alias("total_deal_value"),
        F.avg("amount").alias("avg_deal_value"),
        F.max("amount").alias("max_deal_value"),
        F.avg("stage_probability").alias("avg_deal_probability"),
    )


def owner_of_company(company: Column, owners: Sequence[str]) -> Column:
    """A stable owner for contacts without one, from the company name; the first owner without a name."""
    bucket = text_bucket(F.lower(company), len(owners))
    return F.when(company.isNull(), owners[0]).otherwise(F.get(F.array(*[F.lit(o) for o in owners]), bucket))


def join_owner_summary(contacts: DataFrame, deals: DataFrame) -> DataFrame:
    """Deal figures of each contact's owner; contacts without deals get zeros.

    Owners are few and contacts many, so an owner may hold a large part of all contacts; the
    summary side is a handful of rows, which the planner broadcasts by its measured size.
    """
    summary = owner_summary(deals)
    figures = [c for c in summary.columns if c != "owner_id"]
    return contacts.join(summary, "owner_id", "left").fillna(0, subset=figures)


def lead_extract(
    contacts: DataFrame, deals: DataFrame, companies: DataFrame, owners: Sequence[str], as_of: dt.datetime | None = None,
    days_back: int | None = None,
) -> DataFrame:
    """Contacts with an email, their company and their owner's deal figures."""
    out = contacts.where(F.col("email").isNotNull())
    if days_back is not None:
        out = out.where(F.col("createdate") >= F.lit(as_of - dt.timedelta(days=days_back)))
    if "owner_id" not in out.columns:
        out = out.withColumn("owner_id", owner_of_company(F.col("company"), owners))
    return join_companies(join_owner_summary(out, deals), companies)


# Features ---------------------------------------------------------------------------------------

SIZE_EDGES = [0, 10, 50, 200, 1000, None]
SIZE_LABELS = ["Micro", "Small", "Medium", "Large", "Enterprise"]
REVENUE_EDGES = [0, 100000, 1000000, 10000000, 100000000, None]
REVENUE_LABELS = ["Startup", "Small", "Medium", "Large", "Enterprise"]


def time_features(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Ages in whole days and calendar parts; the source columns stay for later rules."""
    now = F.lit(as_of).cast("timestamp")
    created, modified = F.col("createdate").cast("timestamp"), F.col("lastmodifieddate").cast("timestamp")
    return df.withColumns(
        {
            "days_since_created": whole_days(now, created),
            "created_month": F.month(created),
            "created_quarter": F.quarter(created),
            "created_weekday": F.weekday(created),
            "days_since_modified": whole_days(now, modified),
            "days_created_to_modified": whole_days(modified, created),
        }
    )


def engagement_features(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "email_domain": mail_domain(F.col("email")),
            "is_business_email": is_business_mail(F.col("email")),
            "has_lead_source": F.col("leadsource").isNotNull(),
        }
    )
    return with_group_size(out, "email_domain", "email_domain_frequency")


def company_features(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "company_size_category": right_closed_bin(F.coalesce("company_size", F.lit(0)), SIZE_EDGES, SIZE_LABELS),
            "company_revenue_category": right_closed_bin(F.coalesce("company_revenue", F.lit(0.0)), REVENUE_EDGES, REVENUE_LABELS),
            "has_industry": F.col("company_industry").isNotNull(),
        }
    )
    return with_group_size(out, "company_industry", "industry_frequency").fillna(0, subset=["industry_frequency"])


def contact_features(df: DataFrame) -> DataFrame:
    email, phone = F.col("email").isNotNull(), F.col("phone").isNotNull()
    return df.withColumns(
        {
            "completeness_score": share_filled(CONTACT_FIELDS),
            "has_email": email,
            "has_phone": phone,
            "has_both_contact": email & phone,
            "has_full_name": F.col("firstname").isNotNull() & F.col("lastname").isNotNull(),
        }
    )


def above_quantile(df: DataFrame, value: str, q: float, out: str) -> DataFrame:
    """Flag values above the exact quantile of the column."""
    edges = quantile_values(df, value, [q])
    return df.withColumn(out, F.col(value) > (F.lit(edges[0]) if edges else F.lit(None).cast("double")))


def behaviour_features(df: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "lifecycle_stage_order": mapped(F.col("lifecyclestage"), LIFECYCLE_ORDER, 0),
            "is_deal_creator": F.col("total_deals") > 0,
        }
    )
    return above_quantile(out, "max_deal_value", 0.75, "high_value_deals")


def lead_features(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    out = contact_features(company_features(engagement_features(time_features(df, as_of))))
    return behaviour_features(out)


def conversion_target(stage: Column, deals: Column | None = None) -> Column:
    """1 for customers and opportunities; without a stage column, 1 for owners of deals."""
    if stage is not None:
        return F.coalesce(F.lower(stage).isin("customer", "opportunity"), F.lit(False)).cast("int")
    return (deals > 0).cast("int") if deals is not None else F.lit(0)


def churn_features(df: DataFrame, threshold_days: int = 90) -> DataFrame:
    inactive = F.col("days_since_modified")
    created = F.col("days_since_created")
    return df.withColumns(
        {
            "days_since_last_activity": inactive,
            "activity_frequency": float_ratio(created, inactive + 1),  # a change on the day after the clock divides by 0
            "has_recent_deals": (F.col("total_deals") > 0).cast("int"),
            "deal_momentum": float_ratio(F.col("total_deals"), created + 1) * 365,
            "early_stage_risk": (F.col("lifecycle_stage_order") <= 2).cast("int"),
            "communication_channels": F.col("has_email").cast("int") + F.col("has_phone").cast("int"),
            "engagement_quality": (F.col("completeness_score") + F.col("is_business_email").cast("double")) / 2,
            "account_age_months": created / 30,
            "inactivity_risk": F.when(inactive > threshold_days, 1.0).otherwise(inactive / threshold_days),
        }
    )


def churn_target(df: DataFrame, threshold_days: int = 90) -> DataFrame:
    """Churned when inactive beyond the threshold, or when both further indicators hold."""
    no_deals = (F.col("total_deals") == 0).cast("int")
    low = (F.col("engagement_quality") < 0.3).cast("int")
    churned = (F.col("days_since_last_activity") > threshold_days) | (no_deals + low >= 2)
    return df.withColumns({"no_recent_deals": no_deals, "low_engagement": low, "churned": churned.cast("int")})


def segmentation_features(df: DataFrame) -> DataFrame:
    """Scores in 0..5 or 0..1 used for clustering. The input is read several times, so it is stored first."""
    df = cut_lineage(df)
    flags = ["has_email", "has_phone", "has_full_name", "is_business_email"]
    engagement = sum((F.col(c).cast("int") for c in flags), F.lit(0)) / len(flags)
    out = df.withColumns(
        {
            "engagement_score": engagement,
            "_size": F.coalesce("company_size", F.lit(0)).cast("double"),
            "_revenue": F.coalesce("company_revenue", F.lit(0.0)),
            "_deals": F.coalesce("total_deals", F.lit(0)).cast("double"),
        }
    )
    out = quantile_or_width_bucket(out, "_size", "company_size_score", [1, 2, 3, 4, 5])
    out = quantile_or_width_bucket(out, "_revenue", "company_revenue_score", [1, 2, 3, 4, 5])
    if out.select("_deals").distinct().limit(6).count() > 5:
        out = quantile_or_width_bucket(out, "_deals", "deal_activity_score", [0, 1, 2, 3, 4])
    else:
        out = out.withColumn("deal_activity_score", (F.col("_deals") > 0).cast("double") * 2)
    tops = df.agg(F.struct(F.max("days_since_created").alias("days"), F.max("lifecycle_stage_order").alias("stage")).alias("m"))
    out = out.withColumn("_m", tops.scalar())
    days, stage = F.col("_m.days"), F.col("_m.stage")
    return out.withColumns(
        {
            "company_maturity_score": (F.col("company_size_score") + F.col("company_revenue_score")) / 2,
            "recency_score": F.when(days > 0, 1 - F.col("days_since_created") / days),
            "lifecycle_score": F.when(stage > 0, F.col("lifecycle_stage_order") / stage).otherwise(0.0),
        }
    ).drop("_size", "_revenue", "_deals", "_m")


# Deals ------------------------------------------------------------------------------------------


def deal_features(deals: DataFrame, as_of: dt.datetime) -> DataFrame:
    now = F.lit(as_of).cast("timestamp")
    created = F.col("createdate").cast("timestamp")
    age = whole_days(now, created)
    return deals.where(F.col("amount") > 0).withColumns(
        {
            "days_since_created": age,
            "days_to_close": whole_days(F.col("closedate").cast("timestamp"), created),
            "deal_size_category": right_closed_bin(
                F.col("amount"), [0, 1000, 5000, 25000, 100000, None], ["Micro", "Small", "Medium", "Large", "Enterprise"]
            ),
            "stage_order": mapped(F.col("dealstage"), DEAL_STAGE_ORDER, 0),
            "high_probability": F.col("stage_probability") > 0.7,
            "created_month": F.month(created),
            "created_quarter": F.quarter(created),
            "created_weekday": F.weekday(created),
            "deal_velocity": float_ratio(F.col("amount"), age + 1),
            "is_won": (F.col("dealstage") == "closedwon").cast("int"),
        }
    )


def deal_patterns(features: DataFrame) -> DataFrame:
    """Count, mean and total amount, mean days to close and win rate: overall and by month, size, stage.

    One scan with grouping sets; ``dimension`` names the grouping, ``member`` its value.
    """
    keys = ["created_month", "deal_size_category", "stage_order"]
    sets = [[], *[[F.col(k)] for k in keys]]
    out = features.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("_g"),
        F.count(F.lit(1)).alias("deals"),
        F.avg("amount").alias("avg_amount"),
        F.sum("amount").alias("total_amount"),
        F.avg("days_to_close").alias("avg_days_to_close"),
        F.avg("is_won").alias("win_rate"),
    )
    g = F.col("_g")
    name = F.when(g == 7, "overall").when(g == 3, "month").when(g == 5, "size").otherwise("stage")
    member = F.when(g == 3, F.col("created_month").cast("string")).when(g == 5, F.col("deal_size_category")).when(
        g == 6, F.col("stage_order").cast("string")
    )
    return out.select(name.alias("dimension"), member.alias("member"), *[c for c in out.columns if c not in (*keys, "_g")])


def best_months(patterns: DataFrame) -> DataFrame:
    """Best month by count and by value, and the fastest month; the earlier month wins ties."""
    months = patterns.where("dimension = 'month'").withColumn("m", F.col("member").cast("int"))
    return months.agg(
        F.max_by("m", F.struct("deals", -F.col("m"))).alias("best_month_volume"),
        F.max_by("m", F.struct("total_amount", -F.col("m"))).alias("best_month_value"),
        F.min_by("m", F.struct("avg_days_to_close", F.col("m"))).alias("fastest_month"),
    )


def revenue_forecast(deals: DataFrame, as_of: dt.datetime, months: int = 6, confidence: float = 0.95) -> DataFrame:
    """Expected revenue of open deals per calendar month, with bounds.

    Needs amount, closure_probability and estimated_close. Deals are aggregated by month first; the
    month list only fills the gaps, so no range join is involved.
    """
    factor = 1.96 if confidence == 0.95 else 1.645
    first = dt.date(as_of.year, as_of.month, 1)
    month = F.trunc(F.col("estimated_close").cast("date"), "month").alias("month")
    weighted = F.col("amount") * F.col("closure_probability")
    per = deals.groupBy(month).agg(
        F.sum(weighted).alias("forecasted_revenue"), F.stddev_samp(weighted).alias("_std"),
        F.count(F.lit(1)).alias("deal_count"), F.avg("amount").alias("avg_deal_size"),
    )
    spine = deals.sparkSession.range(months).select(F.add_months(F.lit(first), F.col("id").cast("int")).alias("month"))
    out = spine.join(per, "month", "left").fillna(0, subset=["forecasted_revenue", "deal_count", "avg_deal_size"])
    margin = F.coalesce("_std", F.lit(0.0)) * factor
    return out.withColumns(
        {
            "lower_bound": F.greatest(F.lit(0.0), F.col("forecasted_revenue") - margin),
            "upper_bound": F.col("forecasted_revenue") + margin,
        }
    ).drop("_std")


def fallback_forecast(deals: DataFrame, as_of: dt.datetime, months: int = 6) -> DataFrame:
    """Without predictions: deals are dealt evenly over the months by a hash of their id, at a 30 % close rate."""
    slot = text_bucket(F.col("deal_id").cast("string"), months)
    first = dt.date(as_of.year, as_of.month, 1)
    per = deals.groupBy(F.add_months(F.lit(first), slot).alias("month")).agg(
        (F.sum("amount") * 0.3).alias("forecasted_revenue"), F.count(F.lit(1)).alias("deal_count"),
        F.avg("amount").alias("avg_deal_size"),
    )
    r = F.col("forecasted_revenue")
    return per.withColumns({"lower_bound": r * 0.7, "upper_bound": r * 1.3})


def newest_objects(df: DataFrame, key: str, updated: str) -> DataFrame:
    """One row per object, the last modified one."""
    rest = [c for c in df.columns if c not in (key, updated)]
    return latest_by(df, [key], [updated, *rest])
