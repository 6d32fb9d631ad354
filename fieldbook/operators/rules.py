"""Qualification, segments, recommendations and priorities as column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match, hashed_fraction, mapped, whole_days
from fieldbook.operators.ranking import global_rank, top_n, top_n_per_key

# Words that mark agricultural companies and land owners.
FARM_WORDS = [
    "farm", "farming", "ranch", "ranching", "agriculture", "agricultural", "livestock", "cattle", "dairy", "crop",
    "crops", "grain", "wheat", "corn", "soybean", "cotton", "hay", "pasture", "feedlot", "agri", "rural", "country",
    "acreage", "acres", "land", "soil", "harvest", "plantation", "orchard", "vineyard", "greenhouse", "nursery",
]
OWNER_WORDS = [
    "landowner", "land owner", "property owner", "farm owner", "ranch owner", "estate", "holdings", "properties",
    "real estate", "development", "investment", "trust", "family farm", "generations",
]
# Agricultural weight of states, 5–10.
STATE_WEIGHTS = {
    "IA": 10, "IL": 10, "NE": 10, "IN": 9, "OH": 9, "MN": 9, "KS": 8, "MO": 8, "WI": 8, "MI": 8, "TX": 7, "CA": 7,
    "PA": 7, "NY": 6, "ND": 9, "SD": 9, "OK": 6, "AR": 6, "KY": 6, "TN": 6, "NC": 6, "GA": 6, "FL": 5, "AL": 6,
    "MS": 6, "LA": 6, "SC": 6, "VA": 6, "WV": 5, "MD": 5,
}
RURAL_WORDS = ["farm", "rural", "county", "valley", "plains", "prairie"]
FARM_MAIL = ["@farm", "@ranch", "@agri", "@land"]
CONSUMER_MAIL = ["gmail.", "yahoo.", "hotmail.", "outlook."]
LEADER_TITLES = ["owner", "president", "ceo", "founder"]
FARM_INDUSTRIES = ["agriculture", "farming", "food", "livestock"]
PASS_MARKS = {"ownership": 30, "business": 25, "timing": 20, "region": 30}
RULE_WEIGHTS = {"ownership": 0.4, "business": 0.3, "timing": 0.2, "region": 0.1}
TIER_FACTORS = {"Premium": 1.3, "High": 1.1, "Medium": 1.0, "Low": 0.8, "Disqualified": 0.0}
DEDUCTION_PER_ACRE = 1125.0
TAX_RATE = 0.35
FEE_RATE = 0.125
SEGMENT_PRIORITY = {
    "Enterprise Landowners": 10, "Premium Agricultural Clients": 9, "Active Farmers": 8, "Agricultural Investors": 7,
    "Potential Agricultural Prospects": 5, "Low-Priority Agricultural Leads": 3, "Unqualified": 1, "Disqualified": 0,
}


def _text(name: str) -> Column:
    return F.lower(F.coalesce(F.col(name), F.lit("")))


def _hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the words occur in the text."""
    return sum((text.contains(w).cast("int") for w in words), F.lit(0))


def _any(text: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def _points(cond: Column, n: int) -> Column:
    return F.when(cond, n).otherwise(0)


def ownership_score() -> Column:
    company, mail, title = _text("company"), _text("email"), _text("jobtitle")
    return (
        _hits(company, OWNER_WORDS) * 30 + _points(_any(mail, FARM_MAIL), 25) + _points(~_any(mail, CONSUMER_MAIL), 15)
        + _points(_any(title, LEADER_TITLES), 20)
    )


def business_score() -> Column:
    size = F.coalesce(F.col("company_size"), F.lit(0))
    return (
        F.least(_hits(_text("company"), FARM_WORDS) * 15, F.lit(50))
        + _points(_any(_text("company_industry"), FARM_INDUSTRIES), 40) + _points(size > 10, 15)
    )


def timing_score(as_of: dt.datetime) -> Column:
    """By years since the contact was created; an unknown date counts as moderate."""
    years = whole_days(F.lit(as_of).cast("timestamp"), F.col("createdate").cast("timestamp")) / 365.25
    return first_match([(F.col("createdate").isNull(), 30), (years <= 1, 50), (years <= 2, 35), (years <= 3, 20)], 5)


def region_score() -> Column:
    weight = mapped(F.upper(F.coalesce(F.col("company_state"), F.lit(""))), STATE_WEIGHTS, 0)
    raw = weight * 10 + _points(_any(_text("company_city"), RURAL_WORDS), 20)
    return F.when(raw == 0, 40).otherwise(raw)


def qualify(leads: DataFrame, as_of: dt.datetime, seed: Column | None = None) -> DataFrame:
    """Rule scores, eligibility, confidence, tier, estimated value and the final score of each lead.

    ``seed`` is a number in [0, 1) per row in place of a random draw; by default a hash of the id.
    """
    raw = {"ownership": ownership_score(), "business": business_score(), "timing": timing_score(as_of), "region": region_score()}
    out = leads.withColumns({f"_{n}": c for n, c in raw.items()})
    eligible = F.lit(True)
    for n, mark in PASS_MARKS.items():
        eligible = eligible & (F.col(f"_{n}") >= mark)
    out = out.withColumns({f"{n}_score": F.least(F.col(f"_{n}"), F.lit(100)) for n in raw} | {"eligible": eligible})
    mean = sum((F.col(f"{n}_score") for n in raw), F.lit(0)) / 4
    confidence = sum((F.col(f"{n}_score") / 100 * w for n, w in RULE_WEIGHTS.items()), F.lit(0.0))
    tier = first_match([(mean >= 80, "Premium"), (mean >= 60, "High"), (mean >= 40, "Medium"), (mean >= 20, "Low")], "Disqualified")
    size, revenue = F.coalesce("company_size", F.lit(0)), F.coalesce("company_revenue", F.lit(0.0))
    base = first_match(
        [
            (revenue > 10000000, 1000), (revenue > 5000000, 600), (revenue > 1000000, 300), (size > 100, 500), (size > 50, 300),
            (size > 20, 200),
        ],
        100,
    )
    draw = seed if seed is not None else hashed_fraction(F.col("contact_id"))
    out = out.withColumns({"_mean": mean, "confidence_score": confidence, "qualification_tier": tier})
    out = out.withColumn("estimated_acres", F.greatest(F.lit(50.0), base * (F.lit(0.7) + F.lit(0.8) * draw)))
    deduction = mapped(F.col("qualification_tier"), TIER_FACTORS, 1.0) * DEDUCTION_PER_ACRE
    out = out.withColumn("estimated_tax_savings", F.col("estimated_acres") * deduction * TAX_RATE)
    savings = F.col("estimated_tax_savings")
    score = F.col("_mean") * 0.6 + F.least(F.lit(100.0), savings / 50000 * 100) * 0.4
    return out.withColumns(
        {
            "service_revenue_potential": savings * FEE_RATE,
            "value_tier": first_match(
                [(savings >= 100000, "Enterprise"), (savings >= 50000, "High-Value"), (savings >= 20000, "Medium-Value"), (savings >= 5000, "Standard")],
                "Low-Value",
            ),
            "qualification_score": F.when(F.col("eligible"), score).otherwise(0.0),
        }
    ).drop("_mean", *[f"_{n}" for n in raw])


def indicators() -> Column:
    """The reasons behind a lead's ownership and business scores, as texts."""
    company, mail = _text("company"), _text("email")
    found = [F.when(company.contains(w), F.lit(f"Company name contains '{w}'")) for w in OWNER_WORDS]
    found += [
        F.when(_any(mail, FARM_MAIL), F.lit("Email domain suggests agricultural/land business")),
        F.when(~_any(mail, CONSUMER_MAIL), F.lit("Business email address")),
        F.when(_any(_text("jobtitle"), LEADER_TITLES), F.lit("Executive/ownership role")),
    ]
    return F.array_compact(F.array(*found))


def rule_indicators(as_of: dt.datetime) -> dict[str, Column]:
    """The reasons behind each of the four scores, one array of texts for each rule."""
    size, company = F.coalesce(F.col("company_size"), F.lit(0)), _text("company")
    state = F.upper(F.coalesce(F.col("company_state"), F.lit("")))
    weight, terms = mapped(state, STATE_WEIGHTS, 0), _hits(company, FARM_WORDS)
    years = whole_days(F.lit(as_of).cast("timestamp"), F.col("createdate").cast("timestamp")) / 365.25
    listed = lambda *found: F.array_compact(F.array(*found))
    business = listed(
        F.when(terms > 0, F.concat(F.lit("Company name contains "), terms.cast("string"), F.lit(" agricultural terms"))),
        F.when(_any(_text("company_industry"), FARM_INDUSTRIES), F.lit("Industry classified as agricultural")),
        F.when(size > 10, F.lit("Substantial company size")),
    )
    timing = first_match(
        [
            (F.col("createdate").isNull(), "No timing data available - assuming moderate eligibility"),
            (years <= 1, "Very recent contact creation (likely recent acquisition)"), (years <= 2, "Recent contact creation"),
            (years <= 3, "Moderately recent contact"),
        ],
        "Older contact",
    )
    region = listed(
        F.when(state.isin(list(STATE_WEIGHTS)), F.concat(F.lit("Located in agricultural state "), state, F.lit(" (score: "), weight.cast("string"), F.lit("/10)"))),
        F.when(_any(_text("company_city"), RURAL_WORDS), F.lit("City name suggests rural/agricultural area")),
    )
    unknown = F.array(F.lit("Location unknown - assuming moderate agricultural potential"))
    return {"ownership": indicators(), "business": business, "timing": F.array(timing), "region": F.when(F.size(region) > 0, region).otherwise(unknown)}


def assign_segment(df: DataFrame) -> DataFrame:
    tier, value, savings = F.col("qualification_tier"), F.col("value_tier"), F.col("estimated_tax_savings")
    segment = first_match(
        [
            (~F.col("eligible") | (tier == "Disqualified"), "Disqualified"),
            ((value == "Enterprise") & tier.isin("Premium", "High"), "Enterprise Landowners"),
            ((tier == "Premium") & (savings >= 20000), "Premium Agricultural Clients"),
            (tier.isin("High", "Premium") & value.isin("High-Value", "Medium-Value"), "Active Farmers"),
            (tier.isin("Medium", "High") & (savings >= 5000), "Agricultural Investors"),
            (tier == "Medium", "Potential Agricultural Prospects"),
            (tier == "Low", "Low-Priority Agricultural Leads"),
        ],
        "Unqualified",
    )
    return df.withColumn("segment", segment).withColumn("segment_priority", mapped(F.col("segment"), SEGMENT_PRIORITY, 0))


# Recommendations --------------------------------------------------------------------------------

# Strategies (name, priority, actions); conditions are in `_conditions`.
STRATEGIES = [
    ("lead_nurturing", "medium", ["Send educational content series", "Invite to webinar or demo", "Offer free consultation"]),
    ("sales_acceleration", "high", ["Schedule immediate sales call", "Send personalized proposal", "Arrange product demonstration"]),
    ("churn_prevention", "critical", ["Immediate account manager outreach", "Schedule retention call", "Offer loyalty incentives"]),
    ("customer_expansion", "medium", ["Identify upsell opportunities", "Introduce new products/features", "Schedule expansion discussion"]),
    ("re_engagement", "medium", ["Send re-engagement email series", "Offer special promotion", "Update contact information"]),
    ("data_enrichment", "low", ["Request missing information", "Send profile completion form", "Offer incentive for data update"]),
]
DEFAULT_ACTIONS = ["Monitor customer activity", "Maintain regular communication"]
PRIORITY_ORDER = {"critical": 1, "high": 2, "medium": 3, "low": 4}
PRIORITY_WEIGHT = {"critical": 4, "high": 3, "medium": 2, "low": 1}
TEAMS = {
    "sales_team": ["sales_acceleration", "customer_expansion"],
    "marketing_team": ["lead_nurturing", "re_engagement"],
    "customer_success": ["churn_prevention"],
    "data_team": ["data_enrichment"],
}


def _conditions() -> dict[str, Column]:
    """A condition on an unknown input passes."""

    def low(name, bound):
        return F.coalesce(F.col(name) >= bound, F.lit(True))

    def high(name, bound):
        return F.coalesce(F.col(name) <= bound, F.lit(True))

    stage = F.lower(F.coalesce("lifecyclestage", F.lit("")))
    return {
        "lead_nurturing": low("lead_score", 0.3) & high("lead_score", 0.7)
        & stage.isin("subscriber", "lead", "marketingqualifiedlead") & low("days_since_created", 7) & high("days_since_created", 90),
        "sales_acceleration": low("lead_score", 0.7) & stage.isin("marketingqualifiedlead", "salesqualifiedlead") & low("engagement_score", 0.6),
        "churn_prevention": low("churn_risk_score", 0.6) & low("days_since_last_activity", 30),
        "customer_expansion": (stage == "customer") & low("total_deals", 1) & high("churn_risk_score", 0.3),
        "re_engagement": low("days_since_last_activity", 60) & low("churn_risk_score", 0.4) & high("churn_risk_score", 0.7),
        "data_enrichment": high("completeness_score", 0.5) & low("engagement_score", 0.3),
    }


def contextual_actions() -> Column:
    engagement = F.coalesce("engagement_score", F.lit(0.5))
    segment = F.lower(F.coalesce("predicted_segment", F.lit("")))
    return F.array_compact(
        F.array(
            F.when(F.col("total_deals") > 2, "Assign dedicated account manager"),
            F.when(F.col("days_since_created") < 30, "Include in new customer onboarding sequence"),
            F.when(engagement > 0.8, "Consider for customer advocacy program").when(engagement < 0.3, "Focus on engagement improvement"),
            F.when(F.col("completeness_score") < 0.4, "Prioritize data collection and enrichment"),
            F.when(segment.contains("enterprise"), "Offer enterprise-level support and features").when(
                segment.contains("small"), "Provide SMB-focused resources and pricing"
            ),
        )
    )


def with_neutral_scores(df: DataFrame) -> DataFrame:
    """Neutral values where no model produced a score."""
    defaults = {
        "lead_score": 0.5, "score_category": "Medium", "churn_risk_score": 0.3, "churn_risk_category": "Low",
        "predicted_segment": "Segment_0",
    }
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()}
    )


def attach_scores(customers: DataFrame, lead: DataFrame | None, churn: DataFrame | None, segment: DataFrame | None, key: str = "id") -> DataFrame:
    """Lead, churn and segment outputs on one frame; absent ones read as neutral."""
    out = customers
    for scores in (lead, churn, segment):
        if scores is not None:
            out = out.join(scores, key, "left")
    return with_neutral_scores(out)


def recommend(df: DataFrame) -> DataFrame:
    """Applicable strategies by priority, the first one's actions, and contextual actions."""
    conditions = _conditions()
    entries = []
    for position, (name, priority, actions) in enumerate(STRATEGIES):
        entry = F.struct(
            F.lit(PRIORITY_ORDER[priority]).alias("order"), F.lit(position).alias("position"), F.lit(name).alias("name"),
            F.lit(priority).alias("priority"), F.array(*[F.lit(a) for a in actions]).alias("actions"),
        )
        entries.append(F.when(conditions[name], entry))
    out = df.withColumn("_rules", F.array_sort(F.array_compact(F.array(*entries))))
    first = F.get(F.col("_rules"), F.lit(0))
    return out.withColumns(
        {
            "primary_strategy": F.coalesce(first["name"], F.lit("maintenance")),
            "priority": F.coalesce(first["priority"], F.lit("low")),
            "recommended_actions": F.coalesce(first["actions"], F.array(*[F.lit(a) for a in DEFAULT_ACTIONS])),
            "applicable_rules": F.transform("_rules", lambda r: r["name"]),
            "contextual_actions": contextual_actions(),
        }
    ).drop("_rules")


def priority_score(df: DataFrame) -> DataFrame:
    score = mapped(F.col("priority"), PRIORITY_WEIGHT, 0) + F.col("lead_score") * 2 + F.col("churn_risk_score") * 3
    return df.withColumn("priority_score", score)


def prioritise(df: DataFrame, key: str = "id") -> DataFrame:
    """Rank 1..n by priority score, the lower id first on ties; ranked without a single-task sort."""
    return global_rank(priority_score(df), [F.desc("priority_score"), F.col(key)], "action_rank")


def campaign_counts(recommended: DataFrame) -> DataFrame:
    return recommended.groupBy("priority").agg(F.count(F.lit(1)).alias("customers"))


def strategic_programs(recommended: DataFrame, n: int = 3, minimum: int = 10) -> DataFrame:
    """The most frequent strategies, if frequent enough to be a program."""
    counts = recommended.groupBy("primary_strategy").agg(F.count(F.lit(1)).alias("customers"))
    return top_n(counts, [F.desc("customers"), F.col("primary_strategy")], n).where(F.col("customers") > minimum)


def schedule(prioritised: DataFrame, days: int = 30) -> DataFrame:
    """The planned day (0-based) of each customer: max(10, n // days) per day, in rank order.

    Customers beyond the period keep a null day, as they are not scheduled.
    """
    size = prioritised.agg(F.count(F.lit(1)).alias("n")).scalar()
    out = prioritised.withColumn("_n", size)
    capacity = F.greatest(F.lit(10), F.floor(F.col("_n") / days))
    day = F.floor((F.col("action_rank") - 1) / capacity)
    return out.withColumn("plan_day", F.when(day < days, day)).drop("_n")


def daily_plan(scheduled: DataFrame) -> DataFrame:
    """Customers per day and priority."""
    return scheduled.where(F.col("plan_day").isNotNull()).groupBy("plan_day").agg(
        F.count(F.lit(1)).alias("customers"), *[F.count_if(F.col("priority") == p).alias(p) for p in PRIORITY_ORDER]
    )


def daily_actions(scheduled: DataFrame, n: int = 5) -> DataFrame:
    """The n most frequent actions of each day."""
    counts = (
        scheduled.where(F.col("plan_day").isNotNull()).select("plan_day", F.explode("recommended_actions").alias("action"))
        .groupBy("plan_day", "action").agg(F.count(F.lit(1)).alias("customers"))
    )
    return top_n_per_key(counts, ["plan_day"], [F.desc("customers"), F.col("action")], n)


def resource_needs(recommended: DataFrame) -> DataFrame:
    """Customers per team and the three targets; one pass."""
    strategy, priority = F.col("primary_strategy"), F.col("priority")
    return recommended.agg(
        *[F.count_if(strategy.isin(names)).alias(team) for team, names in TEAMS.items()],
        (F.count_if(priority.isin("high", "critical")) * 0.2).alias("target_conversions"),
        (F.count_if(strategy == "churn_prevention") * 0.7).alias("churn_prevention_target"),
        (F.count_if(strategy == "re_engagement") * 0.4).alias("engagement_target"),
    )


# Retention and segment advice -------------------------------------------------------------------

# Base advice per risk category and additions per leading risk factor.
RETENTION_ADVICE = {
    "Critical": [
        "Immediate personal outreach by account manager", "Schedule urgent check-in call within 24 hours",
        "Offer special retention incentives or discounts", "Escalate to senior management for intervention",
        "Conduct exit interview to understand concerns",
    ],
    "High": [
        "Proactive outreach within 48 hours", "Personalized re-engagement campaign", "Offer additional training or support",
        "Review and optimize their current setup", "Provide success manager assignment",
    ],
    "Medium": [
        "Include in nurturing email campaigns", "Send relevant content and resources", "Monitor engagement closely",
        "Offer product updates or new features", "Schedule quarterly check-in calls",
    ],
    "Low": [
        "Continue regular communication cadence", "Include in customer success programs",
        "Monitor for any changes in behavior", "Provide self-service resources", "Maintain standard support level",
    ],
}
FACTOR_ADVICE = {
    "days_since_last_activity": ("Focus on re-activating dormant accounts", ["Critical", "High"]),
    "deal_momentum": ("Identify new sales opportunities", ["Critical", "High", "Medium"]),
    "engagement_quality": ("Improve data quality and engagement tracking", ["Critical", "High"]),
}


def retention_advice(df: DataFrame, top_factors: Sequence[str], category: str = "churn_risk_category") -> DataFrame:
    """Advice per customer from its risk category and the model's leading factors."""
    out = None
    for name, advice in RETENTION_ADVICE.items():
        extra = [text for factor, (text, where) in FACTOR_ADVICE.items() if factor in top_factors[:5] and name in where]
        texts = F.array(*[F.lit(a) for a in [*advice, *extra]])
        out = F.when(F.col(category) == name, texts) if out is None else out.when(F.col(category) == name, texts)
    return df.withColumn("retention_advice", out)


def segment_name(engagement: Column, maturity: Column, deals: Column) -> Column:
    return first_match(
        [
            ((engagement > 0.7) & (maturity > 0.7) & (deals > 0.5), "Enterprise Champions"),
            ((engagement > 0.7) & (maturity > 0.7), "Enterprise Prospects"),
            ((engagement > 0.7) & (deals > 0.5), "Active Customers"),
            ((engagement > 0.5) & (maturity > 0.5), "Qualified Prospects"),
            (engagement > 0.5, "Engaged Leads"),
            (maturity > 0.7, "Enterprise Dormant"),
            (deals > 0.3, "Occasional Buyers"),
        ],
        "Cold Leads",
    )


def segment_actions(engagement: Column, maturity: Column, deals: Column, recency: Column, conversion: Column) -> Column:
    """Actions for a segment from its mean scores; conversion is in percent."""

    def either(pairs):
        return first_match([(cond, F.array(*[F.lit(t) for t in texts])) for cond, texts in pairs], F.array().cast("array<string>"))

    return F.concat(
        either([
            (engagement < 0.3, ["Implement lead nurturing campaigns", "Improve data collection processes"]),
            (engagement < 0.6, ["Increase touchpoint frequency", "Personalize communication"]),
        ]),
        either([
            (deals < 0.2, ["Focus on lead qualification", "Implement lead scoring"]),
            (conversion < 10, ["Optimize sales process", "Provide sales training"]),
        ]),
        either([
            (maturity > 0.7, ["Assign dedicated account managers", "Offer enterprise-level solutions"]),
            (maturity < 0.3, ["Focus on SMB-friendly offerings", "Simplify onboarding process"]),
        ]),
        either([(recency < 0.3, ["Re-engagement campaign needed", "Update contact information"])]),
    )
