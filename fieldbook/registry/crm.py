"""CRM flattening, lead features, rules, recommendations, ranks and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldbook.operators import crm, ranking, reports, rules
from fieldbook.registry import query
from fieldbook.registry.tables import AS_OF_EPOCH, base, spread, table

AS_OF = dt.datetime(2002, 1, 1)


def _contacts(spark, sf):
    return table(spark, sf, "contacts").withColumns(
        {
            "createdate": F.timestamp_seconds("created_epoch"), "lastmodifieddate": F.timestamp_seconds("modified_epoch"),
            "owner_id": F.concat(F.lit("owner_"), (F.col("contact_id") % 7).cast("string")),
        }
    )


def _leads(spark, sf):
    return crm.lead_extract(_contacts(spark, sf), table(spark, sf, "deals"), table(spark, sf, "companies"), [])


LEADS = f""" summary AS (SELECT owner_id, count(*) AS total_deals, sum(CAST(amount * 4 AS DECIMAL(18, 2))) / 4 AS total_deal_value, avg(amount) AS avg_deal_value, max(amount) AS max_deal_value,
   avg(stage_probability) AS avg_deal_probability FROM deals GROUP BY 1),
 leads AS (SELECT c.*, co.*, 'owner_' || (contact_id % 7) AS owner, coalesce(total_deals, 0) AS total_deals, coalesce(total_deal_value, 0) AS total_deal_value, coalesce(avg_deal_value, 0) AS avg_deal_value,
   coalesce(max_deal_value, 0) AS max_deal_value, coalesce(avg_deal_probability, 0) AS avg_deal_probability, make_timestamp(created_epoch * 1000000) AS created,
   CAST(floor(({AS_OF_EPOCH} - created_epoch) / 86400e0) AS BIGINT) AS days_created, CAST(floor(({AS_OF_EPOCH} - modified_epoch) / 86400e0) AS BIGINT) AS days_modified
   FROM contacts c LEFT JOIN summary s ON s.owner_id = 'owner_' || (contact_id % 7) LEFT JOIN companies co ON co.company_name = c.company WHERE email IS NOT NULL),
 features AS (SELECT *, split_part(email, '@', 2) AS domain, NOT regexp_matches(lower(split_part(email, '@', 2)), 'gmail|yahoo|hotmail|outlook|aol') AS business,
   ((firstname IS NOT NULL)::INT + (lastname IS NOT NULL)::INT + (email IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (company IS NOT NULL)::INT + (jobtitle IS NOT NULL)::INT) / 6e0 AS completeness,
   CASE lifecyclestage WHEN 'subscriber' THEN 1 WHEN 'lead' THEN 2 WHEN 'marketingqualifiedlead' THEN 3 WHEN 'salesqualifiedlead' THEN 4 WHEN 'opportunity' THEN 5 WHEN 'customer' THEN 6 ELSE 0 END AS stage_order FROM leads)"""
T = "contacts deals companies"


@query("j15_contact_company", "SELECT contact_id, c.company, company_id, company_industry, company_size FROM contacts c LEFT JOIN companies co ON co.company_name = c.company", T)
def j15(spark, sf):
    out = crm.join_companies(_contacts(spark, sf), table(spark, sf, "companies"))
    return out.select("contact_id", "company", "company_id", "company_industry", "company_size")


@query("a06_owner_summary", """SELECT owner_id, count(*) AS total_deals, round(sum(amount), 2) AS total_deal_value, round(avg(amount), 4) AS avg_deal_value, max(amount) AS max_deal_value,
  round(avg(stage_probability), 8) AS avg_deal_probability FROM deals GROUP BY 1""", "deals")
def a06(spark, sf):
    out = crm.owner_summary(table(spark, sf, "deals"))
    digits = {"total_deal_value": 2, "avg_deal_value": 4, "avg_deal_probability": 8}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("j16_owner_summary", f"WITH {LEADS} SELECT contact_id, owner AS owner_id, CAST(total_deals AS BIGINT) AS total_deals, max_deal_value FROM leads", T)
def j16(spark, sf):
    out = crm.join_owner_summary(_contacts(spark, sf).where("email IS NOT NULL"), table(spark, sf, "deals"))
    return out.select("contact_id", "owner_id", "total_deals", "max_deal_value")


@query("j16_hashed_owner", """WITH c AS (SELECT CASE WHEN company IS NULL THEN 'owner_0' ELSE 'owner_' || (CAST('0x' || substr(md5(lower(company)), 1, 12) AS BIGINT) % 6) END AS owner_id FROM contacts),
 s AS (SELECT owner_id, count(*) AS n FROM deals GROUP BY 1) SELECT owner_id, CAST(coalesce(n, 0) AS BIGINT) AS total_deals, count(*) AS contacts FROM c LEFT JOIN s USING (owner_id) GROUP BY 1, 2""", "contacts deals")
def j16_hashed(spark, sf):
    owners = [f"owner_{i}" for i in range(6)]
    contacts = table(spark, sf, "contacts").withColumn("owner_id", crm.owner_of_company(F.col("company"), owners))
    return crm.join_owner_summary(contacts, table(spark, sf, "deals")).groupBy("owner_id", "total_deals").agg(F.count(F.lit(1)).alias("contacts"))


@query("ml01_lead_extract", f"WITH {LEADS} SELECT contact_id, company_id, company_state, CAST(total_deals AS BIGINT) AS total_deals, round(avg_deal_value, 4) AS avg_deal_value FROM leads", T)
def ml01(spark, sf):
    return _leads(spark, sf).select("contact_id", "company_id", "company_state", "total_deals", F.round("avg_deal_value", 4).alias("avg_deal_value"))


@query("ml02_lead_features", f"""WITH {LEADS} SELECT contact_id, days_created AS days_since_created, days_modified AS days_since_modified, CAST(month(created) AS BIGINT) AS created_month,
  CAST(quarter(created) AS BIGINT) AS created_quarter, CAST(isodow(created) - 1 AS BIGINT) AS created_weekday, domain AS email_domain, business AS is_business_email,
  count(*) OVER (PARTITION BY domain) AS email_domain_frequency,
  CASE WHEN company_size > 0 AND company_size <= 10 THEN 'Micro' WHEN company_size > 10 AND company_size <= 50 THEN 'Small' WHEN company_size > 50 AND company_size <= 200 THEN 'Medium'
    WHEN company_size > 200 AND company_size <= 1000 THEN 'Large' WHEN company_size > 1000 THEN 'Enterprise' END AS company_size_category,
  CASE WHEN company_revenue > 0 AND company_revenue <= 100000 THEN 'Startup' WHEN company_revenue > 100000 AND company_revenue <= 1000000 THEN 'Small'
    WHEN company_revenue > 1000000 AND company_revenue <= 10000000 THEN 'Medium' WHEN company_revenue > 10000000 AND company_revenue <= 100000000 THEN 'Large' END AS company_revenue_category,
  CASE WHEN company_industry IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY company_industry) END AS industry_frequency, round(completeness, 8) AS completeness_score,
  phone IS NOT NULL AS has_both_contact, firstname IS NOT NULL AND lastname IS NOT NULL AS has_full_name, CAST(stage_order AS BIGINT) AS lifecycle_stage_order,
  total_deals > 0 AS is_deal_creator, max_deal_value > (SELECT quantile_cont(max_deal_value, 0.75) FROM leads) AS high_value_deals FROM features""", T)
def ml02(spark, sf):
    out = crm.lead_features(_leads(spark, sf), AS_OF)
    ints = ["created_month", "created_quarter", "created_weekday", "lifecycle_stage_order"]
    return out.select(
        "contact_id", "days_since_created", "days_since_modified", *[F.col(c).cast("bigint").alias(c) for c in ints], "email_domain", "is_business_email",
        "email_domain_frequency", "company_size_category", "company_revenue_category", "industry_frequency", F.round("completeness_score", 8).alias("completeness_score"),
        "has_both_contact", "has_full_name", "is_deal_creator", "high_value_deals",
    )


@query("ml03_conversion_target", f"WITH {LEADS} SELECT lifecyclestage, CAST(lower(lifecyclestage) IN ('customer', 'opportunity') AS BIGINT) AS converted, count(*) AS leads FROM leads GROUP BY ALL", T)
def ml03(spark, sf):
    target = crm.conversion_target(F.col("lifecyclestage")).cast("bigint").alias("converted")
    return _leads(spark, sf).groupBy("lifecyclestage", target).agg(F.count(F.lit(1)).alias("leads"))


@query("ml11_churn_features", f"""WITH {LEADS} SELECT contact_id, round(days_created / (days_modified + 1), 6) AS activity_frequency, round(total_deals / (days_created + 1) * 365, 6) AS deal_momentum,
  CAST(stage_order <= 2 AS BIGINT) AS early_stage_risk, CAST(1 + (phone IS NOT NULL)::INT AS BIGINT) AS communication_channels, round((completeness + business::INT) / 2, 6) AS engagement_quality,
  round(CASE WHEN days_modified > 90 THEN 1 ELSE days_modified / 90 END, 6) AS inactivity_risk,
  CAST(days_modified > 90 OR (total_deals = 0)::INT + ((completeness + business::INT) / 2 < 0.3)::INT >= 2 AS BIGINT) AS churned FROM features""", T)
def ml11(spark, sf):
    out = crm.churn_target(crm.churn_features(crm.lead_features(_leads(spark, sf), AS_OF)))
    r6 = ["activity_frequency", "deal_momentum", "engagement_quality", "inactivity_risk"]
    return out.select("contact_id", *[F.round(c, 6).alias(c) for c in r6], *[F.col(c).cast("bigint").alias(c) for c in ("early_stage_risk", "communication_channels", "churned")])


@query("ml13_segmentation_features", f"""WITH {LEADS}, e AS (SELECT quantile_cont(coalesce(company_size, 0), [0, 0.2, 0.4, 0.6, 0.8, 1]) AS se, quantile_cont(coalesce(company_size, 0), 0.5) AS sm, count(DISTINCT coalesce(company_size, 0)) AS sn,
   min(coalesce(company_size, 0)) AS slo, max(coalesce(company_size, 0)) AS shi, max(days_created) AS md, max(stage_order) AS ms FROM features)
 SELECT contact_id, round((1 + (phone IS NOT NULL)::INT + (firstname IS NOT NULL AND lastname IS NOT NULL)::INT + business::INT) / 4, 4) AS engagement_score,
  round(1 - days_created / md, 6) AS recency_score, round(stage_order / ms, 6) AS lifecycle_score,
  CAST(CASE WHEN sn <= 5 THEN CASE WHEN coalesce(company_size, 0) > sm THEN 5 ELSE 3 END WHEN len(list_distinct(se)) = 6 THEN greatest(len(list_filter(se, lambda x: x < coalesce(company_size, 0))), 1)
    ELSE least(greatest(ceil((coalesce(company_size, 0) - slo) / ((shi - slo) / 5e0)), 1), 5) END AS DOUBLE) AS company_size_score FROM features, e""", T)
def ml13(spark, sf):
    out = crm.segmentation_features(crm.lead_features(_leads(spark, sf), AS_OF))
    return out.select(
        "contact_id", F.round("engagement_score", 4).alias("engagement_score"), F.round("recency_score", 6).alias("recency_score"),
        F.round("lifecycle_score", 6).alias("lifecycle_score"), "company_size_score",
    )


@query("w07_group_size", "SELECT contact_id, split_part(email, '@', 2) AS email_domain, count(*) OVER (PARTITION BY split_part(email, '@', 2)) AS frequency FROM contacts WHERE email IS NOT NULL", "contacts")
def w07(spark, sf):
    from fieldbook.functions.values import mail_domain

    out = table(spark, sf, "contacts").where("email IS NOT NULL").select("contact_id", mail_domain(F.col("email")).alias("email_domain"))
    return ranking.with_group_size(out, "email_domain", "frequency")


# CRM objects ------------------------------------------------------------------------------------


def _objects(spark, sf):
    """One object per order: properties as text, two association types from its own columns."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    props = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("dealname", "amount", "createdate", "country", "is_hot_bool", "deal_count", "note")]),
        F.array(
            F.concat(F.lit("Deal "), text(k)), text(F.col("o_totalprice")), text(F.unix_millis(F.col("o_orderdate").cast("timestamp"))), F.lit("US"),
            F.when(k % 2 == 0, "true").otherwise("false"), text(k % 9),
            F.when(k % 4 == 0, '{"a":1}').when(k % 4 == 1, "").when(k % 4 == 2, "None").otherwise("plain"),
        ),
    )
    ids = F.transform(F.sequence(F.lit(1).cast("bigint"), k % 8 + 1), lambda i: F.struct(text(i + k).alias("id")))
    links = F.map_from_arrays(F.array(F.lit("contacts")), F.array(F.struct(ids.alias("results"))))
    return spread(base(spark, sf, "orders")).select(
        text(k).alias("id"), props.alias("properties"), F.when(k % 5 != 0, links).alias("associations"), (k % 3 == 0).alias("archived"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updatedAt"),
    )


PROPS = ["dealname", "amount", "createdate", "country", "is_hot_bool", "deal_count", "note"]


@query("src08_object_pages", """SELECT '' || o_orderkey AS id, 'Deal ' || o_orderkey AS dealname, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 8 + 1 END AS BIGINT) AS contacts FROM orders""")
def src08(spark, sf):
    pages = _objects(spark, sf).select(F.to_json(F.struct(F.array(F.struct("*")).alias("results"))).alias("page"))
    out = crm.explode_pages(pages, "page")
    return out.select(
        "id", F.col("properties")["dealname"].alias("dealname"),
        F.when(F.col("associations").isNotNull(), F.size(F.col("associations")["contacts"]["results"])).cast("bigint").alias("contacts"),
    )


NAMES = ["firstname", "name", "dealname", "subject", "amount", "createdate", "custom_score"]


@query("src08_typed_objects", f"""WITH t AS (SELECT *, [{', '.join(f"'{t}'" for t in crm.OBJECT_TYPES)}, 'unheard'][o_orderkey % 13 + 1] AS object_type FROM orders)
SELECT '' || o_orderkey AS id, object_type, object_type <> 'unheard' AS is_known_type, CAST(CASE object_type WHEN 'contacts' THEN 19 WHEN 'companies' THEN 14 WHEN 'deals' THEN 11 WHEN 'tickets' THEN 10 ELSE 0 END AS BIGINT) AS listed,
  CAST(CASE object_type WHEN 'contacts' THEN 2 WHEN 'companies' THEN 2 WHEN 'deals' THEN 3 WHEN 'tickets' THEN 2 ELSE 0 END AS BIGINT) AS filled,
  CAST(CASE object_type WHEN 'contacts' THEN 5 WHEN 'companies' THEN 5 WHEN 'deals' THEN 4 WHEN 'tickets' THEN 5 ELSE 7 END AS BIGINT) AS others,
  CASE WHEN object_type = 'deals' THEN 'dealname of ' || o_orderkey END AS dealname, 'custom_score of ' || o_orderkey AS custom FROM t""")
def src08_typed(spark, sf):
    """Pages of all types mixed, each object with the properties of its own type."""
    k = F.col("o_orderkey")
    kinds = F.array(*[F.lit(t) for t in (*crm.OBJECT_TYPES, "unheard")])
    props = F.map_from_arrays(F.array(*map(F.lit, NAMES)), F.array(*[F.concat(F.lit(f"{n} of "), k.cast("string")) for n in NAMES]))
    objects = spread(base(spark, sf, "orders")).select(k, F.get(kinds, (k % 13).cast("int")).alias("object_type"), F.struct(k.cast("string").alias("id"), props.alias("properties")).alias("o"))
    pages = objects.select("object_type", F.col("o_orderkey").alias("page_number"), F.to_json(F.struct(F.array("o").alias("results"))).alias("page"))
    out = crm.typed_objects(pages, "page", "object_type", "page_number")
    size = lambda c: F.size(c).cast("bigint")
    return out.select(
        "id", "object_type", "is_known_type", size("listed").alias("listed"), size(F.map_filter("listed", lambda _, v: v.isNotNull())).alias("filled"),
        size("others").alias("others"), F.col("listed")["dealname"].alias("dealname"), F.col("others")["custom_score"].alias("custom"),
    )


@query("src09_incremental", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS modified FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'")
def src09(spark, sf):
    from fieldbook.sources.tables import last_successful_run

    log = base(spark, sf, "orders").where("o_orderdate < TIMESTAMP '2000-06-01' + INTERVAL 1 DAY AND o_orderdate >= TIMESTAMP '2000-06-01'").select(
        F.lit("crm").alias("job"), F.col("o_orderdate").alias("end_time"), F.lit("completed").alias("status")
    )
    row = last_successful_run(log).first()
    since = row["last_success"] if row else dt.datetime(2000, 6, 1)
    out = crm.modified_since(base(spark, sf, "orders"), "o_orderdate", since, AS_OF)
    return out.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("modified"))


@query("p16_flatten_objects", """SELECT '' || o_orderkey AS id, 'deals' AS object_type, 'Deal ' || o_orderkey AS dealname, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 8 + 1 ELSE 0 END AS BIGINT) AS contacts_count,
  CASE WHEN o_orderkey % 5 <> 0 THEN array_to_string(list_transform(range(1, least(o_orderkey % 8 + 2, 6)), lambda i: '' || (i + o_orderkey)), ',') END AS contacts_ids, o_orderkey % 3 = 0 AS archived FROM orders""")
def p16(spark, sf):
    out = crm.flatten_objects(_objects(spark, sf), "deals", PROPS, ["contacts"])
    return out.select("id", "object_type", "dealname", F.col("contacts_count").cast("bigint").alias("contacts_count"), "contacts_ids", "archived")


@query("p17_value_kinds", """SELECT name, kind, count(*) AS n FROM (SELECT unnest(['dealname', 'amount', 'country', 'is_hot_bool', 'deal_count', 'note']) AS name,
  unnest(['string', 'number', 'string', 'boolean', 'integer', CASE o_orderkey % 4 WHEN 0 THEN 'json' WHEN 1 THEN 'empty' ELSE 'string' END]) AS kind FROM orders) GROUP BY ALL""")
def p17(spark, sf):
    pairs = _objects(spark, sf).select(F.explode("properties").alias("name", "value")).where("name <> 'createdate'")
    return pairs.groupBy("name", crm.value_kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("p18_types_by_name", """SELECT '' || o_orderkey AS id, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS createdate, 'US' AS country, o_orderkey % 2 = 0 AS is_hot_bool,
  CAST(o_orderkey % 9 AS DOUBLE) AS deal_count FROM orders""")
def p18(spark, sf):
    out = crm.apply_types(crm.flatten_objects(_objects(spark, sf), "deals", PROPS, []))
    return out.select("id", "amount", F.date_format("createdate", "yyyy-MM-dd").alias("createdate"), "country", "is_hot_bool", "deal_count")


@query("p19_load_metadata", "SELECT '' || o_orderkey AS id, '2002-01-01' AS loaded, 'crm' AS etl_source, '1.0' AS etl_version FROM orders")
def p19(spark, sf):
    out = crm.add_load_metadata(_objects(spark, sf), AS_OF, "crm")
    return out.select("id", F.date_format("etl_loaded_at", "yyyy-MM-dd").alias("loaded"), "etl_source", "etl_version")


@query("p20_warehouse_ready", """SELECT '' || o_orderkey AS "ID", CASE o_orderkey % 4 WHEN 0 THEN '{"a":1}' WHEN 3 THEN 'plain' END AS "NOTE", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "CREATEDATE" FROM orders""")
def p20(spark, sf):
    typed = crm.apply_types(crm.flatten_objects(_objects(spark, sf), "deals", PROPS, []))
    return crm.warehouse_ready(typed.select("id", "note", "createdate"))


# Ranks and quantiles ----------------------------------------------------------------------------


@query("w05_dense_rank", "SELECT id, dense_rank() OVER (ORDER BY lead_score DESC) AS lead_rank FROM scored", "scored")
def w05(spark, sf):
    return ranking.dense_rank_desc(table(spark, sf, "scored").select("id", "lead_score"), "lead_score", "lead_rank").drop("lead_score")


@query("w06_global_rank", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS action_rank FROM lineitem")
def w06(spark, sf):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = base(spark, sf, "lineitem").select(*cols, "l_extendedprice")
    return ranking.global_rank(rows, [F.desc("l_extendedprice"), *[F.col(c) for c in cols]], "action_rank").drop("l_extendedprice")


DECILES = "quantile_cont(lead_score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])"


@query("w08_deciles", f"""WITH e AS (SELECT {DECILES} AS edges FROM scored) SELECT id, CAST(1 + len(list_filter(list_distinct(edges), lambda x: x < lead_score)) AS BIGINT) AS decile FROM scored, e""", "scored")
def w08(spark, sf):
    out = ranking.decile(table(spark, sf, "scored"), "lead_score", "decile")
    return out.select("id", F.col("decile").cast("bigint").alias("decile"))


@query("w09_quantile_buckets", """WITH e AS (SELECT list_distinct(quantile_cont(churn_risk_score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS edges FROM scored)
SELECT id, CAST(greatest(len(list_filter(edges, lambda x: x < churn_risk_score)), 1) AS BIGINT) AS churn_risk_percentile FROM scored, e""", "scored")
def w09(spark, sf):
    out = ranking.quantile_bucket(table(spark, sf, "scored"), "churn_risk_score", 10, "churn_risk_percentile")
    return out.select("id", F.col("churn_risk_percentile").cast("bigint").alias("churn_risk_percentile"))


@query("w10_max_normalised", "SELECT id, round(1 - days_since_created / (SELECT max(days_since_created) FROM scored), 8) AS recency FROM scored", "scored")
def w10(spark, sf):
    s = table(spark, sf, "scored")
    top = s.agg(F.max("days_since_created")).scalar()
    return s.withColumn("top", top).select("id", F.round(1 - F.col("days_since_created") / F.col("top"), 8).alias("recency"))


@query("w11_above_quantile", "SELECT o_orderkey, o_totalprice > (SELECT quantile_cont(o_totalprice, 0.75) FROM orders) AS is_high FROM orders")
def w11(spark, sf):
    return crm.above_quantile(base(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.75, "is_high").drop("o_totalprice")


@query("w12_share_of_group", """WITH c AS (SELECT predicted_segment AS cluster, lifecyclestage AS member, count(*) AS n FROM scored GROUP BY 1, 2)
SELECT cluster, member, n, round(n / sum(n) OVER (PARTITION BY cluster), 8) AS share FROM c QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, member) <= 5""", "scored")
def w12(spark, sf):
    s = table(spark, sf, "scored").withColumnRenamed("predicted_segment", "cluster")
    return reports.segment_shares(s, "lifecyclestage").select("cluster", "member", "n", F.round("share", 8).alias("share"))


@query("w03_top_orders_per_customer", """SELECT o_custkey, o_orderkey, CAST(r AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 5""")
def w03(spark, sf):
    out = ranking.top_n_per_key(base(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)
    return out.select("o_custkey", "o_orderkey", F.col("rank").cast("bigint").alias("rank"))


SCORE_BIN = """CASE WHEN {0} > 0 AND {0} <= 0.3 THEN 'Low' WHEN {0} > 0.3 AND {0} <= 0.6 THEN 'Medium' WHEN {0} > 0.6 AND {0} <= 0.8 THEN 'High' WHEN {0} > 0.8 AND {0} <= 1 THEN '{1}' END"""


@query("ml10_ranked_leads", f"""WITH e AS (SELECT {DECILES} AS edges FROM scored) SELECT id, CAST(1 + len(list_filter(list_distinct(edges), lambda x: x < lead_score)) AS BIGINT) AS score_decile,
  dense_rank() OVER (ORDER BY lead_score DESC) AS lead_rank, {SCORE_BIN.format('lead_score', 'Very High')} AS score_category FROM scored, e""", "scored")
def ml10(spark, sf):
    out = reports.rank_leads(table(spark, sf, "scored").select("id", "lead_score"))
    return out.select("id", F.col("score_decile").cast("bigint").alias("score_decile"), "lead_rank", "score_category")


@query("ml12_ranked_churn", f"""SELECT id, {SCORE_BIN.format('churn_risk_score', 'Critical')} AS churn_risk_category, CAST(churn_risk_score > 0.7 AS BIGINT) AS high_churn_risk,
  CAST(churn_risk_score > 0.8 AS BIGINT) AS immediate_attention FROM scored""", "scored")
def ml12(spark, sf):
    out = reports.rank_churn(table(spark, sf, "scored").select("id", "churn_risk_score"))
    return out.select("id", "churn_risk_category", *[F.col(c).cast("bigint").alias(c) for c in ("high_churn_risk", "immediate_attention")])


@query("f14_bins", f"""SELECT {SCORE_BIN.format('lead_score', 'Very High')} AS category, count(*) AS n FROM scored GROUP BY 1""", "scored")
def f14(spark, sf):
    return reports.value_counts(table(spark, sf, "scored"), reports.score_category(F.col("lead_score")), "category").withColumnRenamed("customers", "n")


@query("t01_top_leads", "SELECT id, lead_score FROM scored WHERE lead_score >= 0.5 ORDER BY lead_score DESC, id LIMIT 100", "scored")
def t01(spark, sf):
    return reports.top_scored(table(spark, sf, "scored").select("id", "lead_score"), "lead_score", "id", 100, 0.5)


@query("t02_largest_risks", "SELECT id, email, company, churn_risk_score FROM scored ORDER BY churn_risk_score DESC, id LIMIT 10", "scored")
def t02(spark, sf):
    return ranking.top_n(table(spark, sf, "scored").select("id", "email", "company", "churn_risk_score"), [F.desc("churn_risk_score"), F.col("id")], 10)


# Insights ---------------------------------------------------------------------------------------


@query("a17_lead_insights", """SELECT count(*) AS total_leads, round(avg(lead_score), 8) AS average_score, count(*) FILTER (WHERE lead_score > 0.7) AS high_quality_leads,
  round(avg(completeness_score) FILTER (WHERE lead_score > 0.7), 8) AS avg_completeness, round(avg(is_business_email::INT) FILTER (WHERE lead_score > 0.7), 8) AS business_email_rate,
  round(avg(has_phone::INT) FILTER (WHERE lead_score > 0.7), 8) AS has_phone_rate FROM scored""", "scored")
def a17(spark, sf):
    out = reports.lead_insights(table(spark, sf, "scored"))
    return out.withColumns({c: F.round(c, 8) for c in ("average_score", "avg_completeness", "business_email_rate", "has_phone_rate")})


@query("a17_top_industries", "SELECT company_industry AS member, round(avg(lead_score), 8) AS mean_score FROM scored GROUP BY 1 ORDER BY round(avg(lead_score), 9) DESC, member LIMIT 5", "scored")
def a17_industries(spark, sf):
    return reports.mean_by(table(spark, sf, "scored"), "company_industry", "lead_score").withColumn("mean_score", F.round("mean_score", 8))


@query("a18_churn_summary", """SELECT count(*) AS total_customers, round(avg(churn_risk_score), 8) AS avg_risk_score, count(*) FILTER (WHERE churn_risk_score > 0.7) AS high_risk_count,
  count(*) FILTER (WHERE churn_risk_score > 0.8) AS critical_risk_count FROM scored""", "scored")
def a18(spark, sf):
    return reports.churn_summary(table(spark, sf, "scored")).withColumn("avg_risk_score", F.round("avg_risk_score", 8))


@query("a18_churn_by_month", "SELECT strftime(make_timestamp(created_epoch * 1000000), '%Y-%m') AS month, round(avg(churn_risk_score), 8) AS avg_risk, count(*) AS customers FROM scored GROUP BY 1", "scored")
def a18_month(spark, sf):
    s = table(spark, sf, "scored").withColumn("createdate", F.timestamp_seconds("created_epoch"))
    return reports.churn_by_month(s, "createdate").withColumn("avg_risk", F.round("avg_risk", 8))


@query("a19_segment_features", """SELECT predicted_segment AS cluster, feature, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS median FROM (
  SELECT predicted_segment, unnest(['lead_score', 'engagement_score', 'completeness_score']) AS feature, unnest([lead_score, engagement_score, completeness_score]) AS value FROM scored) GROUP BY 1, 2""", "scored")
def a19(spark, sf):
    s = table(spark, sf, "scored").withColumnRenamed("predicted_segment", "cluster")
    out = reports.segment_features(s, ["lead_score", "engagement_score", "completeness_score"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "median")})


@query("a19_segment_business", """SELECT predicted_segment AS cluster, round(avg(total_deals), 8) AS avg_deals, round(avg((total_deals > 0)::INT) * 100, 6) AS deal_creators_pct,
  round(avg((lifecyclestage = 'customer')::INT) * 100, 6) AS conversion_rate, count(*) AS size, round(count(*) / (SELECT count(*) FROM scored) * 100, 6) AS percentage FROM scored GROUP BY 1""", "scored")
def a19_business(spark, sf):
    s = table(spark, sf, "scored").withColumns(
        {"cluster": F.col("predicted_segment"), "converted": crm.conversion_target(F.col("lifecyclestage")), "total_deal_value": F.lit(0.0), "company_size": F.lit(0)}
    )
    out = reports.segment_business(s).join(reports.segment_sizes(s), "cluster")
    return out.select(
        "cluster", F.round("avg_deals", 8).alias("avg_deals"), F.round("deal_creators_pct", 6).alias("deal_creators_pct"),
        F.round("conversion_rate", 6).alias("conversion_rate"), "size", F.round("percentage", 6).alias("percentage"),
    )


@query("a27_score_distribution", """SELECT count(s) AS total, round(avg(s), 6) AS mean, max(s) AS highest, min(s) AS lowest, count(*) FILTER (WHERE s >= 80) AS high, count(*) FILTER (WHERE s >= 50 AND s < 80) AS medium,
  count(*) FILTER (WHERE s < 50) AS low, quantile_cont(s, 0.5) AS median FROM (SELECT lead_score * 100 AS s FROM scored)""", "scored")
def a27(spark, sf):
    s = table(spark, sf, "scored").select((F.col("lead_score") * 100).alias("s"))
    return reports.score_distribution(s, "s").withColumn("mean", F.round("mean", 6))


# Deals ------------------------------------------------------------------------------------------


def _deals(spark, sf):
    d = table(spark, sf, "deals").withColumn(
        "closedate", F.when(F.col("is_closed"), F.timestamp_micros(F.unix_micros(F.col("createdate").cast("timestamp")) + F.col("days_open") * F.lit(86400000000)))
    )
    return crm.deal_features(d, AS_OF)


DEALS = """ f AS (SELECT *, CAST(floor((epoch(TIMESTAMP '2002-01-01') - epoch(createdate)) / 86400) AS BIGINT) AS days_since_created, CASE WHEN is_closed THEN days_open END AS days_to_close,
   CASE WHEN amount > 0 AND amount <= 1000 THEN 'Micro' WHEN amount > 1000 AND amount <= 5000 THEN 'Small' WHEN amount > 5000 AND amount <= 25000 THEN 'Medium'
     WHEN amount > 25000 AND amount <= 100000 THEN 'Large' WHEN amount > 100000 THEN 'Enterprise' END AS size_category,
   CASE dealstage WHEN 'appointmentscheduled' THEN 1 WHEN 'qualifiedtobuy' THEN 2 WHEN 'presentationscheduled' THEN 3 WHEN 'decisionmakerboughtin' THEN 4 WHEN 'contractsent' THEN 5 WHEN 'closedwon' THEN 6 ELSE 0 END AS stage_order,
   month(createdate) AS m, (dealstage = 'closedwon')::INT AS won FROM deals WHERE amount > 0)"""


@query("ml19_deal_features", f"""WITH {DEALS} SELECT deal_id, days_since_created, days_to_close, size_category AS deal_size_category, CAST(stage_order AS BIGINT) AS stage_order, stage_probability > 0.7 AS high_probability,
  CAST(m AS BIGINT) AS created_month, round(amount / (days_since_created + 1) + 1e-9, 6) AS deal_velocity FROM f""", "deals")
def ml19(spark, sf):
    return _deals(spark, sf).select(
        "deal_id", "days_since_created", "days_to_close", "deal_size_category", F.col("stage_order").cast("bigint").alias("stage_order"), "high_probability",
        F.col("created_month").cast("bigint").alias("created_month"), F.round(F.col("deal_velocity") + 1e-9, 6).alias("deal_velocity"),
    )


PATTERNS = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {m} AS member, count(*) AS deals, round(avg(amount) + 1e-7, 4) AS avg_amount, round(sum(amount) + 1e-5, 2) AS total_amount, round(avg(days_to_close) + 1e-9, 6) AS avg_days_to_close, round(avg(won), 8) AS win_rate FROM f GROUP BY 2"
    for d, m in (("overall", "NULL::VARCHAR"), ("month", "'' || m"), ("size", "size_category"), ("stage", "'' || stage_order"))
)


@query("a16_deal_patterns", f"WITH {DEALS} {PATTERNS}", "deals")
def a16(spark, sf):
    # The small shift keeps exact halves off the rounding edge; the SQL side has it too.
    digits = {"avg_amount": (4, 1e-7), "total_amount": (2, 1e-5), "avg_days_to_close": (6, 1e-9), "win_rate": (8, 0.0)}
    return crm.deal_patterns(_deals(spark, sf)).withColumns({c: F.round(F.col(c) + e, n) for c, (n, e) in digits.items()})


@query("a16_best_months", f"""WITH {DEALS}, p AS (SELECT m, count(*) AS n, round(sum(amount), 2) AS v, round(avg(days_to_close), 6) AS d FROM f GROUP BY 1)
 SELECT CAST(arg_max(m, (n, -m)) AS BIGINT) AS best_month_volume, CAST(arg_max(m, (v, -m)) AS BIGINT) AS best_month_value, CAST(arg_min(m, (d, m)) AS BIGINT) AS fastest_month FROM p""", "deals")
def a16_best(spark, sf):
    p = crm.deal_patterns(_deals(spark, sf)).withColumns({"total_amount": F.round("total_amount", 2), "avg_days_to_close": F.round("avg_days_to_close", 6)})
    out = crm.best_months(p)
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("a24_forecast_months", f"""WITH {DEALS}, o AS (SELECT amount, stage_probability, date_trunc('month', createdate + (to_days(CAST(days_open + 360 AS INTEGER)))) AS month FROM f WHERE NOT is_closed),
 p AS (SELECT month, sum(amount * stage_probability) AS r, stddev_samp(amount * stage_probability) AS sd, count(*) AS n, avg(amount) AS a FROM o GROUP BY 1),
 spine AS (SELECT TIMESTAMP '2001-07-01' + to_months(CAST(i AS INTEGER)) AS month FROM range(6) AS t(i))
 SELECT strftime(s.month, '%Y-%m') AS month, round(coalesce(r, 0), 2) AS forecasted_revenue, round(greatest(0, coalesce(r, 0) - 1.96 * coalesce(sd, 0)), 2) AS lower_bound,
   round(coalesce(r, 0) + 1.96 * coalesce(sd, 0), 2) AS upper_bound, coalesce(n, 0) AS deal_count, round(coalesce(a, 0), 2) AS avg_deal_size FROM spine s LEFT JOIN p USING (month)""", "deals")
def a24(spark, sf):
    d = _deals(spark, sf).where("NOT is_closed").withColumns(
        {"closure_probability": F.col("stage_probability"), "estimated_close": F.date_add(F.col("createdate").cast("date"), (F.col("days_open") + 360).cast("int"))}
    )
    out = crm.revenue_forecast(d, dt.datetime(2001, 7, 15))
    r2 = ["forecasted_revenue", "lower_bound", "upper_bound", "avg_deal_size"]
    return out.withColumns({c: F.round(c, 2) for c in r2} | {"month": F.date_format("month", "yyyy-MM")})


@query("a24_fallback_forecast", f"""WITH {DEALS}, s AS (SELECT amount, CAST(DATE '2001-07-01' + to_months(CAST(CAST('0x' || substr(md5(CAST(deal_id AS VARCHAR)), 1, 12) AS BIGINT) % 6 AS INTEGER)) AS DATE) AS month
  FROM f WHERE NOT is_closed), g AS (SELECT month, sum(amount) * 0.3 AS r, count(*) AS n, avg(amount) AS a FROM s GROUP BY 1)
SELECT month, round(r, 2) AS forecasted_revenue, n AS deal_count, round(a, 4) AS avg_deal_size, round(r * 0.7, 2) AS lower_bound, round(r * 1.3, 2) AS upper_bound FROM g""", "deals")
def a24_fallback(spark, sf):
    out = crm.fallback_forecast(_deals(spark, sf).where("NOT is_closed"), dt.datetime(2001, 7, 15))
    digits = {"forecasted_revenue": 2, "avg_deal_size": 4, "lower_bound": 2, "upper_bound": 2}
    return out.withColumns({c: F.round(c, n) for c, n in digits.items()})


# Qualification and recommendations --------------------------------------------------------------


def sql_words(words, expr):
    return " OR ".join(f"contains({expr}, '{w}')" for w in words)


def sql_hits(words, expr):
    return "(" + " + ".join(f"contains({expr}, '{w}')::INT" for w in words) + ")"


QUALIFIED = f"""{LEADS}, q0 AS (SELECT *, lower(coalesce(company, '')) AS lc, lower(email) AS le, (contact_id * 37 % 1000) / 1000e0 AS draw, days_created / 365.25e0 AS years FROM features),
 q1 AS (SELECT *, {sql_hits(rules.OWNER_WORDS, 'lc')} * 30 + CASE WHEN {sql_words(rules.FARM_MAIL, 'le')} THEN 25 ELSE 0 END + CASE WHEN {sql_words(rules.CONSUMER_MAIL, 'le')} THEN 0 ELSE 15 END
    + CASE WHEN {sql_words(rules.LEADER_TITLES, "lower(coalesce(jobtitle, ''))")} THEN 20 ELSE 0 END AS ow,
   least({sql_hits(rules.FARM_WORDS, 'lc')} * 15, 50) + CASE WHEN {sql_words(rules.FARM_INDUSTRIES, "lower(coalesce(company_industry, ''))")} THEN 40 ELSE 0 END + CASE WHEN coalesce(company_size, 0) > 10 THEN 15 ELSE 0 END AS bu,
   CASE WHEN years <= 1 THEN 50 WHEN years <= 2 THEN 35 WHEN years <= 3 THEN 20 ELSE 5 END AS ti,
   CASE company_state {' '.join(f"WHEN '{s}' THEN {w * 10}" for s, w in rules.STATE_WEIGHTS.items())} ELSE 0 END + CASE WHEN {sql_words(rules.RURAL_WORDS, "lower(coalesce(company_city, ''))")} THEN 20 ELSE 0 END AS re0 FROM q0),
 q2 AS (SELECT *, CASE WHEN re0 = 0 THEN 40 ELSE re0 END AS re FROM q1),
 q3 AS (SELECT *, ow >= 30 AND bu >= 25 AND ti >= 20 AND re >= 30 AS eligible, least(ow, 100) AS o1, least(bu, 100) AS b1, ti AS t1, least(re, 100) AS r1 FROM q2),
 q4 AS (SELECT *, (o1 + b1 + t1 + r1) / 4e0 AS mean, o1 / 100e0 * 0.4e0 + b1 / 100e0 * 0.3e0 + t1 / 100e0 * 0.2e0 + r1 / 100e0 * 0.1e0 AS confidence,
   greatest(50.0, (CASE WHEN company_revenue > 10000000 THEN 1000 WHEN company_revenue > 5000000 THEN 600 WHEN company_revenue > 1000000 THEN 300 WHEN company_size > 100 THEN 500 WHEN company_size > 50 THEN 300
     WHEN company_size > 20 THEN 200 ELSE 100 END) * (0.7e0 + 0.8e0 * draw)) AS acres FROM q3),
 q5 AS (SELECT *, CASE WHEN mean >= 80 THEN 'Premium' WHEN mean >= 60 THEN 'High' WHEN mean >= 40 THEN 'Medium' WHEN mean >= 20 THEN 'Low' ELSE 'Disqualified' END AS tier FROM q4),
 q6 AS (SELECT *, acres * (CASE tier WHEN 'Premium' THEN 1.3e0 WHEN 'High' THEN 1.1e0 WHEN 'Medium' THEN 1e0 WHEN 'Low' THEN 0.8e0 ELSE 0e0 END * 1125) * 0.35e0 AS savings FROM q5),
 q7 AS (SELECT *, CASE WHEN savings >= 100000 THEN 'Enterprise' WHEN savings >= 50000 THEN 'High-Value' WHEN savings >= 20000 THEN 'Medium-Value' WHEN savings >= 5000 THEN 'Standard' ELSE 'Low-Value' END AS vt,
   CASE WHEN eligible THEN mean * 0.6 + least(100.0, savings / 50000 * 100) * 0.4 ELSE 0 END AS final FROM q6)"""


def _qualified(spark, sf):
    seed = (F.col("contact_id") * 37 % 1000) / 1000
    return rules.qualify(_leads(spark, sf), AS_OF, seed)


@query("r01_qualification", f"WITH {QUALIFIED} SELECT contact_id, CAST(o1 AS BIGINT) AS ownership_score, CAST(b1 AS BIGINT) AS business_score, CAST(t1 AS BIGINT) AS timing_score, CAST(r1 AS BIGINT) AS region_score, eligible FROM q7", T)
def r01(spark, sf):
    names = ["ownership_score", "business_score", "timing_score", "region_score"]
    return _qualified(spark, sf).select("contact_id", *[F.col(c).cast("bigint").alias(c) for c in names], "eligible")


@query("r01_indicators", f"""WITH {LEADS} SELECT contact_id, CAST({sql_hits(rules.OWNER_WORDS, "lower(coalesce(company, ''))")} + ({sql_words(rules.FARM_MAIL, 'lower(email)')})::INT
  + (NOT ({sql_words(rules.CONSUMER_MAIL, 'lower(email)')}))::INT + ({sql_words(rules.LEADER_TITLES, "lower(coalesce(jobtitle, ''))")})::INT AS BIGINT) AS indicators FROM leads""", T)
def r01_indicators(spark, sf):
    return _leads(spark, sf).select("contact_id", F.size(rules.indicators()).cast("bigint").alias("indicators"))


@query("r01_rule_indicators", f"""WITH {LEADS}, i AS (SELECT *, lower(coalesce(company, '')) AS lc, lower(coalesce(company_industry, '')) AS li, upper(coalesce(company_state, '')) AS st, lower(coalesce(company_city, '')) AS ci,
   days_created / 365.25e0 AS years, CASE upper(coalesce(company_state, '')) {' '.join(f"WHEN '{s}' THEN {w}" for s, w in rules.STATE_WEIGHTS.items())} END AS weight FROM features),
 h AS (SELECT *, {sql_hits(rules.FARM_WORDS, 'lc')} AS terms FROM i),
 r AS (SELECT *, concat_ws('; ', CASE WHEN weight IS NOT NULL THEN 'Located in agricultural state ' || st || ' (score: ' || weight || '/10)' END,
   CASE WHEN {sql_words(rules.RURAL_WORDS, 'ci')} THEN 'City name suggests rural/agricultural area' END) AS region FROM h)
SELECT contact_id, concat_ws('; ', CASE WHEN terms > 0 THEN 'Company name contains ' || terms || ' agricultural terms' END, CASE WHEN {sql_words(rules.FARM_INDUSTRIES, 'li')} THEN 'Industry classified as agricultural' END,
  CASE WHEN coalesce(company_size, 0) > 10 THEN 'Substantial company size' END) AS business,
  CASE WHEN created IS NULL THEN 'No timing data available - assuming moderate eligibility' WHEN years <= 1 THEN 'Very recent contact creation (likely recent acquisition)' WHEN years <= 2 THEN 'Recent contact creation'
    WHEN years <= 3 THEN 'Moderately recent contact' ELSE 'Older contact' END AS timing,
  CASE WHEN region = '' THEN 'Location unknown - assuming moderate agricultural potential' ELSE region END AS region FROM r""", T)
def r01_rules(spark, sf):
    """Reasons of the business, timing and region rules, joined as texts."""
    found = rules.rule_indicators(AS_OF)
    return _leads(spark, sf).select("contact_id", *[F.array_join(found[n], "; ").alias(n) for n in ("business", "timing", "region")])


@query("r02_confidence_tier", f"WITH {QUALIFIED} SELECT contact_id, round(confidence, 8) AS confidence_score, tier AS qualification_tier FROM q7", T)
def r02(spark, sf):
    return _qualified(spark, sf).select("contact_id", F.round("confidence_score", 8).alias("confidence_score"), "qualification_tier")


@query("r03_value_estimate", f"WITH {QUALIFIED} SELECT contact_id, round(acres, 6) AS estimated_acres, round(savings, 4) AS estimated_tax_savings, round(savings * 0.125, 4) AS service_revenue_potential, vt AS value_tier FROM q7", T)
def r03(spark, sf):
    return _qualified(spark, sf).select(
        "contact_id", F.round("estimated_acres", 6).alias("estimated_acres"), F.round("estimated_tax_savings", 4).alias("estimated_tax_savings"),
        F.round("service_revenue_potential", 4).alias("service_revenue_potential"), "value_tier",
    )


@query("r04_final_score", f"WITH {QUALIFIED} SELECT contact_id, eligible, round(final, 6) AS qualification_score FROM q7", T)
def r04(spark, sf):
    return _qualified(spark, sf).select("contact_id", "eligible", F.round("qualification_score", 6).alias("qualification_score"))


SEGMENT = """CASE WHEN NOT eligible OR tier = 'Disqualified' THEN 'Disqualified' WHEN vt = 'Enterprise' AND tier IN ('Premium', 'High') THEN 'Enterprise Landowners'
  WHEN tier = 'Premium' AND savings >= 20000 THEN 'Premium Agricultural Clients' WHEN tier IN ('High', 'Premium') AND vt IN ('High-Value', 'Medium-Value') THEN 'Active Farmers'
  WHEN tier IN ('Medium', 'High') AND savings >= 5000 THEN 'Agricultural Investors' WHEN tier = 'Medium' THEN 'Potential Agricultural Prospects' WHEN tier = 'Low' THEN 'Low-Priority Agricultural Leads' ELSE 'Unqualified' END"""


@query("r05_segments", f"WITH {QUALIFIED} SELECT contact_id, {SEGMENT} AS segment FROM q7", T)
def r05(spark, sf):
    return rules.assign_segment(_qualified(spark, sf)).select("contact_id", "segment")


RULES = """ r AS (SELECT *,
   coalesce(lead_score >= 0.3 AND lead_score <= 0.7, true) AND lifecyclestage IN ('subscriber', 'lead', 'marketingqualifiedlead') AND days_since_created BETWEEN 7 AND 90 AS nurture,
   lead_score >= 0.7 AND lifecyclestage IN ('marketingqualifiedlead', 'salesqualifiedlead') AND engagement_score >= 0.6 AS accelerate,
   churn_risk_score >= 0.6 AND days_since_last_activity >= 30 AS prevent, lifecyclestage = 'customer' AND total_deals >= 1 AND churn_risk_score <= 0.3 AS expand,
   days_since_last_activity >= 60 AND churn_risk_score BETWEEN 0.4 AND 0.7 AS reengage, coalesce(completeness_score <= 0.5, true) AND engagement_score >= 0.3 AS enrich FROM scored),
 s AS (SELECT *, CASE WHEN prevent THEN 'churn_prevention' WHEN accelerate THEN 'sales_acceleration' WHEN nurture THEN 'lead_nurturing' WHEN expand THEN 'customer_expansion'
   WHEN reengage THEN 're_engagement' WHEN enrich THEN 'data_enrichment' ELSE 'maintenance' END AS strategy,
   CASE WHEN prevent THEN 'critical' WHEN accelerate THEN 'high' WHEN nurture OR expand OR reengage THEN 'medium' ELSE 'low' END AS priority FROM r),
 p AS (SELECT *, CASE priority WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END + lead_score * 2 + churn_risk_score * 3 AS score FROM s),
 ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS action_rank FROM p),
 planned AS (SELECT *, CASE WHEN (action_rank - 1) // greatest(10, (SELECT count(*) FROM p) // 30) < 30 THEN (action_rank - 1) // greatest(10, (SELECT count(*) FROM p) // 30) END AS plan_day FROM ranked)"""


def _recommended(spark, sf):
    return rules.recommend(table(spark, sf, "scored"))


def _planned(spark, sf):
    return rules.schedule(rules.prioritise(_recommended(spark, sf)))


@query("r06_recommendations", f"""WITH {RULES} SELECT id, strategy AS primary_strategy, priority, CAST(prevent::INT + accelerate::INT + nurture::INT + expand::INT + reengage::INT + enrich::INT AS BIGINT) AS rules,
  CAST(CASE WHEN strategy = 'maintenance' THEN 2 ELSE 3 END AS BIGINT) AS actions FROM s""", "scored")
def r06(spark, sf):
    return _recommended(spark, sf).select(
        "id", "primary_strategy", "priority", F.size("applicable_rules").cast("bigint").alias("rules"), F.size("recommended_actions").cast("bigint").alias("actions")
    )


@query("r07_contextual_actions", """SELECT id, concat_ws('|', CASE WHEN total_deals > 2 THEN 'Assign dedicated account manager' END, CASE WHEN days_since_created < 30 THEN 'Include in new customer onboarding sequence' END,
  CASE WHEN engagement_score > 0.8 THEN 'Consider for customer advocacy program' WHEN engagement_score < 0.3 THEN 'Focus on engagement improvement' END,
  CASE WHEN completeness_score < 0.4 THEN 'Prioritize data collection and enrichment' END, CASE WHEN predicted_segment LIKE 'Enterprise%' THEN 'Offer enterprise-level support and features'
  WHEN predicted_segment LIKE 'Small%' THEN 'Provide SMB-focused resources and pricing' END) AS actions FROM scored""", "scored")
def r07(spark, sf):
    return table(spark, sf, "scored").select("id", F.array_join(rules.contextual_actions(), "|").alias("actions"))


@query("r08_priority_rank", f"WITH {RULES} SELECT id, round(score, 6) AS priority_score, action_rank FROM ranked", "scored")
def r08(spark, sf):
    return rules.prioritise(_recommended(spark, sf)).select("id", F.round("priority_score", 6).alias("priority_score"), "action_rank")


@query("a21_campaigns", f"WITH {RULES} SELECT strategy AS primary_strategy, count(*) AS customers FROM s GROUP BY 1 HAVING count(*) > 10 ORDER BY customers DESC, primary_strategy LIMIT 3", "scored")
def a21(spark, sf):
    return rules.strategic_programs(_recommended(spark, sf))


@query("a21_priority_counts", f"WITH {RULES} SELECT priority, count(*) AS customers FROM s GROUP BY 1", "scored")
def a21_priorities(spark, sf):
    return rules.campaign_counts(_recommended(spark, sf))


@query("a22_daily_plan", f"""WITH {RULES} SELECT CAST(plan_day AS BIGINT) AS plan_day, count(*) AS customers, count(*) FILTER (WHERE priority = 'critical') AS critical, count(*) FILTER (WHERE priority = 'high') AS high,
  count(*) FILTER (WHERE priority = 'medium') AS medium, count(*) FILTER (WHERE priority = 'low') AS low FROM planned WHERE plan_day IS NOT NULL GROUP BY 1""", "scored")
def a22(spark, sf):
    return rules.daily_plan(_planned(spark, sf))


@query("a22_daily_actions", f"""WITH {RULES}, acts AS (SELECT plan_day, unnest(CASE strategy {' '.join("WHEN '%s' THEN [%s]" % (n, ', '.join("'%s'" % a for a in acts)) for n, _, acts in rules.STRATEGIES)}
   ELSE ['Monitor customer activity', 'Maintain regular communication'] END) AS action FROM planned WHERE plan_day IS NOT NULL), c AS (SELECT plan_day, action, count(*) AS customers FROM acts GROUP BY 1, 2)
 SELECT CAST(plan_day AS BIGINT) AS plan_day, action, customers, CAST(row_number() OVER (PARTITION BY plan_day ORDER BY customers DESC, action) AS BIGINT) AS rank FROM c QUALIFY rank <= 5""", "scored")
def a22_actions(spark, sf):
    return rules.daily_actions(_planned(spark, sf)).withColumn("rank", F.col("rank").cast("bigint"))


@query("a22_resource_needs", f"""WITH {RULES} SELECT count(*) FILTER (WHERE strategy IN ('sales_acceleration', 'customer_expansion')) AS sales_team, count(*) FILTER (WHERE strategy IN ('lead_nurturing', 're_engagement')) AS marketing_team,
  count(*) FILTER (WHERE strategy = 'churn_prevention') AS customer_success, count(*) FILTER (WHERE strategy = 'data_enrichment') AS data_team,
  round(count(*) FILTER (WHERE priority IN ('high', 'critical')) * 0.2e0, 6) AS target_conversions, round(count(*) FILTER (WHERE strategy = 'churn_prevention') * 0.7e0, 6) AS churn_prevention_target,
  round(count(*) FILTER (WHERE strategy = 're_engagement') * 0.4e0, 6) AS engagement_target FROM s""", "scored")
def a22_needs(spark, sf):
    out = rules.resource_needs(_recommended(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("target_conversions", "churn_prevention_target", "engagement_target")})


@query("r09_retention_advice", f"""SELECT category AS churn_risk_category, CAST(CASE category WHEN 'Critical' THEN 7 WHEN 'High' THEN 7 WHEN 'Medium' THEN 6 WHEN 'Low' THEN 5 END AS BIGINT) AS advice, count(*) AS customers
FROM (SELECT {SCORE_BIN.format('churn_risk_score', 'Critical')} AS category FROM scored) GROUP BY ALL""", "scored")
def r09(spark, sf):
    s = table(spark, sf, "scored").withColumn("churn_risk_category", reports.risk_category(F.col("churn_risk_score")))
    out = rules.retention_advice(s, ["days_since_last_activity", "deal_momentum", "account_age_months"])
    n = F.when(F.col("retention_advice").isNotNull(), F.size("retention_advice")).cast("bigint")
    return out.groupBy("churn_risk_category", n.alias("advice")).agg(F.count(F.lit(1)).alias("customers"))


@query("r10_segment_names", """SELECT company AS cluster, CASE WHEN e > 0.7 AND l > 0.7 AND d > 0.5 THEN 'Enterprise Champions' WHEN e > 0.7 AND l > 0.7 THEN 'Enterprise Prospects' WHEN e > 0.7 AND d > 0.5 THEN 'Active Customers'
  WHEN e > 0.5 AND l > 0.5 THEN 'Qualified Prospects' WHEN e > 0.5 THEN 'Engaged Leads' WHEN l > 0.7 THEN 'Enterprise Dormant' WHEN d > 0.3 THEN 'Occasional Buyers' ELSE 'Cold Leads' END AS segment_name,
  CAST(CASE WHEN e < 0.6 THEN 2 ELSE 0 END + CASE WHEN d < 0.2 OR v < 10 THEN 2 ELSE 0 END + CASE WHEN l > 0.7 OR l < 0.3 THEN 2 ELSE 0 END + CASE WHEN c < 0.3 THEN 2 ELSE 0 END AS BIGINT) AS actions FROM (
  SELECT company, round(avg(engagement_score), 6) AS e, round(avg(lead_score), 6) AS l, round(avg(total_deals) / 5, 6) AS d, round(avg(churn_risk_score), 6) AS c, round(avg((lifecyclestage = 'customer')::INT) * 100, 6) AS v FROM scored GROUP BY 1)""", "scored")
def r10(spark, sf):
    s = table(spark, sf, "scored")
    m = s.groupBy(F.col("company").alias("cluster")).agg(
        F.round(F.avg("engagement_score"), 6).alias("e"), F.round(F.avg("lead_score"), 6).alias("l"), F.round(F.avg("total_deals") / 5, 6).alias("d"),
        F.round(F.avg("churn_risk_score"), 6).alias("c"), F.round(F.avg(crm.conversion_target(F.col("lifecyclestage"))) * 100, 6).alias("v"),
    )
    cols = [F.col(c) for c in ("e", "l", "d", "c", "v")]
    return m.select("cluster", rules.segment_name(*cols[:3]).alias("segment_name"), F.size(rules.segment_actions(*cols)).cast("bigint").alias("actions"))


@query("r16_report_rows", f"""WITH {RULES} SELECT 'summary' AS section, 'total_customers' AS key, CAST(count(*) AS DOUBLE) AS value FROM s UNION ALL SELECT 'summary', 'requiring_action', count(*) FILTER (WHERE priority <> 'low') FROM s
 UNION ALL SELECT 'priority', priority, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'strategy', strategy, n FROM (SELECT strategy, count(*) AS n FROM s GROUP BY 1 ORDER BY n DESC, strategy LIMIT 5)""", "scored")
def r16(spark, sf):
    return reports.recommendation_report(_recommended(spark, sf))


@query("r16_churn_report", """WITH n AS (SELECT count(*) AS n FROM scored), c AS (SELECT CASE WHEN churn_risk_score <= 0 THEN NULL WHEN churn_risk_score <= 0.3 THEN 'Low' WHEN churn_risk_score <= 0.6 THEN 'Medium'
   WHEN churn_risk_score <= 0.8 THEN 'High' WHEN churn_risk_score <= 1 THEN 'Critical' END AS category FROM scored)
SELECT 'summary' AS section, 'total_customers' AS key, CAST(n AS DOUBLE) AS value FROM n UNION ALL SELECT 'summary', 'avg_risk_score', round(avg(churn_risk_score), 6) FROM scored
 UNION ALL SELECT 'summary', 'high_risk_count', count(*) FILTER (churn_risk_score > 0.7) FROM scored UNION ALL SELECT 'summary', 'critical_risk_count', count(*) FILTER (churn_risk_score > 0.8) FROM scored
 UNION ALL SELECT 'risk_distribution', category, count(*) FROM c WHERE category IS NOT NULL GROUP BY 2 UNION ALL SELECT 'risk_percentage', category, round(count(*) / any_value(n) * 100, 6) FROM c, n WHERE category IS NOT NULL GROUP BY 2
 UNION ALL SELECT * FROM (SELECT 'top_at_risk', email, churn_risk_score FROM scored ORDER BY churn_risk_score DESC, email LIMIT 5)""", "scored")
def r16_churn(spark, sf):
    out = reports.churn_report(table(spark, sf, "scored"), "email")
    return out.withColumn("value", F.round("value", 6))


@query("r16_segment_report", """WITH n AS (SELECT count(*) AS n FROM scored), g AS (SELECT predicted_segment AS s, count(*) AS size, avg(engagement_score) AS e, avg(lead_score) AS l, avg(total_deals) AS d, avg((total_deals > 0)::INT) * 100 AS p FROM scored GROUP BY 1)
SELECT s AS section, k AS key, round(v, 6) AS value FROM (SELECT s, unnest(['size', 'percentage', 'avg_engagement_score', 'avg_lead_score', 'avg_deals', 'deal_creators_pct']) AS k,
  unnest([size::DOUBLE, size / n * 100, e, l, d, p]) AS v FROM g, n)""", "scored")
def r16_segments(spark, sf):
    rows = table(spark, sf, "scored")
    business = rows.groupBy("predicted_segment").agg(F.avg("total_deals").alias("avg_deals"), (F.avg((F.col("total_deals") > 0).cast("double")) * 100).alias("deal_creators_pct"))
    out = reports.segment_report(rows, ["engagement_score", "lead_score"], business, "predicted_segment")
    return out.withColumn("value", F.round("value", 6))


@query("r16_analytics_report", f"""WITH {DEALS}, o AS (SELECT amount, stage_probability, date_trunc('month', createdate + (to_days(CAST(days_open + 360 AS INTEGER)))) AS month FROM f WHERE NOT is_closed),
 p AS (SELECT month, sum(amount * stage_probability) AS r FROM o WHERE month BETWEEN TIMESTAMP '2001-07-01' AND TIMESTAMP '2001-12-01' GROUP BY 1)
SELECT 'forecast' AS section, 'months' AS key, 6.0::DOUBLE AS value UNION ALL SELECT 'forecast', 'total_forecasted_revenue', round(coalesce(sum(r), 0), 2) FROM p
 UNION ALL SELECT 'forecast', 'average_monthly_revenue', round(coalesce(sum(r), 0) / 6, 2) FROM p UNION ALL SELECT 'closure', 'auc', 0.8 UNION ALL SELECT 'closure', 'training_samples', count(*) FROM f WHERE is_closed""", "deals")
def r16_analytics(spark, sf):
    deals = _deals(spark, sf)
    open_ = deals.where("NOT is_closed").withColumns(
        {"closure_probability": F.col("stage_probability"), "estimated_close": F.date_add(F.col("createdate").cast("date"), (F.col("days_open") + 360).cast("int"))}
    )
    metrics = deals.where("is_closed").agg(F.lit("closure").alias("model"), F.lit(0.8).alias("auc"), F.count(F.lit(1)).alias("training_samples"))
    out = reports.analytics_report(metrics, crm.revenue_forecast(open_, dt.datetime(2001, 7, 15)))
    return out.withColumn("value", F.round("value", 2))


@query("ml25_attached_scores", """SELECT id, CASE WHEN id % 3 = 0 THEN lead_score ELSE 0.5 END AS lead_score, CASE WHEN id % 2 = 0 THEN churn_risk_score ELSE 0.3 END AS churn_risk_score, 'Segment_0' AS predicted_segment FROM scored""", "scored")
def ml25(spark, sf):
    s = table(spark, sf, "scored")
    out = rules.attach_scores(
        s.select("id"), s.select("id", F.when(F.col("id") % 3 == 0, F.col("lead_score")).alias("lead_score")),
        s.select("id", F.when(F.col("id") % 2 == 0, F.col("churn_risk_score")).alias("churn_risk_score")), None,
    )
    return out.select("id", "lead_score", "churn_risk_score", "predicted_segment")
