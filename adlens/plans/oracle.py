"""DuckDB oracle SQL for the registered queries.

Written the way the reference writes its reports (aggregate each side,
then left join) on top of the same adapter, so it checks the Spark plans
rather than repeating them.  Ratios use the same DOUBLE expression as the
Spark helpers (SURVEY D10, D12).
"""

from __future__ import annotations

from adlens.sources.adapter import ORACLE_ADAPTER_SQL

A = ORACLE_ADAPTER_SQL


def r2(x: str) -> str:
    """Half-up rounding to cents through DECIMAL(38,10), as ``metrics.round_half_up``."""
    return f"cast(round(cast({x} as decimal(38,10)), 2) as double)"


def ratio(num: str, den: str, scale: bool = False) -> str:
    top = f"cast({num} as double)" + (" * 100.0" if scale else "")
    return f"case when {den} > 0 then {r2(f'{top} / cast({den} as double)')} else 0.0 end"


def change(cur: str, prev: str, zero_base_as_one: bool = False) -> str:
    diff = f"(cast({cur} as double) - cast({prev} as double)) * 100.0"
    if zero_base_as_one:
        base = f"(case when {prev} <> 0 then cast({prev} as double) else 1.0 end)"
        return f"case when {prev} is not null then {r2(f'{diff} / {base}')} else 0.0 end"
    return (f"case when {prev} is not null and {prev} <> 0 "
            f"then {r2(f'{diff} / cast({prev} as double)')} else 0.0 end")


DAILY_TRAFFIC_CTE = f"""
dt as (
  select campaign_id, ad_group_id, event_date as date,
         cast(sum(impressions) as bigint) as total_impressions,
         cast(sum(clicks) as bigint) as total_clicks,
         cast(sum(cost) as decimal(38,4)) as total_cost
  from traffic where impressions >= 0
  group by campaign_id, ad_group_id, event_date),
dtm as (
  select *, {ratio('total_cost', 'total_clicks')} as cpc,
            {ratio('total_clicks', 'total_impressions', True)} as ctr
  from dt),
dc as (
  select campaign_id, ad_group_id, event_date as date,
         cast(sum(conversions) as bigint) as conversions_1d,
         cast(sum(sales) as decimal(38,4)) as sales_1d,
         cast(sum(units) as bigint) as units_ordered_1d
  from conversion
  group by campaign_id, ad_group_id, event_date),
dj as (
  select t.*, coalesce(c.conversions_1d, 0) as conversions_1d,
         coalesce(c.sales_1d, 0) as sales_1d,
         coalesce(c.units_ordered_1d, 0) as units_ordered_1d
  from dtm t left join dc c using (campaign_id, ad_group_id, date)),
dp as (
  select *, {ratio('total_cost', 'sales_1d', True)} as acos,
            {ratio('sales_1d', 'total_cost')} as roas,
            {ratio('conversions_1d', 'total_clicks', True)} as conversion_rate
  from dj)"""


def _avg8(c: str) -> str:
    w = "(w rows between 7 preceding and current row)"
    return f"cast(sum(cast({c} as decimal(38,2))) over {w} as double) / count({c}) over {w}"


TRENDS_CTE = f"""
tr as (
  select *, {_avg8('ctr')} as avg_ctr_7d,
            {_avg8('conversion_rate')} as avg_conversion_rate_7d,
            {_avg8('acos')} as avg_acos_7d,
            {_avg8('roas')} as avg_roas_7d,
            {change('total_impressions', 'lag(total_impressions) over w', True)} as impressions_change,
            {change('total_cost', 'lag(total_cost) over w')} as cost_change,
            {change('sales_1d', 'lag(sales_1d) over w')} as sales_change
  from dp
  window w as (partition by campaign_id, ad_group_id order by date)),
an0 as (
  select *, case when abs(ctr - lag(ctr) over w) > 50.0 then 1 else 0 end as ctr_anomaly,
            case when abs(acos - lag(acos) over w) > 30.0 then 1 else 0 end as acos_anomaly,
            case when abs(conversion_rate - lag(conversion_rate) over w) > 40.0 then 1 else 0 end
              as conversion_anomaly
  from tr
  window w as (partition by campaign_id, ad_group_id order by date)),
an as (
  select *, case when ctr_anomaly = 1 or acos_anomaly = 1 or conversion_anomaly = 1 then 1 else 0 end
              as has_anomaly
  from an0)"""


ORACLE: dict[str, str] = {
    "daily_traffic": f"with {A}, {DAILY_TRAFFIC_CTE} select * from dtm",
    "daily_conversions": f"with {A}, {DAILY_TRAFFIC_CTE} select * from dc",
    "daily_performance": f"with {A}, {DAILY_TRAFFIC_CTE} select * from dp",
    "performance_trends": f"with {A}, {DAILY_TRAFFIC_CTE}, {TRENDS_CTE} select * from tr",
    "anomalies": f"with {A}, {DAILY_TRAFFIC_CTE}, {TRENDS_CTE} select * from an",
    "anomalies_since": f"with {A}, {DAILY_TRAFFIC_CTE}, {TRENDS_CTE} "
                       "select * from an where date >= date '2024-01-20'",
}


# --- window reports (C7-C10) ---------------------------------------------------

AS_OF = "2024-01-15"
DATE_FILTERS = {
    "today": "event_date = date '2024-01-15'",
    "yesterday": "event_date = date '2024-01-14'",
    "last7days": "event_date between date '2024-01-08' and date '2024-01-15'",
    "last7days_unbounded": "event_date >= date '2024-01-08'",
}


def report_cte(keys: list[str], window: str | None, campaign: str | None = None,
               name: str = "rep") -> str:
    """CTEs ending in ``name``: the reference's report query at the grain of ``keys``."""
    df = f"where {DATE_FILTERS[window]}" if window else ""
    k = ", ".join(keys)
    sel = "".join(f"{x}, " for x in keys)
    on = " and ".join(f"t.{x} = c.{x}" for x in keys)
    tsel = "".join(f"t.{x}, " for x in keys)
    where = f"where t.campaign_id = '{campaign}'" if campaign else ""
    group = f"group by {k}" if keys else ""
    join = f"left join {name}_conv c on {on}" if keys else f", {name}_conv c"
    return f"""{name}_conv as (
  select {sel}cast(sum(conversions) as bigint) as total_order, cast(sum(sales) as decimal(38,4)) as total_sales,
         cast(sum(units) as bigint) as total_units
  from conversion {df} {group}),
{name}_traff as (
  select {sel}cast(sum(impressions) as bigint) as total_impression, cast(sum(cost) as decimal(38,4)) as total_cost,
         cast(sum(clicks) as bigint) as total_click
  from traffic {df} {group}),
{name} as (
  select {tsel}t.total_impression, t.total_click, cast(round(t.total_cost, 2) as decimal(38,2)) as spend,
         c.total_order, cast(round(c.total_sales, 2) as decimal(38,2)) as sales, c.total_units,
         {ratio('t.total_cost', 'c.total_sales', True)} as acos,
         {ratio('c.total_sales', 't.total_cost')} as roas,
         {ratio('c.total_order', 't.total_click', True)} as conversion,
         {ratio('t.total_click', 't.total_impression', True)} as ctr
  from {name}_traff t {join} {where})"""


def report_sql(keys: list[str], window: str, campaign: str | None = None) -> str:
    return f"with {A}, {report_cte(keys, window, campaign)} select * from rep"


KW_ORDER = ("order by cost desc nulls last, campaign_id nulls last, keyword_id nulls last, "
            "keyword_text nulls last, match_type nulls last limit 10")
KW_RATIOS = f"""{ratio('cost', 'sales', True)} as acos, {ratio('sales', 'cost')} as roas,
       {ratio('conversions', 'clicks', True)} as conversion_rate,
       {ratio('clicks', 'impressions', True)} as ctr"""


def keyword_attributed_sql(campaign: str | None = None, keyword: str | None = None) -> str:
    df = DATE_FILTERS["last7days"]
    cf = f"and campaign_id = '{campaign}'" if campaign else ""
    kf = f"and keyword_text like '%{keyword}%'" if keyword else ""
    return f"""with {A},
tk as (
  select campaign_id, keyword_id, keyword_text, match_type,
         cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks,
         cast(sum(cost) as decimal(38,4)) as cost
  from traffic where {df} and keyword_text is not null {cf} {kf}
  group by campaign_id, keyword_id, keyword_text, match_type),
ck as (
  select campaign_id, keyword_id, cast(sum(conversions) as bigint) as conversions,
         cast(sum(sales) as decimal(38,4)) as sales
  from conversion where {df} {cf} group by campaign_id, keyword_id),
j as (select tk.*, ck.conversions, ck.sales from tk left join ck using (campaign_id, keyword_id))
select *, {KW_RATIOS} from j {KW_ORDER}"""


# The reference's raw join, pairs and all: DuckDB enumerates every pair here.
KEYWORD_AS_WRITTEN_SQL = f"""with {A},
j as (
  select t.campaign_id, t.keyword_id, t.keyword_text, t.match_type,
         cast(sum(t.impressions) as bigint) as impressions, cast(sum(t.clicks) as bigint) as clicks,
         cast(sum(t.cost) as decimal(38,4)) as cost,
         cast(sum(c.conversions) as bigint) as conversions, cast(sum(c.sales) as decimal(38,4)) as sales
  from traffic t
  left join conversion c
    on t.campaign_id = c.campaign_id and t.ad_group_id = c.ad_group_id
   and t.time_window_start = c.time_window_start
  where t.{DATE_FILTERS['last7days']} and t.keyword_text is not null
  group by t.campaign_id, t.keyword_id, t.keyword_text, t.match_type)
select *, {KW_RATIOS} from j {KW_ORDER}"""

ORACLE.update({
    "report_today": report_sql(["campaign_id", "ad_group_id"], "today"),
    "report_yesterday": report_sql(["campaign_id", "ad_group_id"], "yesterday"),
    "report_last7days": report_sql(["campaign_id", "ad_group_id"], "last7days"),
    "report_last7days_unbounded": report_sql(["campaign_id", "ad_group_id"], "last7days_unbounded"),
    "campaign_report": report_sql(["campaign_id"], "last7days"),
    "campaign_report_one": report_sql(["campaign_id"], "yesterday", "7"),
    "account_report": report_sql([], "last7days"),
    "keyword_report_attributed": keyword_attributed_sql(),
    "keyword_report_as_written": KEYWORD_AS_WRITTEN_SQL,
    "keyword_search": keyword_attributed_sql("7", "kw 1"),
})


# --- summary, alerts, rules, history (C11-C17) -----------------------------------

REP7 = report_cte(["campaign_id", "ad_group_id"], "last7days")
SUMMARY_COLS = ("total_campaigns, total_ad_groups, total_impressions, total_clicks, total_spend, "
                "total_orders, total_sales, total_units, overall_acos, overall_roas, "
                "overall_conversion, overall_ctr")


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def num_text(x: str) -> str:
    """Same text as ``metrics.num_text``: two decimals, one trailing zero dropped."""
    return f"regexp_replace(printf('%.2f', cast({x} as double)), '(\\.\\d)0$', '\\1')"


def value_text(x: str) -> str:
    return f"case when {x} is null then '0' else {num_text(x)} end"


def summary_cte(source: str, by: str | None = None) -> str:
    group = f"group by {by}" if by else ""
    sel = f"{by}, " if by else ""

    def of_sums(num, den, pct):
        q = f"cast({num} as double) / cast({den} as double)" + (" * 100.0" if pct else "")
        return f"case when {den} > 0 then {r2(q)} else 0.0 end"

    return f"""summ0 as (
  select {sel}count(distinct campaign_id) as total_campaigns, count(distinct ad_group_id) as total_ad_groups,
         coalesce(cast(sum(total_impression) as bigint), 0) as total_impressions,
         coalesce(cast(sum(total_click) as bigint), 0) as total_clicks,
         coalesce(cast(sum(spend) as decimal(38,2)), 0) as total_spend,
         coalesce(cast(sum(total_order) as bigint), 0) as total_orders,
         coalesce(cast(sum(sales) as decimal(38,2)), 0) as total_sales,
         coalesce(cast(sum(total_units) as bigint), 0) as total_units,
         count(*) as report_rows,
         count(*) filter (where roas < 2.0) as low_performing,
         count(*) filter (where roas >= 2.0 and roas < 4.0) as average_performing,
         count(*) filter (where roas >= 4.0) as high_performing,
         count(*) filter (where acos > 35.0) as high_acos,
         count(*) filter (where acos <= 35.0 and acos > 20.0) as target_acos,
         count(*) filter (where acos <= 20.0) as low_acos
  from {source} {group}),
summ as (
  select *, {of_sums('total_spend', 'total_sales', True)} as overall_acos,
            {of_sums('total_sales', 'total_spend', False)} as overall_roas,
            {of_sums('total_orders', 'total_clicks', True)} as overall_conversion,
            {of_sums('total_clicks', 'total_impressions', True)} as overall_ctr
  from summ0)"""


def _acc_alert(level, kind, cond, *parts):
    msg = " || ".join(parts)
    return (f"select '{level}' as level, '{kind}' as type, cast(null as varchar) as campaign_id, "
            f"cast(null as varchar) as ad_group_id, {msg} as message from acc where {cond}")


ROAS_T = f"(case when total_spend > 0 then {num_text('overall_roas')} else '0' end)"
ACOS_T = f"(case when total_sales > 0 then {num_text('overall_acos')} else '0' end)"
SPEND_T = num_text("total_spend")

# The alert sentences and their banners.
ALERTS_CTE = f"""{summary_cte('rep')},
acc as (select * from summ where report_rows > 0),
acc_alerts as (
  {_acc_alert('CRITICAL', 'ROAS', 'overall_roas < 1.0',
              sql_text('Overall ROAS is critically low at '), ROAS_T, sql_text(' (threshold: 1.0)'))}
  union all
  {_acc_alert('WARNING', 'ROAS', 'overall_roas >= 1.0 and overall_roas < 2.0',
              sql_text('Overall ROAS is below target at '), ROAS_T, sql_text(' (threshold: 2.0)'))}
  union all
  {_acc_alert('CRITICAL', 'ACOS', 'overall_acos > 50.0',
              sql_text('Overall ACOS is critically high at '), ACOS_T, sql_text('% (threshold: 50.0%)'))}
  union all
  {_acc_alert('WARNING', 'ACOS', 'overall_acos <= 50.0 and overall_acos > 35.0',
              sql_text('Overall ACOS is above target at '), ACOS_T, sql_text('% (threshold: 35.0%)'))}
  union all
  {_acc_alert('CRITICAL', 'SPEND', 'total_spend > 1000',
              sql_text('Daily spend is critically high at $'), SPEND_T, sql_text(' (threshold: $1000.0)'))}
  union all
  {_acc_alert('WARNING', 'SPEND', 'total_spend <= 1000 and total_spend > 500',
              sql_text('Daily spend is high at $'), SPEND_T, sql_text(' (threshold: $500.0)'))}),
row_alerts as (
  select 'WARNING' as level, 'CAMPAIGN' as type, campaign_id, ad_group_id,
         'Campaign ' || campaign_id || ' has high spend ($' || {value_text('spend')} || ') with low ROAS ('
           || {value_text('roas')} || ')' as message
  from rep where coalesce(cast(spend as double), 0.0) > 100 and coalesce(roas, 0.0) < 2.0
  union all
  select 'CRITICAL', 'CAMPAIGN', campaign_id, ad_group_id,
         'Campaign ' || campaign_id || ' has very poor performance: ROAS ' || {value_text('roas')}
           || ', ACOS ' || {value_text('acos')} || '%'
  from rep where coalesce(cast(spend as double), 0.0) > 50 and coalesce(roas, 0.0) < 1.0),
all_alerts as (select * from acc_alerts union all select * from row_alerts)"""

NL = "chr(10)"
ALERT_DIGEST_SQL = f"""with {A}, {REP7}, {ALERTS_CTE},
body as (
  select level, 1 as part, case when type = 'CAMPAIGN' then 1 else 0 end as source,
         cast(case type when 'ROAS' then 1 when 'ACOS' then 2 when 'SPEND' then 3 else 4 end as bigint)
           as type_rank,
         campaign_id, ad_group_id, '- ' || message || {NL} as fragment
  from all_alerts),
lv as (select distinct level from body)
select level, 0 as part, 0 as source, cast(0 as bigint) as type_rank, cast(null as varchar) as campaign_id,
       cast(null as varchar) as ad_group_id,
       case level when 'CRITICAL' then {sql_text('🚨 CRITICAL ALERTS 🚨')} || {NL} || {NL}
                  else {sql_text('⚠️ WARNING ALERTS ⚠️')} || {NL} || {NL} end as fragment
from lv
union all select * from body
union all
select level, 2, 0, cast(0 as bigint), cast(null as varchar), cast(null as varchar),
       case level when 'CRITICAL' then {NL} || 'Immediate action recommended!'
                  else {NL} || 'Please review and take appropriate action.' end
from lv"""

ANOMALY_DIGEST_SQL = f"""with {A}, {DAILY_TRAFFIC_CTE}, {TRENDS_CTE},
fl as (select * from an where has_anomaly = 1),
top as (select * from fl order by date, campaign_id, ad_group_id limit 10),
blocks as (
  select string_agg('Campaign ' || campaign_id || ' on ' || strftime(date, '%Y-%m-%d') || ':' || {NL}
           || (case when ctr_anomaly = 1 then '- CTR anomaly detected' || {NL} else '' end)
           || (case when acos_anomaly = 1 then '- ACOS anomaly detected' || {NL} else '' end)
           || (case when conversion_anomaly = 1 then '- Conversion rate anomaly detected' || {NL} else '' end)
           || {NL}, '' order by date, campaign_id, ad_group_id) as txt
  from top),
cnt as (select count(*) as anomaly_count from fl)
select anomaly_count, {sql_text('🚨 Alert: ')} || cast(anomaly_count as varchar)
         || ' campaigns have performance anomalies!' || {NL} || {NL} || coalesce(txt, '') as message
from cnt, blocks where anomaly_count > 0"""


def rules_sql(source: str, keys: str, extra: str = "", branches=None) -> str:
    """One union branch per rule (the default ones); metrics missing -> 0."""
    m = {x: f"coalesce({x}, 0.0)" for x in ("acos", "roas", "conversion", "ctr")}
    # The default rules.
    branches = branches(m) if branches else [
        ("decrease_bid", 20, "roas < 1.0", f"{m['roas']} < 1.0",
         "ROAS below 1 is losing money, decrease bids by 20%"),
        ("increase_bid", 10, "roas >= 4.0", f"{m['roas']} >= 4.0",
         "ROAS above 4 is performing well, increase bids by 10% to gain more volume"),
        ("decrease_bid", 15, "acos > 40.0", f"{m['acos']} > 40.0",
         "ACOS above 40% is concerning, decrease bids by 15%"),
        ("increase_bid", 15, "conversion > 10.0 and roas >= 3.0",
         f"{m['conversion']} > 10.0 and {m['roas']} >= 3.0",
         "High conversion rate with good ROAS, increase bids by 15% to gain more volume"),
    ]
    metric_cols = (f"{m['acos']} as acos, {m['roas']} as roas, {m['conversion']} as conversion, "
                   f"{m['ctr']} as ctr, ") if extra else ""
    parts = []
    for action, pct, cond_text, cond, desc in branches:
        said = sql_text(desc) if desc is not None else "cast(null as varchar)"
        d = f", {said} as description" if extra else ""
        parts.append(f"select {keys}, {metric_cols}'{action}' as action, cast({pct} as double) as percentage{d}, "
                     f"{sql_text('Rule triggered: ' + cond_text)} as reason from {source} where {cond}")
    return "\nunion all\n".join(parts)


def history_sql(keep: int) -> str:
    rep_d = report_cte(["campaign_id", "ad_group_id", "event_date"], None)
    return f"""with {A}, {rep_d}, {summary_cte('rep', 'event_date')},
ranked as (select *, row_number() over (order by event_date desc) as rn from summ)
select 'all' as account_id, cast(event_date as timestamp) as timestamp, {SUMMARY_COLS},
       low_performing, average_performing, high_performing, high_acos, target_acos, low_acos
from ranked where rn <= {keep}"""


ORACLE.update({
    "account_summary": f"with {A}, {REP7}, {summary_cte('rep')} select {SUMMARY_COLS} from summ",
    "roas_distribution": f"with {A}, {REP7}, {summary_cte('rep')} "
                         "select low_performing, average_performing, high_performing from summ",
    "acos_distribution": f"with {A}, {REP7}, {summary_cte('rep')} "
                         "select high_acos, target_acos, low_acos from summ",
    "account_alerts": f"with {A}, {REP7}, {ALERTS_CTE} select * from acc_alerts",
    "row_alerts": f"with {A}, {REP7}, {ALERTS_CTE} select * from row_alerts",
    "alert_counts": f"with {A}, {REP7}, {ALERTS_CTE} "
                    "select level, count(*) as alert_count from all_alerts group by level",
    "alert_digest": ALERT_DIGEST_SQL,
    "anomaly_digest": ANOMALY_DIGEST_SQL,
    "bid_adjustments": f"with {A}, {REP7} {rules_sql('rep', 'campaign_id, ad_group_id')}",
    "rules_from_json": f"with {A}, {REP7} {rules_sql('rep', 'campaign_id, ad_group_id')}",
    "bid_recommendations": f"with {A}, {report_cte(['campaign_id'], 'last7days')} "
                           f"{rules_sql('rep', 'campaign_id', extra='metrics')}",
    "history_last30": history_sql(30),
    "history_latest10": history_sql(10),
    "text_to_number": """select event_id, json_extract_string(props, '$.k') as k_text,
       try_cast(json_extract_string(props, '$.k') as double) as k_number
from events""",
    "parquet_roundtrip": ORACLE["daily_performance"],
    "csv_roundtrip": ORACLE["daily_traffic"],
})


def _adhoc_oracle() -> str:
    from adlens.plans.registry import ADHOC_BODY, ADHOC_DAYS
    body = ADHOC_BODY
    for name, day in ADHOC_DAYS.items():
        body = body.replace(f":{name}", f"date '{day.isoformat()}'")
    return f"with {A}, {body}"


ORACLE["adhoc_sql"] = _adhoc_oracle()


# --- ingestion, documents, jobs, history table ------------------------------------------------

def document_branches(m: dict[str, str]) -> list[tuple]:
    return [
        ("decrease_bid", 12.5, "roas > -1 and acos > 2 * 10.5", f"{m['roas']} > -1 and {m['acos']} > 21.0", "arithmetic"),
        ("increase_bid", 7, "0.5 < roas < 2", f"{m['roas']} > 0.5 and {m['roas']} < 2", "chained"),
        ("increase_bid", 0.25, "not (acos < 1e1 or conversion / 2 >= ctr - 1)",
         f"{m['acos']} >= 10 and {m['conversion']} / 2.0 < {m['ctr']} - 1", None),
    ]


DOCUMENT_ADJUSTMENTS = f"with {A}, {REP7} {rules_sql('rep', 'campaign_id, ad_group_id', branches=document_branches)}"
RULES_MANY = f"""with {A}, {REP7},
metrics as (select campaign_id, ad_group_id, coalesce(acos, 0.0) as acos, coalesce(roas, 0.0) as roas,
                   coalesce(conversion, 0.0) as conversion, coalesce(ctr, 0.0) as ctr from rep),
rules as (select k, k // 4 % 100 as v, ['acos', 'roas', 'conversion', 'ctr'][k % 4 + 1] as m from range(1200) t(k)),
tried as (select campaign_id, ad_group_id, acos, roas, conversion, ctr, k, v, m,
                 case m when 'acos' then acos when 'roas' then roas when 'conversion' then conversion else ctr end as x
          from metrics, rules)
select campaign_id, ad_group_id, ['increase_bid', 'decrease_bid', 'pause'][k % 3 + 1] as action, cast(k % 50 as double) as percentage,
       'Rule triggered: ' || case k % 3 when 0 then v || ' <= ' || m || ' < ' || (v + 5)
         when 1 then m || ' > ' || v || ' and roas < ' || (k % 7)
         else 'ctr == ' || (v % 9) || ' and ' || m || ' >= ' || v end as reason
from tried
where case k % 3 when 0 then v <= x and x < v + 5 when 1 then x > v and roas < k % 7 else ctr = v % 9 and x >= v end"""
HISTORY_TWO = f"""with one as ({history_sql(10)})
select * from one union all select * replace ('other' as account_id) from one"""
DAY_WINDOWS = KEYWORD_AS_WRITTEN_SQL.replace("date_trunc('hour', ts) as", "date_trunc('day', ts) as")

ORACLE.update({
    "ingested_performance": f"with {A}, {DAILY_TRAFFIC_CTE} select * from dp where date >= date '2024-01-10'",
    "ingested_timestamps": f"""with {A}
select campaign_id, event_date, count(*) as n,
       cast(sum(cast(epoch(time_window_start) as bigint)
            - case cast(campaign_id as int) % 4 when 0 then -25200 when 1 then 0 when 2 then 32400 else 19800 end) as bigint) as sum_epoch
from traffic group by campaign_id, event_date""",
    "touched_performance": f"with {A}, {DAILY_TRAFFIC_CTE} select * from dp where date in "
                           "(select event_date from conversion where conversions < 0 and campaign_id = '3')",
    "rules_document": DOCUMENT_ADJUSTMENTS,
    "rules_many": RULES_MANY,
    "recommendations_document": f"with {A}, {report_cte(['campaign_id'], 'last7days')} "
                                f"{rules_sql('rep', 'campaign_id', extra='metrics', branches=document_branches)}",
    "daily_job": ORACLE["anomalies"],
    "daily_job_replaced": f"with {A.replace('from events)', 'from events where cast(ts as date) >= date ' + repr('2024-01-20') + ')')}, "
                          f"{DAILY_TRAFFIC_CTE}, {TRENDS_CTE} "
                          "select date, count(*) as n, cast(sum(has_anomaly) as bigint) as anomalies from an group by date",
    "report_job_report": ORACLE["report_last7days"],
    "report_job_alert_digest": ORACLE["alert_digest"],
    "report_job_adjustments": DOCUMENT_ADJUSTMENTS,
    "history_table": HISTORY_TWO,
    "notifications": f"""with {A}, {REP7}, {ALERTS_CTE}
select level, type, campaign_id, ad_group_id, level || ': Advertising alert' as subject,
       case level when 'CRITICAL' then {sql_text('🚨 CRITICAL ALERT 🚨')} else {sql_text('⚠️ WARNING ⚠️')} end
         || {NL} || {NL} || message as message
from all_alerts""",
    "report_unknown_window": ORACLE["report_today"],
    "keyword_fan_out": DAY_WINDOWS,
    "keyword_positions": f"select campaign_id, keyword_id, cost, cast(row_number() over ({KW_ORDER.replace(' limit 10', '')}) as int) "
                         f"as position from ({DAY_WINDOWS})",
})

REJECTED = {"clicks": "cast(keyword_id as int) % 10 = 3", "cost": "cast(keyword_id as int) % 7 = 2"}

ORACLE.update({
    "daily_job_stepwise": ORACLE["anomalies"],
    "partial_sums_performance": ORACLE["daily_performance"],
    "history_compacted": history_sql(10),
    "rejected_values": f"with {A} " + " union all ".join(
        f"select 'traffic' as feed, '{c}' as \"column\", (select count(*) from traffic where {REJECTED.get(c, 'false')}) as rejected"
        for c in ("campaign_id", "ad_group_id", "keyword_id", "keyword_text", "match_type", "time_window_start", "impressions", "clicks", "cost")),
    "report_past_arrivals": ORACLE["report_yesterday"],
    "campaign_positions": "select campaign_id, spend, row_number() over (order by spend desc nulls last, campaign_id) as position "
                          f"from ({ORACLE['campaign_report']})",
    "report_job_summary": f"with {A}, {REP7}, {summary_cte('rep')} select {SUMMARY_COLS}, low_performing, average_performing, "
                          "high_performing, high_acos, target_acos, low_acos from summ",
    "history_default_stamp": f"select 'default' as account_id, total_campaigns, total_spend, true as at_run_time from ({ORACLE['account_summary']})",
})
