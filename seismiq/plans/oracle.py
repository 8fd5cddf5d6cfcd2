"""Independent ANSI-SQL statements of every deterministic query (DuckDB).

Written as plain SQL, not generated from the Spark code, so that they check
it.  Tables are the driver's pre-registered views.  Averages are rounded
through DECIMAL so that half-way cases round up as Spark's ``round`` does.
"""

# Observation adapter over ``events`` (fixture contract).
OBS = """
obs AS (
  select
    case when event_id % 97 = 0 then null
         else concat('eq', cast(cast(floor(event_id / 3) as bigint) as string)) end as event_id,
    event_id as obs_seq,
    ts as event_timestamp,
    date_trunc('hour', ts) as bronze_load_timestamp,
    case when event_id % 41 = 0 then null
         else floor(least(value, 300e0) * 16e0 / 33e0) / 16e0 end as magnitude,
    case when event_id % 43 = 0 then null
         else floor(cast(power(cast(regexp_extract(props, '([0-9]+)', 1) as bigint), 3) as double) / 187.5e0) / 8e0 end as depth_km,
    case when event_id % 53 = 0 then null
         else cast((event_id * 37) % 181 - 90 as double) end as latitude,
    cast((event_id * 53) % 361 - 180 as double) as longitude,
    case when event_id % 59 = 0 then null
         else cast(floor(cast((event_id % 101) * (event_id % 101) * (event_id % 101) as double) / 1000e0) as int) end as significance,
    case event_id % 11 when 0 then 'green' when 1 then 'yellow' when 2 then 'orange' when 3 then 'red' end as alert_level,
    (event_type = 'error') as tsunami_flag,
    concat('place_', cast(user_id as string)) as place,
    case when event_id % 3 = 0 then null else cast(event_id % 20 as int) end as felt_reports,
    case when event_id % 5 = 0 then null else cast(event_id % 80 as double) / 8e0 end as cdi,
    case when event_id % 7 = 0 then null else cast(event_id % 72 as double) / 8e0 end as mmi,
    case when event_id % 13 = 0 then null else cast(event_id % 360 as double) end as gap_deg,
    case when event_id % 17 = 0 then null else cast(event_id % 16 as double) / 16e0 end as rms,
    case when event_id % 19 = 0 then null else cast(event_id % 60 as int) end as nst
  from events
)"""

SILVER = """
latest AS (
  select * from (
    select *, row_number() over (partition by event_id
                                 order by bronze_load_timestamp desc, obs_seq desc) as rn
    from obs where event_id is not null) t
  where rn = 1
),
silver AS (
  select
    event_id, event_timestamp, magnitude,
    case when magnitude >= 7.0 then 'CATASTROPHIC'
         when magnitude >= 6.0 then 'MAJOR'
         when magnitude >= 5.0 then 'STRONG'
         when magnitude >= 4.0 then 'MODERATE'
         when magnitude >= 3.0 then 'MINOR'
         when magnitude >= 2.0 then 'MICRO'
         else 'NEGLIGIBLE' end as severity,
    depth_km,
    case when depth_km <= 70 then 'SHALLOW'
         when depth_km <= 300 then 'INTERMEDIATE'
         else 'DEEP' end as depth_category,
    latitude, longitude, place,
    case when latitude between 24 and 49 and longitude between -125 and -66 then 'North America'
         when latitude between 35 and 72 and longitude between -10 and 40 then 'Europe'
         when latitude between -10 and 55 and longitude between 60 and 150 then 'Asia'
         when latitude between -55 and 15 and longitude between -82 and -34 then 'South America'
         when latitude between -35 and 37 and longitude between -18 and 52 then 'Africa'
         when latitude between -50 and -10 and longitude between 110 and 180 then 'Oceania'
         when latitude between 51 and 72 and longitude between -168 and -130 then 'Alaska/Arctic'
         else 'Pacific/Other' end as region,
    coalesce(alert_level, 'none') as alert_level,
    tsunami_flag, significance, felt_reports, cdi, mmi, gap_deg, rms, nst
  from latest
)"""


def r2(expr: str) -> str:
    """Spark-compatible ``round(x, 2)`` (half-up on the decimal value)."""
    return f"cast(round(cast({expr} as decimal(38,9)), 2) as double)"


GOLD = f"""
gold AS (
  select
    date_trunc('hour', event_timestamp) as event_hour, severity, region,
    count(*) as total_events,
    count(distinct event_id) as unique_events,
    {r2('avg(magnitude)')} as avg_magnitude,
    max(magnitude) as max_magnitude,
    min(magnitude) as min_magnitude,
    {r2('avg(depth_km)')} as avg_depth_km,
    cast(sum(case when tsunami_flag = true then 1 else 0 end) as bigint) as tsunami_count,
    cast(sum(case when alert_level <> 'none' then 1 else 0 end) as bigint) as alerted_events,
    max(significance) as max_significance,
    first(place order by magnitude desc nulls last, event_id desc) as most_notable_place
  from silver
  group by 1, 2, 3
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = with_(OBS, SILVER)
BASE_GOLD = with_(OBS, SILVER, GOLD)

SQL: dict[str, str] = {}

SQL["silver_dedup"] = BASE + """
select event_id, obs_seq, event_timestamp from latest"""

SQL["silver_enriched"] = BASE + """
select * from silver"""

SQL["gold_insights"] = BASE_GOLD + """
select * from gold"""

SQL["bronze_profile"] = with_(OBS) + f"""
select count(*) as total_events,
       count(distinct event_id) as unique_events,
       {r2('avg(magnitude)')} as avg_magnitude,
       max(magnitude) as max_magnitude,
       cast(sum(case when tsunami_flag = true then 1 else 0 end) as bigint) as tsunami_events,
       min(event_timestamp) as earliest_event,
       max(event_timestamp) as latest_event
from obs"""

SQL["silver_validation"] = BASE + f"""
select severity, region, count(*) as event_count,
       {r2('avg(magnitude)')} as avg_magnitude,
       max(magnitude) as max_magnitude,
       cast(sum(case when tsunami_flag = true then 1 else 0 end) as bigint) as tsunamis
from silver group by severity, region
order by max_magnitude desc, severity, region"""

SQL["top_events"] = BASE + """
select event_id, event_timestamp, place, magnitude, severity, depth_category,
       region, alert_level, tsunami_flag
from silver order by magnitude desc nulls last, event_id asc limit 11"""

SQL["top_insights"] = BASE_GOLD + """
select event_hour, severity, region, total_events, avg_magnitude, max_magnitude,
       tsunami_count, most_notable_place
from gold order by max_magnitude desc nulls last, event_hour desc, severity, region limit 9"""

SQL["layer_audit"] = BASE_GOLD + """
select 'BRONZE' as layer, count(*) as rows from obs
union all select 'SILVER' as layer, count(*) as rows from silver
union all select 'GOLD' as layer, count(*) as rows from gold"""

SQL["dash_severity"] = BASE_GOLD + """
select severity, cast(sum(total_events) as bigint) as total_events from gold group by severity"""

SQL["dash_region_max"] = BASE_GOLD + """
select region, max(max_magnitude) as max_magnitude from gold group by region"""

SQL["dash_hourly"] = BASE_GOLD + """
select event_hour, cast(sum(total_events) as bigint) as total_events from gold group by event_hour"""

SQL["dash_top_events"] = BASE + """
select place, magnitude, severity from silver
order by magnitude desc nulls last, event_id asc limit 10"""


def r4(expr: str) -> str:
    return f"cast(round(cast({expr} as decimal(38,12)), 4) as double)"


SCORED = """
base AS (
  select event_id, magnitude, depth_km, latitude, longitude,
         coalesce(significance, 0) as significance,
         coalesce(felt_reports, 0) as felt_reports,
         coalesce(cdi, 0) as cdi, coalesce(mmi, 0) as mmi,
         coalesce(gap_deg, 180) as gap_deg, coalesce(rms, 0) as rms,
         coalesce(nst, 0) as nst,
         cast(coalesce(tsunami_flag, false) as int) as tsunami_flag,
         severity, region
  from silver
  where magnitude is not null and depth_km is not null
),
stats AS (
  select avg(magnitude) as mu_m, stddev_pop(magnitude) as sd_m,
         avg(depth_km) as mu_d, stddev_pop(depth_km) as sd_d,
         avg(significance) as mu_s, stddev_pop(significance) as sd_s
  from base
),
z AS (
  select base.*,
         abs((magnitude - mu_m) / nullif(sd_m, 0)) as zscore_magnitude,
         abs((depth_km - mu_d) / nullif(sd_d, 0)) as zscore_depth_km,
         abs((significance - mu_s) / nullif(sd_s, 0)) as zscore_significance
  from base cross join stats
),
flags AS (
  select z.*,
    cast(coalesce(zscore_magnitude > 2.5, false) or coalesce(zscore_depth_km > 2.5, false)
         or coalesce(zscore_significance > 2.5, false) as int) as is_anomaly,
    concat_ws(' ',
      case when zscore_magnitude > 2.5 then 'unusual_magnitude' end,
      case when zscore_depth_km > 2.5 then 'unusual_depth' end,
      case when zscore_significance > 2.5 then 'high_significance' end) as reasons,
    round_even(greatest(zscore_magnitude, zscore_depth_km, zscore_significance), 4) as anomaly_score
  from z
),
scores AS (
  select event_id, zscore_magnitude, zscore_depth_km, zscore_significance, is_anomaly,
         case when is_anomaly = 0 then 'none' else reasons end as anomaly_reason,
         anomaly_score
  from flags
),
ml AS (
  select silver.*, scores.is_anomaly, scores.anomaly_reason, scores.anomaly_score,
         scores.zscore_magnitude, scores.zscore_depth_km, scores.zscore_significance
  from silver left join scores on silver.event_id = scores.event_id
)"""

BASE_ML = with_(OBS, SILVER, SCORED)

SQL["zscore"] = BASE_ML + f"""
select event_id, magnitude, depth_km, significance,
       {r4('zscore_magnitude')} as zscore_magnitude,
       {r4('zscore_depth_km')} as zscore_depth_km,
       {r4('zscore_significance')} as zscore_significance
from z"""

SQL["anomaly_flags"] = BASE_ML + """
select event_id, is_anomaly, anomaly_reason, anomaly_score from scores"""

SQL["anomaly_summary"] = BASE_ML + f"""
select is_anomaly, anomaly_reason, count(*) as event_count,
       {r2('avg(magnitude)')} as avg_magnitude,
       max(magnitude) as max_magnitude,
       {r2('avg(depth_km)')} as avg_depth_km
from ml group by is_anomaly, anomaly_reason"""

SQL["dash_anomaly"] = BASE_ML + """
select is_anomaly, count(*) as events from ml group by is_anomaly"""

SQL["ml_features"] = BASE_ML + """
select base.*,
       (n < 10 or substr(md5(concat(event_id, '42')), 1, 2) < '33') as is_test,
       (n < 10 or not (substr(md5(concat(event_id, '42')), 1, 2) < '33')) as is_train
from base cross join (select count(*) as n from base) c"""

SQL["ml_enriched"] = BASE_ML + """
select event_id, severity, region, is_anomaly, anomaly_reason, anomaly_score,
       (magnitude is not null and depth_km is not null) as scored
from ml"""

SQL["daily_kpis"] = BASE_ML + """
select count(*) as total_events,
       max(magnitude) as max_magnitude,
       round_even(avg(magnitude), 2) as avg_magnitude,
       cast(sum(case when tsunami_flag = true then 1 else 0 end) as bigint) as tsunami_count,
       cast(sum(is_anomaly) as bigint) as anomaly_count,
       cast(sum(case when severity in ('MAJOR', 'STRONG', 'CATASTROPHIC') then 1 else 0 end) as bigint)
         as critical_events,
       first(place order by magnitude desc nulls last, event_id asc) as top_event_place,
       first(magnitude order by magnitude desc nulls last, event_id asc) as top_event_magnitude
from ml"""

SQL["top_regions"] = BASE_ML + """
select region, count(*) as events from ml group by region
order by events desc, region limit 3"""

SQL["most_active_region"] = BASE_ML + """
select region, count(*) as events from ml group by region
order by events desc, region limit 1"""

SQL["cluster_summary"] = BASE_ML + """
select region, count(event_id) as "count",
       round_even(avg(magnitude), 2) as avg_mag,
       round_even(max(magnitude), 2) as max_mag,
       cast(sum(is_anomaly) as bigint) as anomalies
from ml group by region"""

SQL["critical_24h"] = BASE_ML + """
select event_id, place, magnitude, severity, depth_km, region, event_timestamp, anomaly_reason
from ml
where severity in ('MAJOR', 'STRONG', 'CATASTROPHIC')
  and event_timestamp >= (select max(event_timestamp) from ml) - interval 24 hour"""

SQL["anomalous_events"] = BASE_ML + """
select event_id, place, magnitude, anomaly_reason from ml where is_anomaly = 1"""

SQL["report_lines"] = BASE_ML + """
select 'daily_summary' as output_type, 'anomalous_events' as section, region, magnitude, event_id,
       concat_ws(' | ', coalesce(cast(place as varchar), 'None'),
                 coalesce(cast(magnitude as varchar), 'None'),
                 coalesce(cast(anomaly_reason as varchar), 'None')) as line
from ml where is_anomaly = 1
union all
select 'cluster_explanation', 'events', region, magnitude, event_id,
       concat_ws(' | ', coalesce(cast(place as varchar), 'None'),
                 coalesce(cast(magnitude as varchar), 'None'),
                 coalesce(cast(depth_km as varchar), 'None'),
                 coalesce(cast(region as varchar), 'None'),
                 coalesce(cast(anomaly_reason as varchar), 'None'))
from ml"""

SQL["playbook_event"] = BASE_ML + """
select event_id, place, magnitude, severity, depth_km, tsunami_flag, region, anomaly_reason
from ml order by magnitude desc nulls last, event_id asc limit 1"""

def fmt(expr: str) -> str:
    """Value as text, null as ``None``."""
    return f"coalesce(cast({expr} as varchar), 'None')"


def bar(*exprs: str) -> str:
    return "concat_ws(' | ', " + ", ".join(fmt(e) for e in exprs) + ")"


STRONGEST = "magnitude desc nulls last, event_id asc"
NL = "chr(10)"

REPORT_BLOCKS = f"""
kpi AS (
  select count(*) as total_events, max(magnitude) as max_magnitude,
         round_even(avg(magnitude), 2) as avg_magnitude,
         cast(sum(case when tsunami_flag = true then 1 else 0 end) as bigint) as tsunami_count,
         cast(sum(is_anomaly) as bigint) as anomaly_count,
         cast(sum(case when severity in ('MAJOR', 'STRONG', 'CATASTROPHIC') then 1 else 0 end) as bigint)
           as critical_events,
         first(place order by {STRONGEST}) as top_place,
         first(magnitude order by {STRONGEST}) as top_magnitude
  from ml
),
region_txt AS (
  select coalesce(string_agg(region || ': ' || cast(events as varchar), ', ' order by events desc, region),
                  'None') as txt
  from (select region, count(*) as events from ml group by region
        order by events desc, region limit 3) t
),
top5_txt AS (
  select coalesce(string_agg({bar('place', 'magnitude', 'severity', 'region', 'depth_km')}, {NL}
                             order by {STRONGEST}), 'None') as txt
  from (select * from ml order by {STRONGEST} limit 5) t
),
cluster_txt AS (
  select coalesce(string_agg({bar('region', 'cnt', 'avg_mag', 'max_mag', 'anomalies')}, {NL} order by region),
                  'None') as txt
  from (select region, count(event_id) as cnt, round_even(avg(magnitude), 2) as avg_mag,
               round_even(max(magnitude), 2) as max_mag, cast(sum(is_anomaly) as bigint) as anomalies
        from ml group by region) t
)"""

SQL["report_text"] = BASE_ML + "," + REPORT_BLOCKS + f"""
select 'daily_summary' as output_type,
       concat_ws({NL}, 'SEISMIC SITUATION SUMMARY',
                 'Events: ' || {fmt('total_events')},
                 'Largest magnitude: ' || {fmt('max_magnitude')},
                 'Mean magnitude: ' || {fmt('avg_magnitude')},
                 'Tsunami flags: ' || {fmt('tsunami_count')},
                 'Anomalies: ' || {fmt('anomaly_count')},
                 'Most active regions: ' || region_txt.txt,
                 'Strongest event: M' || {fmt('top_magnitude')} || ' at ' || {fmt('top_place')},
                 'Critical events: ' || {fmt('critical_events')},
                 '', 'Five strongest events:', top5_txt.txt) as content
from kpi, region_txt, top5_txt
union all
select 'cluster_explanation',
       concat_ws({NL}, 'ACTIVITY BY REGION (region | events | mean | max | anomalies)',
                 cluster_txt.txt)
from cluster_txt
union all
select 'response_playbook',
       concat_ws({NL}, 'RESPONSE PLAYBOOK INPUT',
                 'Location: ' || {fmt('place')},
                 'Magnitude: M' || {fmt('magnitude')},
                 'Severity: ' || {fmt('severity')},
                 'Depth: ' || {fmt('depth_km')} || ' km',
                 'Tsunami flag: ' || {fmt('tsunami_flag')},
                 'Region: ' || {fmt('region')},
                 'Anomaly: ' || {fmt('anomaly_reason')},
                 'Model prediction: None (confidence None%)')
from (select * from ml order by {STRONGEST} limit 1) t"""

FEED = """
feed AS (
  select obs_seq, bronze_load_timestamp,
    event_id, 'USGS' as source, magnitude,
    case when magnitude is not null then (['ml', 'md', 'mb', 'mww'])[obs_seq % 4 + 1] end as magnitude_type,
    depth_km, latitude, longitude, place, 'earthquake' as event_type,
    epoch_us(event_timestamp) // 1000 as event_time_epoch_ms,
    strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S')
      || case when epoch_us(event_timestamp) % 1000000 <> 0
              then '.' || lpad(cast(epoch_us(event_timestamp) % 1000000 as varchar), 6, '0') else '' end
      || 'Z' as event_time_utc,
    alert_level, tsunami_flag, significance, felt_reports, cdi, mmi,
    case when obs_seq % 2 = 0 then 'reviewed' else 'automatic' end as status,
    (['us', 'ak', 'nc', 'ci'])[obs_seq % 4 + 1] as network,
    gap_deg, rms, nst,
    'https://feed.example/detail/' || event_id || '.geojson' as detail_url,
    'https://feed.example/event/' || event_id as event_url,
    strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' as ingestion_timestamp_utc
  from obs
)"""

FEED_COLS = """event_id, source, magnitude, magnitude_type, depth_km, latitude, longitude, place,
  event_type, event_time_epoch_ms, event_time_utc, alert_level, tsunami_flag, significance,
  felt_reports, cdi, mmi, status, network, gap_deg, rms, nst, detail_url, event_url"""

SQL["geojson_flatten"] = with_(OBS, FEED) + """
select event_id, source, magnitude, magnitude_type, depth_km, latitude, longitude, place,
  event_type, event_time_epoch_ms,
  case when event_time_epoch_ms is null or event_time_epoch_ms = 0 then null
       else strftime(epoch_ms(event_time_epoch_ms), '%Y-%m-%dT%H:%M:%S')
            || case when event_time_epoch_ms % 1000 <> 0
                    then '.' || lpad(cast((event_time_epoch_ms % 1000) * 1000 as varchar), 6, '0') else '' end
            || 'Z' end as event_time_utc,
  alert_level, tsunami_flag, significance, felt_reports, cdi, mmi, status, network,
  gap_deg, rms, nst, detail_url, event_url
from feed"""

SQL["geojson_multiline"] = SQL["geojson_flatten"]

SQL["landing_read"] = with_(OBS, FEED) + f"""
select {FEED_COLS}, ingestion_timestamp_utc from feed"""

SQL["bronze_stream"] = SQL["landing_read"]

SQL["silver_stream"] = with_(OBS, SILVER, FEED) + """
select s.event_id, f.source, s.event_timestamp, f.event_time_utc, s.magnitude, f.magnitude_type,
  s.severity, s.depth_km, s.depth_category, s.latitude, s.longitude, s.place, s.region,
  s.alert_level, s.tsunami_flag, s.significance, s.felt_reports, s.cdi, s.mmi, f.status,
  f.network, s.gap_deg, s.rms, s.nst, f.detail_url, f.event_url, f.ingestion_timestamp_utc
from silver s join latest l on s.event_id = l.event_id
join feed f on f.obs_seq = l.obs_seq"""

SQL["export_gold"] = BASE_GOLD + """
select event_hour as EVENT_HOUR, severity as SEVERITY, region as REGION,
  total_events as TOTAL_EVENTS, unique_events as UNIQUE_EVENTS, avg_magnitude as AVG_MAGNITUDE,
  max_magnitude as MAX_MAGNITUDE, min_magnitude as MIN_MAGNITUDE, avg_depth_km as AVG_DEPTH_KM,
  tsunami_count as TSUNAMI_COUNT, alerted_events as ALERTED_EVENTS,
  max_significance as MAX_SIGNIFICANCE, most_notable_place as MOST_NOTABLE_PLACE
from gold"""

SQL["export_validation"] = BASE_GOLD + """
select severity as SEVERITY, region as REGION, count(*) as EVENTS, max(max_magnitude) as MAX_MAG
from gold group by severity, region
order by MAX_MAG desc nulls last, SEVERITY, REGION limit 10"""

SQL["export_manifest"] = BASE_GOLD + """
select 'GOLD_INSIGHTS' as TABLE_NAME, count(*) as ROWS from gold
union all select 'ML_PREDICTIONS' as TABLE_NAME, count(*) as ROWS from silver
union all select 'GENAI_OUTPUTS' as TABLE_NAME, count(distinct kind) as ROWS
from (values ('daily_summary'), ('cluster_explanation'), ('response_playbook')) t(kind)"""

SQL["table_status"] = BASE_ML + """
select 'seismiq_status.bronze' as table_name, 'ok' as status, count(*) as rows, cast(null as varchar) as error from obs
union all select 'seismiq_status.silver', 'ok', count(*), null from silver
union all select 'seismiq_status.gold', 'ok', count(*), null
  from (select 1 from silver group by date_trunc('hour', event_timestamp), severity, region) g
union all select 'seismiq_status.ml', 'ok', count(*), null from ml
union all select 'seismiq_status.reports', 'missing', null,
  left('[TABLE_OR_VIEW_NOT_FOUND] The table or view `seismiq_status`.`reports` cannot be found. Verify', 80)"""

SQL["catalog_tables"] = BASE_GOLD + """
select 'appended' as table_name, 'severity' as columns, 2 * count(*) as rows from gold
union all select 'replaced', 'region,total_events', count(*) from gold"""

SQL["gold_stream"] = SQL["gold_insights"]

OBS_UNTIMED = OBS.replace("ts as event_timestamp", "case when event_id % 61 <> 0 and event_id % 67 <> 0 then ts end as event_timestamp")
SQL["gold_stream_untimed"] = SQL["gold_insights"].replace(OBS, OBS_UNTIMED)

SQL["severity_distribution"] = BASE_ML + """
select severity, count(*) as events from base group by severity"""

SQL["gold_context"] = BASE_GOLD + """
select event_hour, severity, region, total_events, avg_magnitude, max_magnitude,
       tsunami_count, most_notable_place
from gold order by max_magnitude desc nulls last, event_hour desc, severity, region"""


SQL["ml_report_support"] = BASE_ML + """,
split AS (
  select severity, (n < 10 or substr(md5(concat(event_id, '42')), 1, 2) < '33') as is_test,
         (n < 10 or not (substr(md5(concat(event_id, '42')), 1, 2) < '33')) as is_train
  from base cross join (select count(*) as n from base) c
),
classes AS (
  select severity as class_name, cast(sum(case when is_test then 1 else 0 end) as bigint) as support
  from split group by severity having bool_or(is_train)
)
select class_name, support from classes
union all
select name, (select cast(sum(support) as bigint) from classes)
from (values ('accuracy'), ('macro avg'), ('weighted avg')) t(name)"""

SQL["ml_run_facts"] = BASE_ML + """
select 'RandomForestClassificationModel' as estimator,
       'magnitude,depth_km,latitude,longitude,significance,felt_reports,cdi,mmi,gap_deg,rms,nst,tsunami_flag' as features,
       count(*) as training_rows
from base cross join (select count(*) as n from base) c
where n < 10 or not (substr(md5(concat(event_id, '42')), 1, 2) < '33')"""

SQL["ml_importance_facts"] = """
select 'cdi,depth_km,felt_reports,gap_deg,latitude,longitude,magnitude,mmi,nst,rms,significance,tsunami_flag' as features,
       cast(1 as double) as total"""

SQL["ml_review_facts"] = BASE_ML + """
select event_id, place, magnitude, severity as actual_severity, is_anomaly, anomaly_reason, region
from ml order by magnitude desc nulls last, event_id limit 20"""

SQL["qa_context_facts"] = BASE_ML + """
select place, magnitude, severity, depth_km, region, tsunami_flag, is_anomaly,
       strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S')
         || case when epoch_us(event_timestamp) % 1000000 <> 0
                 then '.' || lpad(cast(epoch_us(event_timestamp) % 1000000 as varchar), 6, '0') else '' end
         || 'Z' as event_time_utc
from ml"""

SQL["dash_predicted_total"] = BASE_ML + """
select cast(count(*) as bigint) as events,
       cast(nullif(sum(case when magnitude is null or depth_km is null then 1 else 0 end), 0) as bigint) as unscored
from ml"""

SQL["report_preview"] = f"select output_type, left(content, 200) as content_preview from ({SQL['report_text']}) t"

SQL["dash_report_text"] = SQL["report_text"]

SQL["landing_count"] = with_(OBS) + """
select true as all_have_bytes, count(*) as records from obs"""

SQL["bronze_metadata"] = with_(OBS) + """
select count(*) as rows, count(*) as stamped, count(*) as from_landed_files from obs"""

SQL["gold_sorted"] = SQL["gold_insights"]

SQL["ml_joined"] = BASE_ML + """
select event_id, severity, region, is_anomaly, anomaly_reason, anomaly_score from ml"""


# ---- streams in several batches, quarantine, reconciled export, chunks, fixed model ----

SQL["stream_batches"] = """
select true as several, true as later_batches, true as stale_within_moved, true as published_later from events having count(*) > 0"""

SQL["stream_progress"] = with_(OBS) + """
select 'bronze' as query, count(*) as input_rows, cast(0 as bigint) as state_rows, true as later_batches from obs
union all select 'silver', count(*), count(distinct event_id), true from obs"""

SQL["stream_recovered"] = BASE_GOLD + """
select *, true as one_version_between from gold"""

# the poll of a row: ranges of the row sequence, six of them
SQL["bronze_evolving"] = with_(OBS, FEED, "polls AS (select max(obs_seq) + 1 as size from obs)") + f"""
select {FEED_COLS.replace("significance", "cast(significance as double) + case when poll = 4 then 0.5e0 else 0e0 end as significance")},
  ingestion_timestamp_utc,
  case when poll in (2, 3) then obs_seq % 12 end as station_count,
  case when poll in (2, 3) then (obs_seq % 16) / 16e0 end as review_score
from (select feed.*, (obs_seq * 6) // size as poll from feed, polls)"""

SQL["landing_quarantine"] = with_(OBS, FEED) + """
select side, case when side = 'good' then event_id end as event_id, case when side = 'good' then magnitude end as magnitude,
  case when side = 'good' then event_time_utc end as event_time_utc,
  case obs_seq % 37 when 5 then '{"event_id":"' || coalesce(event_id, '?') || '","magnitude":'
                    when 6 then 'no record ' || obs_seq
                    when 7 then '{"event_id":"' || coalesce(event_id, '?') || '","magnitude":"strong"}' end as line,
  count(*) over (partition by side) as counted
from (select *, case when obs_seq % 37 in (5, 6, 7) then 'corrupt' else 'good' end as side from feed)"""

SQL["export_reconciled"] = BASE_GOLD + """
, runs(TABLE_NAME, RUN_ID, SOURCE_ROWS) as (
  select 'GOLD_INSIGHTS', 'r1', count(*) from gold
  union all select 'GOLD_INSIGHTS', 'r2', count(*) from gold where severity = 'MICRO'
  union all select 'SILVER_EVENTS', 'r2', count(*) from silver where severity = 'MAJOR')
select TABLE_NAME, RUN_ID, SOURCE_ROWS, SOURCE_ROWS as TARGET_ROWS, true as EQUAL,
       cast(sum(SOURCE_ROWS) over (partition by TABLE_NAME) as bigint) as ROWS from runs"""

SQL["report_chunks"] = f"""
with listed as ({SQL["report_lines"]}),
placed as (select *, sum(length(line) + 1) over w - (length(line) + 1) as start
           from listed window w as (partition by output_type, section order by {STRONGEST} rows unbounded preceding))
select output_type, section, cast(start // 4096 as bigint) as chunk, count(*) as lines,
       string_agg(line, {NL} order by {STRONGEST}) as content
from placed group by output_type, section, start // 4096"""

# the tree's thresholds and the shares of its leaves
THRESHOLD = """
scored AS (
  select silver.*, magnitude is not null and depth_km is not null as ok,
    case when magnitude <= 2 then 'NEGLIGIBLE' when magnitude <= 4 then 'MICRO' when magnitude <= 6.5 then 'MODERATE' else 'MAJOR' end as p,
    case when magnitude <= 2 then 1.0e0 when magnitude <= 4 then 0.75e0 when magnitude <= 6.5 then 0.6667e0 else 0.6e0 end as c
  from silver),
tested AS (select * from scored where ok and substr(md5(event_id || '42'), 1, 2) < '33')"""
BASE_THRESHOLD = with_(OBS, SILVER, THRESHOLD)

SQL["ml_threshold_scores"] = BASE_THRESHOLD + """
select event_id, severity, case when ok then p end as predicted_severity, case when ok then c end as prediction_confidence from scored"""

SQL["ml_scored_stream"] = BASE_THRESHOLD + """
select event_id, severity, p as predicted_severity, c as prediction_confidence from scored where ok"""

SQL["dash_threshold_predicted"] = BASE_THRESHOLD + """
select case when ok then p end as predicted_severity, count(*) as events from scored group by all"""

SQL["ml_threshold_report"] = BASE_THRESHOLD + """
, classes AS (select unnest(['CATASTROPHIC', 'MAJOR', 'MICRO', 'MINOR', 'MODERATE', 'NEGLIGIBLE', 'STRONG']) as k),
counts AS (select k, (select count(*) from tested where severity = k) as support, (select count(*) from tested where p = k) as given,
                  (select count(*) from tested where severity = k and p = k) as hit from classes),
each AS (select k, support, hit, case when given > 0 then hit / given else 0 end as pr, case when support > 0 then hit / support else 0 end as re from counts),
f AS (select *, case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end as f1 from each),
r AS (select k as class_name, support, pr, re, f1 from f
      union all select 'accuracy', sum(support), null, null, sum(hit) / sum(support) from f
      union all select 'macro avg', sum(support), avg(pr), avg(re), avg(f1) from f
      union all select 'weighted avg', sum(support), sum(pr * support) / sum(support), sum(re * support) / sum(support), sum(f1 * support) / sum(support) from f)
select class_name, cast(support as bigint) as support, round(pr, 6) as precision, round(re, 6) as recall, round(f1, 6) as f1_score from r"""

SQL["ml_threshold_importance"] = BASE_THRESHOLD + """
select f as feature, case when f = 'magnitude' then 1e0 else 0e0 end as importance, (select count(*) from scored where ok) as scored_events
from (select unnest(['magnitude', 'depth_km', 'latitude', 'longitude', 'significance', 'felt_reports', 'cdi', 'mmi', 'gap_deg', 'rms', 'nst', 'tsunami_flag']) as f)"""

SQL["ml_threshold_run"] = BASE_THRESHOLD + """
select 'DecisionTreeClassificationModel' as estimator,
  (select count(*) from scored where ok) - (select count(*) from tested) as training_rows,
  round((select count(*) from tested where p = severity) / (select count(*) from tested), 6) as accuracy"""

SQL["ml_threshold_review"] = BASE_ML + """
select event_id, place, magnitude, severity as actual_severity,
  case when magnitude is null or depth_km is null then null when magnitude <= 2 then 'NEGLIGIBLE' when magnitude <= 4 then 'MICRO'
       when magnitude <= 6.5 then 'MODERATE' else 'MAJOR' end as predicted_severity,
  case when magnitude is null or depth_km is null then null when magnitude <= 2 then 100.0e0 when magnitude <= 4 then 75.0e0
       when magnitude <= 6.5 then 66.7e0 else 60.0e0 end as confidence_pct,
  is_anomaly, anomaly_reason, region
from ml order by magnitude desc nulls last, event_id limit 20"""

SQL["ml_boosted_report"] = f"""
select class_name, support, true as confidences_sound from ({SQL["ml_report_support"]})"""
