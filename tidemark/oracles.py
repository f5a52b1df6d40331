"""DuckDB SQL for the queries: written from the definitions, not from the plans."""

from __future__ import annotations

_TZ = "'America/New_York'"
_TO_UTC = lambda c: f"timezone('UTC', timezone({_TZ}, {c}))"  # noqa: E731  naive local -> naive UTC
_TO_LOCAL = lambda c: f"timezone({_TZ}, timezone('UTC', {c}))"  # noqa: E731  naive UTC -> naive local
_TODAY = "date '2001-08-02'"
_AGO = lambda days: _TO_UTC(f"timestamp '2001-08-02 00:00:00' - interval {days} day")
_PCT = lambda part, whole, places: f"round(100.0 * {part} / nullif({whole}, 0) * 1e{places}) / 1e{places}"
_SIX = lambda x: f"round(({x}) * 1000000) / 1000000"

_BRONZE = """
bronze as (
    select o.o_orderkey as k, cast(o.o_orderkey as varchar) as unique_key,
        o.o_orderdate + to_minutes(o.o_orderkey % 1440) as created_date,
        s.shipped + to_hours(o.o_orderkey % 13) as closed_date,
        n.n_name as agency, 'Department of ' || n.n_name as agency_name,
        ' ' || lower(o.o_orderpriority) as complaint_type,
        case when o.o_orderkey % 50 <> 0 then c.c_mktsegment || case when o.o_orderkey % 97 = 0 and o.o_orderdate >= timestamp '1997-01-01' then ' NEW' else '' end end as descriptor,
        lpad(cast(o.o_custkey % 100000 as varchar), 5, '0') as incident_zip,
        case o.o_orderstatus when 'F' then 'Closed' when 'O' then 'Open' else 'In Progress' end as status,
        lpad(cast(n.n_nationkey % 12 as varchar), 2, '0') || ' ' || r.r_name as community_board,
        r.r_name || ' ' as borough,
        case when o.o_orderkey % 17 = 0 then null when o.o_orderkey % 19 = 0 then 0.0 else cast(40.45 as double) + cast(o.o_orderkey % 500 as double) / 1000 end as latitude,
        case when o.o_orderkey % 17 = 0 then null when o.o_orderkey % 19 = 0 then 0.0 else cast(-74.28 as double) + cast(o.o_orderkey % 600 as double) / 1000 end as longitude,
        case when o.o_orderkey % 3 = 0 then date_trunc('month', o.o_orderdate) + interval '1 month' + interval '93 minutes'
             else o.o_orderdate + to_days(cast(o.o_orderkey % 60 as integer)) + interval '5 hours' end as updated_at
    from orders o
    left join customer c on c.c_custkey = o.o_custkey
    left join nation n on n.n_nationkey = c.c_nationkey
    left join region r on r.r_regionkey = n.n_regionkey
    left join (select l_orderkey, min(l_shipdate) as shipped from lineitem group by 1) s on s.l_orderkey = o.o_orderkey
)"""
_STAGED = f"""
staged as (
    select k, unique_key, {_TO_UTC("created_date")} as created_date, {_TO_UTC("closed_date")} as closed_date, updated_at, agency, agency_name,
        upper(trim(complaint_type)) as complaint_type, upper(trim(descriptor)) as descriptor, incident_zip, trim(status) as status, community_board,
        trim(borough) as borough, latitude, longitude,
        coalesce(latitude between 40.4959 and 40.9153 and longitude between -74.2557 and -73.7002 and not (latitude = 0 and longitude = 0), false) as has_valid_coordinates
    from bronze
), flagged as (
    select *, status = 'Closed' and closed_date is not null as is_closed, created_date <= {_AGO(45)} as is_settled,
        status = 'Closed' and closed_date is null as is_undated_closure
    from staged
), resolved as (
    select *, not is_closed or not is_settled as is_censored, case when is_closed and is_settled then date_diff('hour', created_date, closed_date) end as resolution_hours,
        {_TO_LOCAL("created_date")} as created_local, date_trunc('month', {_TO_LOCAL("created_date")}) as month
    from flagged
)"""
_DIMS = """
dim_agency as (
    select row_number() over (order by agency, agency_name) as agency_key, agency, agency_name from (select distinct agency, agency_name from staged where agency is not null)
), dim_type as (
    select row_number() over (order by complaint_type, coalesce(descriptor, '')) as complaint_type_key, complaint_type, descriptor
    from (select distinct complaint_type, descriptor from staged where complaint_type is not null)
), dim_location as (
    select row_number() over (order by borough nulls last, community_board) as location_key, community_board, borough
    from (select distinct community_board, borough from staged where community_board is not null)
)"""
_FACT = """
fact as (
    select f.*, a.agency_key, t.complaint_type_key, l.location_key, cast(f.created_local as date) as date_key
    from resolved f
    left join dim_agency a on a.agency = f.agency
    left join dim_type t on t.complaint_type = f.complaint_type and coalesce(t.descriptor, '') = coalesce(f.descriptor, '')
    left join dim_location l on l.community_board = f.community_board and l.borough = f.borough
)"""
_RAW = f"with {_BRONZE}"
_FLAGS = f"with {_BRONZE}, {_STAGED}"
_STAR = f"with {_BRONZE}, {_STAGED}, {_DIMS}, {_FACT}"

_HOURS = "case when is_settled and is_closed and not is_undated_closure then resolution_hours end"
_NAIVE_HOURS = "date_diff('hour', created_date, closed_date)"
_TOP = lambda n: f"(select complaint_type from fact group by 1 order by count(*) desc, 1 limit {n})"

_RATES = lambda sigmas: f""", cutoffs as (
    select unnest(generate_series(min(month) + interval '1 month', date_trunc('month', {_TODAY}::timestamp) + interval '1 month', interval '1 month')) as scan_month from fact
), closures as (
    select agency, created_local, closed_date is null as dateless from fact where status = 'Closed'
), counted as (
    select c.scan_month, a.agency, (select count(*) from closures x where x.agency = a.agency and x.created_local < c.scan_month) as closed_rows,
        (select count(*) from closures x where x.agency = a.agency and x.created_local < c.scan_month and x.dateless) as undated_closure_rows
    from cutoffs c, (select distinct agency from fact) a
), shared as (
    select *, 100.0 * undated_closure_rows / nullif(closed_rows, 0) as pct from counted
), rate_detector as (
    select s.scan_month, s.agency, s.closed_rows, s.undated_closure_rows, round(s.pct * 10000) / 10000 as undated_closure_rate_pct, {_SIX("t.bar")} as threshold_pct,
        coalesce(s.pct > t.bar, false) as fired
    from shared s join (select scan_month, avg(pct) + {sigmas} * stddev_pop(pct) as bar from shared where agency <> 'CHINA' group by 1) t on t.scan_month = s.scan_month
)"""  # noqa: E731
_DRIFT = f""", shares as (
    select month, complaint_type, count(*) as n, 100.0 * count(*) / (select count(*) from fact x where x.month = f.month) as share
    from fact f where complaint_type in {_TOP(15)} group by 1, 2
), drift as (
    select a.month, a.complaint_type, a.n as volume, round(a.share * 10000) / 10000 as pct_share, round(b.share * 10000) / 10000 as pct_share_prior_year,
        round((a.share - b.share) * 10000) / 10000 as yoy_delta_pp, abs(a.share - b.share) > 5 as fired
    from shares a join shares b on b.complaint_type = a.complaint_type and b.month = a.month - interval '12 months'
)"""
_WORDS = """, members as (
    select 'agency' as dimension, agency as value, month from fact union all select 'complaint_type', complaint_type, month from fact
    union all select 'descriptor', descriptor, month from fact where descriptor is not null
), words as (
    select dimension, value, min(month) as first_seen_month, count(*) as volume_to_date from members group by 1, 2
    having min(month) >= (select min(month) + interval '1 month' from fact)
)"""
_COMPLETE = f""", cohorts as (
    select month as cohort_month, count(*) as closed_rows,
        count(*) filter (where date_diff('day', cast(created_local as date), cast({_TO_LOCAL("updated_at")} as date)) <= 45) as observable_by_45d
    from fact where status = 'Closed' group by 1
), complete as (
    select *, {_PCT("observable_by_45d", "closed_rows", 2)} as completeness_pct_45d, 90.0::double as warn_threshold_pct, 85.0::double as fail_threshold_pct from cohorts
    where cohort_month >= date '1995-02-01' and cohort_month <> date '1996-01-01' and cohort_month <= date_trunc('month', {_TODAY} - interval '90 days')
), completeness as (
    select *, case when completeness_pct_45d < 85 then 'fail' when completeness_pct_45d < 90 then 'warn' else 'pass' end as status from complete
)"""
_TOUCHES = lambda sigmas: f""", hours as (
    select date_trunc('hour', updated_at) as hour_bucket, count(distinct agency) as distinct_agencies, count(*) as total_rows from fact group by 1
), eligible as (select * from hours where distinct_agencies >= 13),
touch as (
    select e.*, round(t.x) as threshold_rows, total_rows > t.x as fired from eligible e
    cross join (select avg(total_rows) + {sigmas} * stddev_pop(total_rows) as x from eligible where total_rows < 100000) t
)"""  # noqa: E731
_TOUCH = _TOUCHES(3)

_SHIFT = lambda column, where, whole: f"""
    select {column}, month, share - lag(share) over (partition by {column} order by month) as delta from (
        select {column}, month, 100.0 * count(*) / {whole} as share from fact {where} group by 1, 2)"""  # noqa: E731
_OF_SHOWN = "sum(count(*)) over (partition by month)"
_SINCE = f"month >= date_trunc('month', {_TODAY}::timestamp) - interval '2 month'"
_COHORT = f"is_settled and created_date >= {_AGO(75)} and created_date < {_AGO(45)}"
_CHECKS = f""", measures as (
    select count(*) filter (where cast(created_local as date) = {_TODAY} - 2) as volume,
        {_PCT(f"count(*) filter (where created_date >= {_AGO(30)} and not has_valid_coordinates)", f"count(*) filter (where created_date >= {_AGO(30)})", 2)} as missing,
        round(median(resolution_hours) filter (where {_COHORT} and is_closed), 1) as med, round(quantile_cont(resolution_hours, 0.9) filter (where {_COHORT} and is_closed), 1) as p90,
        {_PCT(f"count(*) filter (where {_COHORT} and is_closed)", f"count(*) filter (where {_COHORT})", 2)} as closed
    from fact
), type_shift as ({_SHIFT("complaint_type", f"where complaint_type in {_TOP(10)}", _OF_SHOWN)}),
type_shift_all as (
    select complaint_type, month, share - lag(share) over (partition by complaint_type order by month) as delta from (
        select complaint_type, month, 100.0 * count(*) / (select count(*) from fact x where x.month = f.month) as share from fact f where complaint_type in {_TOP(10)} group by 1, 2)),
agency_shift as ({_SHIFT("agency", "", _OF_SHOWN)}),
type_delta as (select coalesce(max(abs(delta)), 0)::double as d from type_shift where {_SINCE}), agency_delta as (select coalesce(max(abs(delta)), 0)::double as d from agency_shift where {_SINCE}),
checks as (
    select 'row_count_volume' as check_name, 'recent_complete_day' as grain, volume::double as measured_value, '[4000, 28000]' as threshold_description,
        case when volume between 4000 and 28000 then 'pass' else 'fail' end as status from measures
    union all select 'missing_coordinate_rate', 'trailing_30_days', missing, '[0.5%, 7.0%]', case when missing between 0.5 and 7 then 'pass' else 'fail' end from measures
    union all select 'resolution_hours_p50_p90', 'recently_settled_cohort', med, 'median in [2,35], p90 in [250,600]', case when med between 2 and 35 and p90 between 250 and 600 then 'pass' else 'fail' end from measures
    union all select 'closure_rate_at_settlement', 'settlement_boundary_cohort', closed, '[90%, 99.9%]', case when closed between 90 and 99.9 then 'pass' else 'fail' end from measures
    union all select 'complaint_type_mom_share_shift', 'top_10_types_trailing_2_months', d, 'fail if any |delta| > 15pp', case when d > 15 then 'fail' else 'pass' end from type_delta
    union all select 'agency_mom_share_shift', 'all_agencies_trailing_2_months', d, 'fail if any |delta| > 15pp', case when d > 15 then 'fail' else 'pass' end from agency_delta
)"""
_DETECTED = f""", detected as (
    select 'undated_closure_rate_anomaly' as check_name, agency as grain, undated_closure_rate_pct as measured_value,
        'fired if rate > ' || regexp_replace(regexp_replace(cast(cast(threshold_pct as decimal(28, 6)) as varchar), '0+$', ''), '\\.$', '.0') || '%' as threshold_description,
        case when fired then 'fail' else 'pass' end as status
    from rate_detector where scan_month = (select max(scan_month) from rate_detector)
    union all select 'composition_drift_yoy', complaint_type, yoy_delta_pp, 'fired if |YoY delta| > 5pp', case when fired then 'fail' else 'pass' end from drift where month = (select max(month) from drift)
    union all select 'vocabulary_drift_new_member', dimension || ':' || value, volume_to_date::double, 'notification only, not pass/fail', 'info' from words where first_seen_month >= {_TODAY} - interval '90 day'
    union all select 'settlement_completeness_45d', strftime(cohort_month, '%Y-%m-%d'), completeness_pct_45d, 'warn <90%, fail <85%', status from completeness where cohort_month = (select max(cohort_month) from completeness)
    union all select 'mass_metadata_touch_trailing_30d', 'dataset', count(*) filter (where fired)::double, 'informational: count of mass-touch nights in trailing 30 days',
        case when count(*) filter (where fired) > 0 then 'info' else 'pass' end from touch where hour_bucket >= {_AGO(30)}
)"""
_MODELS = {"stg_service_requests": 49, "int_request_resolution": 8, "int_request_geography": 7, "dim_agency": 3, "dim_complaint_type": 3, "dim_location": 3, "dim_date": 11, "fct_service_requests": 19}
_CASES = (
    "resolution_hours_normal_close resolution_hours_closed_before_created_defect is_censored_for_open_request closed_but_not_yet_settled_yields_null_resolution"
    " is_settled_at_exactly_45_day_boundary is_settled_one_day_short_of_boundary is_settled_one_day_past_boundary"
).split()
_CARD = f""", card as (
    {" union all ".join(f"select 'contract_enforced' as check_name, 'contract' as category, '{m}' as grain, {n}::double as measured_value, '{n} columns, all typed' as threshold_description, 'pass' as status, null::date as acknowledged_date" for m, n in _MODELS.items())}
    union all {" union all ".join(f"select 'unit_test_passed', 'unit', 'test_{c}', null, null, 'pass', null" for c in _CASES)}
    union all select check_name, 'distributional', grain, {_SIX("measured_value")}, threshold_description, status, null from checks
    union all select check_name, 'detector', grain, measured_value, threshold_description,
        case when status = 'fail' and check_name = 'composition_drift_yoy' and grain = '1-URGENT' then 'acknowledged' else status end,
        case when check_name = 'composition_drift_yoy' and grain = '1-URGENT' then date '2001-07-01' end from detected
), scorecard as (select *, {_TODAY} as run_date, {_TO_UTC("timestamp '2001-08-02 00:00:00'")} as run_timestamp from card)"""
_WHOLE = _STAR + _RATES(5) + _DRIFT + _WORDS + _COMPLETE + _TOUCH + _CHECKS + _DETECTED + _CARD

_METRICS = {
    "request_count": "count(unique_key)",
    "closed_count": "count(*) filter (where is_closed)",
    "settled_count": "count(*) filter (where is_settled)",
    "closed_and_settled_count": "count(*) filter (where is_closed and is_settled)",
    "settled_count_excl_backlog": "count(*) filter (where is_settled and not is_undated_closure)",
    "censored_count": "count(*) filter (where is_censored)",
    "median_resolution_hours": f"median({_HOURS})",
    "p90_resolution_hours": _SIX(f"quantile_cont({_HOURS}, 0.9)"),
    "naive_median_resolution_hours": f"median({_NAIVE_HOURS})",
}
_RATIOS = {
    "closure_rate": ("closed_count", "request_count"), "settlement_rate": ("settled_count", "request_count"), "naive_closure_rate": ("closed_and_settled_count", "settled_count"),
    "closure_rate_excl_backlog": ("closed_and_settled_count", "settled_count_excl_backlog"),
}


def _metric_sql(group: dict[str, str], extra: str = "") -> str:
    """All metrics by some groups: alias -> SQL over the fact and the joined dimensions."""
    plain = [f"{sql} as {name}" for name, sql in _METRICS.items()]
    ratios = [_SIX(f"{_METRICS[a]}::double / nullif({_METRICS[b]}, 0)") + f" as {name}" for name, (a, b) in _RATIOS.items()]
    groups = [f"{sql} as {name}" for name, sql in group.items()]
    by = f" group by {', '.join(str(k + 1) for k in range(len(group)))}" if group else ""
    return f"{_STAR} select {', '.join(groups + plain + ratios)} from fact {extra}{by}"


_DAY = "extract(dow from created_local)"
_FACT_COLUMNS = (
    "unique_key, agency_key, complaint_type_key, location_key, date_key, created_date, closed_date, updated_at, resolution_hours, is_closed, is_censored, is_settled, is_undated_closure,"
    " has_valid_coordinates, latitude, longitude, incident_zip, status, borough"
)
_SEASON = "case when extract(month from {d}) in (12, 1, 2) then 'Winter' when extract(month from {d}) in (3, 4, 5) then 'Spring' when extract(month from {d}) in (6, 7, 8) then 'Summer' else 'Fall' end"
_SEASONAL = f"""{_STAR}, monthly as (
    select month, complaint_type, count(*) as request_count, (select count(*) from fact x where x.month = f.month) as month_total_requests
    from fact f where complaint_type in {_TOP(10)} and month > (select min(month) from fact) and month < (select max(month) from fact) group by 1, 2
), seasonal as (select cast(month as date) as month, complaint_type, request_count, {_PCT("request_count", "month_total_requests", 4)} as pct_share_of_month, month_total_requests from monthly)"""
_HISTORY = """, runs as (select (date '2001-08-02' - interval (7 * i) day)::date as day, i from range(0, 40) t(i)),
history as (select s.check_name, s.category, s.grain, s.measured_value + r.i as measured_value, s.threshold_description, case when r.i % 3 = 1 and s.status = 'pass' then 'warn' else s.status end as status,
    s.acknowledged_date, r.day as run_date, s.run_timestamp - to_days(cast(7 * r.i as integer)) as run_timestamp from scorecard s cross join runs r where r.i > 0),
merged as (select * from scorecard union all select * from history where run_date >= date '2001-08-02' - interval 180 day)"""

_LINES = """with ranked as (
    select l_orderkey, l_linenumber, date_trunc('month', l_shipdate)::date as created_date, l_quantity, l_discount, l_returnflag, l_linestatus,
        row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, date_trunc('month', l_shipdate) desc, l_quantity desc, l_discount desc, l_returnflag desc, l_linestatus desc) as rn
    from lineitem
), lines as (select * exclude (rn) from ranked where rn = 1)"""

SQL: dict[str, str] = {
    "Q1_staging": f"{_FLAGS} select unique_key, created_date, closed_date, updated_at, agency, agency_name, complaint_type, descriptor, incident_zip, status, community_board, borough, latitude, longitude, has_valid_coordinates from staged",
    "Q2_resolution": f"{_FLAGS} select unique_key, created_date, closed_date, is_closed, is_settled, is_censored, is_undated_closure, resolution_hours from resolved",
    "Q3_geography": f"{_FLAGS} select unique_key, borough, community_board, incident_zip, latitude, longitude, has_valid_coordinates from staged",
    "Q4_dim_agency": f"{_STAR} select * from dim_agency",
    "Q5_dim_complaint_type": f"{_STAR} select * from dim_type",
    "Q6_dim_location": f"{_STAR} select * from dim_location",
    "Q7_dim_date": f"""with days as (select cast(date '1995-01-01' + interval (i) day as date) as d from range(0, date_diff('day', date '1995-01-01', date '2001-12-31') + 1) t(i))
        select d as date_key, d as calendar_date, extract(year from d) as year, extract(quarter from d) as quarter, extract(month from d) as month, monthname(d) as month_name,
            extract(day from d) as day_of_month, extract(dow from d) as day_of_week, dayname(d) as day_name, extract(dow from d) in (0, 6) as is_weekend, {_SEASON.format(d="d")} as season from days""",
    "Q8_fact": f"{_STAR} select {_FACT_COLUMNS} from fact",
    "Q9_undated_closure_rate": f"{_STAR} {_RATES(5)} select * from rate_detector",
    "Q9_undated_closure_rate_one_sigma": f"{_STAR} {_RATES(1)} select * from rate_detector",
    "Q10_composition_drift": f"{_STAR} {_DRIFT} select * from drift",
    "Q11_vocabulary_drift": f"{_STAR} {_WORDS} select * from words",
    "Q12_settlement_completeness": f"{_STAR} {_COMPLETE} select * from completeness",
    "Q13_mass_touch": f"{_STAR} {_TOUCH} select * from touch",
    "Q14_distribution_checks": f"{_STAR} {_CHECKS} select check_name, grain, {_SIX('measured_value')} as measured_value, threshold_description, status from checks",
    "Q15_distribution_failed_rows": f"""{_STAR} {_CHECKS}
        select 'row_count_volume' as check_name, null::varchar as item, null::timestamp as month, volume::double as value from measures where volume < 4000 or volume > 28000
        union all select 'missing_coordinate_rate', null, null, missing from measures where missing < 0.5 or missing > 7
        union all select 'resolution_hours_p50_p90', null, null, med from measures where med < 2 or med > 35 or p90 < 250 or p90 > 600
        union all select 'closure_rate_at_settlement', null, null, closed from measures where closed < 90 or closed > 99.9
        union all select 'complaint_type_mom_share_shift', complaint_type, month, {_SIX("delta")} from type_shift_all where abs(delta) > 15 and {_SINCE}
        union all select 'agency_mom_share_shift', agency, month, {_SIX("delta")} from agency_shift where abs(delta) > 15 and {_SINCE}""",
    "Q16_scorecard": f"{_WHOLE} select * from scorecard",
    "Q17_history_merge": f"{_WHOLE} {_HISTORY} select * from merged",
    "Q18_overview": f"""{_STAR} select count(*) as request_count, count(distinct agency_key) as agency_count, strftime(min(created_local), '%Y-%m-%d') as date_min, strftime(max(created_local), '%Y-%m-%d') as date_max,
        {_PCT("count(*) filter (where is_closed)", "count(*)", 4)} as closure_rate_pct, {_PCT("count(*) filter (where is_settled)", "count(*)", 4)} as settlement_rate_pct,
        median({_HOURS}) as median_resolution_hours, {_SIX(f"quantile_cont({_HOURS}, 0.9)")} as p90_resolution_hours from fact""",
    "Q19_agency_performance": f"""{_STAR} select agency, agency_name, count(*) as request_count, median({_HOURS}) as median_resolution_hours, {_SIX(f"quantile_cont({_HOURS}, 0.9)")} as p90_resolution_hours,
        {_PCT("count(*) filter (where is_closed)", "count(*)", 4)} as closure_rate_pct, {_PCT("count(*) filter (where is_settled)", "count(*)", 4)} as settlement_rate_pct,
        {_PCT("count(*) filter (where is_closed and is_settled)", "count(*) filter (where is_settled)", 4)} as naive_closure_rate_pct,
        {_PCT("count(*) filter (where is_closed and is_settled)", "count(*) filter (where is_settled and not is_undated_closure)", 4)} as closure_rate_excl_backlog_pct
        from fact where agency_key is not null group by agency, agency_name""",
    "Q20_geo_equity": f"""{_STAR} select complaint_type, borough, count(*) as request_count, median({_HOURS}) as median_resolution_hours from fact
        where complaint_type in {_TOP(10)} and borough <> '' and has_valid_coordinates group by 1, 2""",
    "Q20_missing_coordinates": f"{_STAR} select {_PCT('count(*) filter (where not has_valid_coordinates)', 'count(*)', 2)} as missing_coord_pct from fact",
    "Q21_seasonality": f"{_SEASONAL} select * from seasonal",
    "Q22_naive_vs_correct": f"{_STAR} select median({_HOURS}) as correct_median_resolution_hours, median({_NAIVE_HOURS}) as naive_median_resolution_hours from fact",
    "Q23_mass_touch_fired": f"{_STAR} {_TOUCHES(1)} select * from touch where fired",
    "Q24_latest_scorecard": f"{_WHOLE} {_HISTORY} select * from merged where run_date = (select max(run_date) from merged)",
    "Q24_scorecard_trend": f"""{_WHOLE} {_HISTORY} select run_date, count(*) as checks_run, count(*) filter (where status in ('fail', 'warn')) as checks_not_passing,
        {_PCT("count(*) filter (where status in ('pass', 'acknowledged', 'info'))", "count(*)", 1)} as pass_rate_pct from merged group by 1""",
    "Q24_type_share": f"{_SEASONAL} select month, pct_share_of_month from seasonal where complaint_type = '1-URGENT'",
    "Q24_monthly_volume": f"{_SEASONAL} select distinct month, month_total_requests from seasonal",
    "Q25_metrics_total": _metric_sql({}),
    "Q25_metrics_by_agency": _metric_sql({"agency": "agency"}),
    "Q25_metrics_by_month": _metric_sql({"metric_time__month": "month"}),
    "Q25_metrics_by_type_and_borough": _metric_sql({"complaint_type": "complaint_type", "descriptor": "descriptor", "borough": "borough"}),
    "Q25_metrics_by_calendar": _metric_sql({"season": _SEASON.format(d="created_local"), "day_name": "dayname(created_local)", "is_weekend": f"{_DAY} in (0, 6)"}),
    "Q25_metrics_by_status_where": _metric_sql({"status": "status", "community_board": "community_board"}, "where has_valid_coordinates"),
    "Q27_quality_baseline": f"""{_RAW}, b as (select *, latitude is null or longitude is null or latitude = 0 or longitude = 0 as absent from bronze), m as (
            select count(*) as n, count(*) filter (where closed_date < created_date) as a, count(*) filter (where status = 'Closed' and closed_date is null) as b, count(*) filter (where absent) as c,
                count(*) filter (where not absent and not (latitude between 40.4959 and 40.9153 and longitude between -74.2557 and -73.7002)) as d,
                count(*) filter (where coalesce(trim(borough), '') in ('', 'Unspecified')) as e, count(distinct complaint_type) as f, count(distinct agency) as g from b)
        select 'closed_before_created' as metric, a as value, {_PCT("a", "n", 4)} as pct from m union all select 'closed_without_date', b, {_PCT("b", "n", 4)} from m
        union all select 'missing_coordinates', c, {_PCT("c", "n", 4)} from m union all select 'outside_bounds', d, {_PCT("d", "n", 4)} from m union all select 'unspecified_borough', e, {_PCT("e", "n", 4)} from m
        union all select 'distinct_complaint_types', f, null from m union all select 'distinct_agencies', g, null from m""",
    "Q28_agency_service_levels": f"""{_STAR} select agency, count(*) as settled, count(*) filter (where is_closed) as closed, {_PCT("count(*) filter (where is_closed)", "count(*)", 1)} as closure_rate_pct,
        count(*) filter (where is_censored) as censored, median(resolution_hours) as median_hours, {_SIX("quantile_cont(resolution_hours, 0.9)")} as p90_hours from fact where is_settled and agency_key is not null group by 1""",
    "Q28_equity_by_borough": f"""{_STAR} select complaint_type, borough, count(*) as settled, median(resolution_hours) as median_hours, {_SIX("quantile_cont(resolution_hours, 0.9)")} as p90_hours
        from fact where is_settled and complaint_type in {_TOP(5)} group by 1, 2""",
    "Q28_share_by_calendar_month": f"""{_STAR}, c as (select extract(month from created_local) as month, complaint_type, count(*) as n from fact group by 1, 2)
        select month, complaint_type, n, {_PCT("n", "sum(n) over (partition by month)", 4)} as pct_share from c""",
    "Q28_undated_by_month": f"{_STAR} select agency, month, count(*) as undated from fact where is_undated_closure group by 1, 2",
    "Q28_missing_by_month": f"{_STAR} select month, count(*) as total, count(*) filter (where not has_valid_coordinates) as missing, {_PCT('count(*) filter (where not has_valid_coordinates)', 'count(*)', 2)} as pct_missing from fact group by 1",
    "SC15_recent_slice": f"{_RAW} select unique_key, created_date from bronze where created_date >= (select max(created_date) - interval 90 day from bronze)",
    "SC16_freshness": f"{_RAW} select max(updated_at) as newest, date_diff('day', max(updated_at), timestamp '2001-08-02 04:00:00') as days_old, case when date_diff('day', max(updated_at), timestamp '2001-08-02 04:00:00') > 10 then 'error' when date_diff('day', max(updated_at), timestamp '2001-08-02 04:00:00') > 3 then 'warn' else 'pass' end as status from bronze",
    "SC18_grouped_counts": f"{_RAW} select status, extract(hour from created_date) as hour, count(*) as n from bronze group by 1, 2",
    "ST1_watermark_window": f"{_RAW} select unique_key, updated_at from bronze where updated_at >= timestamp '2001-06-01 00:00:00' - interval 48 hour and updated_at < timestamp '2001-08-01 03:00:00' and created_date >= timestamp '2001-05-01 00:00:00'",
    "F22_anchor": "select event_id, case when extract(hour from ts) < 3 then date_trunc('day', ts) - interval 1 day + interval 3 hour else date_trunc('day', ts) + interval 3 hour end as anchored from events",
    "A17_touch_frequencies": f"{_RAW} select updated_at, count(*) as n from bronze group by 1 having count(*) > 1",
    "A17_touch_lags": f"{_RAW}, l as (select status, epoch(updated_at)::bigint - epoch(created_date)::bigint as x from bronze) select status, min(x) as least, median(x) as median, max(x) as greatest from l group by 1",
    "U3_shared_parts": "select l_partkey from lineitem where l_returnflag = 'R' intersect select l_partkey from lineitem where l_linestatus = 'O'",
    "J16_model_assertions": f"""{_STAR}, found as (
        select 'closed_before_created' as assertion, count(*) filter (where closed_date < created_date) as failures from fact
        union all select 'hours_of_censored_requests', count(*) filter (where is_censored and resolution_hours is not null) from fact
        {" ".join(f"union all select 'null_{c}', count(*) filter (where {c} is null) from fact" for c in "unique_key date_key created_date is_closed is_censored is_settled is_undated_closure has_valid_coordinates".split())}
        union all select 'rows_lost_in_staging', abs((select count(*) from staged) - (select count(*) from bronze))
        union all select 'repeated_unique_key', count(*) from (select unique_key from fact group by 1 having count(*) > 1)
        union all select 'unmatched_date_key', count(*) from fact where date_key not between date '1995-01-01' and date '2001-12-31'
        union all select unnest(['unmatched_agency_key', 'unmatched_complaint_type_key', 'unmatched_location_key', 'repeated_agency_key', 'repeated_complaint_type_key', 'repeated_location_key', 'repeated_date_key']), 0)
        select assertion, failures, case when failures = 0 then 'pass' when assertion = 'closed_before_created' and failures <= 3500 then 'warn' else 'error' end as status from found""",
    "J13_scorecard_assertions": f"""{_WHOLE}, found as (
        select 'wrong_column_counts' as assertion, count(*) filter (where check_name = 'contract_enforced' and measured_value <> try_cast(split_part(threshold_description, ' ', 1) as double)) as failures from scorecard
        union all select 'unknown_categories', count(*) filter (where category not in ('contract', 'unit', 'distributional', 'detector')) from scorecard
        union all select 'unknown_statuses', count(*) filter (where status not in ('pass', 'warn', 'fail', 'acknowledged', 'info')) from scorecard
        union all select 'repeated_checks', count(*) from (select check_name, grain, run_date from scorecard group by all having count(*) > 1))
        select assertion, failures, case when failures = 0 then 'pass' else 'error' end as status from found""",
    "J16_missing_references": f"{_STAR} select 'agency' as dimension, count(*) filter (where agency_key is null) as missing from fact union all select 'complaint_type', count(*) filter (where complaint_type_key is null) from fact union all select 'location', count(*) filter (where location_key is null) from fact",
    "PF9_repeated_keys": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
    "Q26_upsert": """with ranked as (
            select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_returnflag desc, l_linestatus desc) as rn from lineitem),
        target as (select l_orderkey, l_linenumber, l_shipdate as created_date, l_quantity from ranked where rn = 1 and l_returnflag <> 'N'),
        batch as (select l_orderkey, l_linenumber, l_shipdate as created_date, case when l_discount > 0.05 then l_quantity + 1 else l_quantity end as l_quantity from ranked where rn = 1 and l_linestatus = 'O')
        select coalesce(b.l_orderkey, t.l_orderkey) as l_orderkey, coalesce(b.l_linenumber, t.l_linenumber) as l_linenumber, coalesce(b.created_date, t.created_date) as created_date,
            coalesce(b.l_quantity, t.l_quantity) as l_quantity,
            case when b.l_orderkey is null then 'kept' when t.l_orderkey is null then 'inserted' when t.l_quantity is distinct from b.l_quantity then 'updated' else 'same' end as change
        from target t full join batch b using (l_orderkey, l_linenumber)""",
    "F19_decode": """select cast(o_orderkey as varchar) as unique_key, o_orderdate as created_date, case when o_orderkey % 7 <> 0 then o_orderdate end as closed_date,
            o_orderdate as updated_at, case when o_orderkey % 5 <> 0 then o_orderkey / 8 end as latitude,
            case when o_orderkey % 3 <> 0 then o_orderkey / 4 end as location_lon, case when o_orderkey % 3 <> 0 then o_orderkey / 2 end as location_lat, null::varchar as agency
        from orders""",
    "F23_month_windows": """with ends as (select min(o_orderdate) as a, max(o_orderdate) as b from orders),
        months as (select unnest(generate_series(date_trunc('month', a)::timestamp, b::timestamp, interval '1 month')) as m, a, b from ends)
        select strftime(m, '%Y-%m') as label, greatest(m, a::timestamp) as start, least(m + interval '1 month', b::timestamp) as end from months where greatest(m, a::timestamp) < least(m + interval '1 month', b::timestamp)""",
    "SK3_upsert_table": f"""{_LINES}, target as (select * from lines where l_returnflag <> 'N'),
        batch as (select * replace (case when l_discount > 0.05 then l_quantity + 1 else l_quantity end as l_quantity) from lines where l_linestatus = 'O' or l_returnflag = 'R')
        select l_orderkey, l_linenumber, created_date, l_quantity, l_returnflag from batch
        union all select l_orderkey, l_linenumber, created_date, l_quantity, l_returnflag from target t
            where not exists (select 1 from batch b where b.l_orderkey = t.l_orderkey and b.l_linenumber = t.l_linenumber)""",
    "SK5_table_versions": f"""{_LINES}, one as (select * from lines where l_returnflag = 'A'), two as (select * from one union all select * from lines where l_returnflag = 'R'),
        three as (select * from two where created_date >= date '1994-01-01' union all select * from lines where l_returnflag = 'N' and created_date < date '1996-01-01'),
        four as (select * from three where l_quantity <= 40)
        {" union all ".join(f"select {k} as version, count(*) as n, sum(l_quantity) as quantity, max(created_date) as newest from {t}" for k, t in enumerate(("one", "two", "three", "four"), 1))}""",
    "SC6_table_months": f"{_LINES} select created_date, count(*) as n from lines where extract(year from created_date) = 1995 group by 1",
    "SC8_seed_file": "select n_name, case when n_nationkey % 5 <> 0 then n_nationkey::bigint end as number from nation",
    "SC17_arrow_relation": "select r_name, count(*) as nations from nation join region on n_regionkey = r_regionkey group by 1",
}
