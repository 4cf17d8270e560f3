"""The SQL each query is checked against, for DuckDB on the same tables."""

from __future__ import annotations

from itertools import product

ORACLES: dict[str, str] = {}

VIEWS = """views as (
  select o_custkey as viewer_id, l_partkey as video_id, l_quantity as watch_time_minutes
  from lineitem join orders on l_orderkey = o_orderkey
), videos as (
  select p_partkey as video_id, p_type as type, p_name as title, replace(p_name, ' ', ', ') as genre
  from part
)"""

RESULTS = """results as (
  select Name, Sex, Equipment, case when AgeClass <> '5-LOW' then AgeClass end as AgeClass, Tested, "Date",
    MeetName, MeetCountry, Federation, ParentFederation, BodyweightKg,
    case when squat < 0 then 0 else squat end as Best3SquatKg,
    case when bench < 0 then 0 else bench end as Best3BenchKg,
    case when deadlift < 0 then 0 else deadlift end as Best3DeadliftKg,
    TotalKg, FailedAttempts,
    case when BodyweightKg <> 0 then (case when squat < 0 then 0 else squat end) / BodyweightKg end as SquatRatio,
    case when BodyweightKg <> 0 then bench / BodyweightKg end as BenchRatio,
    case when BodyweightKg <> 0 then deadlift / BodyweightKg end as DeadliftRatio,
    year("Date")::integer as "Year"
  from (
    select c_name as Name, c_mktsegment as Sex, o_orderstatus as Equipment, o_orderpriority as AgeClass,
      l_linestatus = 'F' as Tested, o_orderdate::date as "Date", n_name as MeetName,
      'REGION_' || n_regionkey as MeetCountry, nullif(l_returnflag, 'N') as Federation,
      nullif(o_orderstatus, 'P') as ParentFederation, greatest(c_acctbal, 0.0::double) as BodyweightKg,
      c_acctbal as squat, nullif(l_quantity, 1) as bench, l_extendedprice as deadlift, o_totalprice as TotalKg,
      (c_acctbal < 0)::int + (l_discount - 0.05::double < 0)::int + (l_tax - 0.04::double < 0)::int
      + (-c_acctbal < 0)::int + (0.05::double - l_discount < 0)::int + (0.04::double - l_tax < 0)::int
      + (l_quantity < 25)::int + (l_quantity > 1 and l_quantity < 10)::int + (l_linenumber < 2)::int as FailedAttempts
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      join nation on c_nationkey = n_nationkey
  )
)"""

MEETS = RESULTS + """, totals as (
  select MeetName, "Date", sum(FailedAttempts)::bigint as FailedAttempts, count(MeetName) as Participants
  from results where MeetName is not null and "Date" is not null group by all
), meets as (
  select distinct r.MeetName, r.MeetCountry, r."Date", r.Federation, r.ParentFederation, t.FailedAttempts, r."Year",
    t.Participants
  from results r left join totals t on r.MeetName = t.MeetName and r."Date" = t."Date"
)"""

DECISIONS = """decisions as (
  select case when o_orderpriority = '1-URGENT' then 'Detain' else 'Release' end as Pretrial_Recommendation,
    case when l_linestatus = 'F' then 'Yes' else 'No' end as Judge_Followed_Recommendation,
    case c_mktsegment when 'MACHINERY' then 'Male' when 'FURNITURE' then 'Male' when 'BUILDING' then 'Female'
      else 'Other' end as Gender,
    case p_type when 'STANDARD' then 'Black' when 'ECONOMY' then 'White' when 'MEDIUM' then 'Hispanic'
      when 'PROMO' then 'Asian/Pacific Islander' else 'Other' end as Race,
    case when l_quantity <> 1 and l_linenumber - 1 < 5 then (l_linenumber - 1)::varchar else '5+' end
      as VPRAI_Score_Grouped,
    case l_returnflag when 'R' then 'Yes' when 'A' then 'No' end as FTA,
    l_quantity as AgeAtBooking, o_orderdate::date as Booking_Date, o_orderstatus as Release_Type,
    case when o_orderpriority = '1-URGENT' and l_linestatus <> 'F' then 'A'
      when o_orderpriority is distinct from '1-URGENT' and l_linestatus = 'F' then 'B' end as "Group"
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join part on l_partkey = p_partkey
), cases as (select * from decisions where "Group" is not null)"""

SALE_LINES = """sale_lines as (
  select l_orderkey * 10 + l_linenumber as transaction_id, l_orderkey as receipt_id, min(l_partkey) as listing_id,
    sum(l_quantity)::bigint as quantity, max(l_extendedprice) as price, l_linenumber
  from lineitem group by l_orderkey, l_linenumber
), items as (
  select 'G' || transaction_id as id, transaction_id + i as transaction_id,
    case when quantity > 25 then 'shipped' else 'printed' end as status,
    quantity::double / case i when 0 then 2 else 4 end as cost,
    case i when 0 then 'normal' else 'express' end as shipping_method,
    'T' || (transaction_id + i) as tracking_number, 'day ' || (transaction_id % 7) as shipped_at
  from sale_lines, (values (0), (1)) v(i)
)"""

RECEIPTS = """receipts as (
  select o_orderkey as receipt_id, o_custkey as buyer_user_id, 'Customer ' || o_custkey as buyer_name,
    null::varchar as buyer_email, o_orderstatus as payment_status,
    case when o_orderstatus <> 'P' then o_totalprice end as total_price,
    case when o_orderstatus <> 'P' then 'USD' end as currency_code, o_totalprice / 100 as shipping_cost,
    epoch(o_orderdate)::bigint as created_at, epoch(o_orderdate)::bigint + 3600 as updated_at
  from orders
)"""

NOTES = """notes as (
  select doc_id, text, case when quality = 1 then 'Successful' else 'Unsuccessful' end as Outcome,
    case when lang <> 'fr' then lang else 'Other/Unknown' end as Gender,
    case when source <> 'src3' then source else 'Other/Unknown' end as Race,
    case when toxic = 1 then 'High' else 'Not Assessed' end as Risk,
    case when lang <> 'es' then (n_chars % 60 + 18)::double end as age, toxic::double as arrests_past_year,
    case when n_chars > 1000 then 'Felony' else 'Misdemeanor Probation' end as ProbationType,
    case when n_chars > 300 then n_chars::double else 0 end as DaysOnProbation, n_chars % 11 as EpicsDosagePastYear
  from documents join labels using (doc_id)
), aged as (
  select *, (floor(coalesce(age, (select avg(age) from notes)) / 10) * 10)::double as AgeGroup from notes
)"""

_NUMBERS = [
    "Tested", "BodyweightKg", "Best3SquatKg", "Best3BenchKg", "Best3DeadliftKg", "TotalKg",
    "FailedAttempts", "SquatRatio", "BenchRatio", "DeadliftRatio", "Year",
]
_LEVELS = ["0-NONE", "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
_LEVEL_ROWS = ", ".join(f"({i}, '{level}')" for i, level in enumerate(_LEVELS))


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def _means(columns: list[str]) -> str:
    return ", ".join(f'round(avg("{c}"::double), 4) + 0.0 as "{c}"' for c in columns)


# --- scans, projections and filters ----------------------------------------------

oracle("scan_parquet", "select l_orderkey, l_partkey, l_quantity from lineitem where l_quantity >= 25")
oracle("project_subset", "select c_custkey as customer, c_name, c_mktsegment as segment from customer")
oracle(
    "filter_eq",
    "select o_orderkey, o_orderpriority from orders where o_orderstatus = 'F' and o_orderpriority <> '5-LOW'",
)
oracle(
    "filter_null_safe_ne",
    """select l_orderkey, l_linenumber, nullif(l_returnflag, 'N') as federation from lineitem
    where nullif(l_returnflag, 'N') is distinct from 'A'""",
)
oracle(
    "filter_and_or",
    """select l_orderkey, l_linenumber, l_quantity as quantity from lineitem
    where (l_returnflag = 'R' or l_returnflag = 'A') and l_quantity <> 1""",
)
oracle("filter_isin", "select p_partkey, p_type from part where p_type in ('PROMO', 'SMALL')")
oracle(
    "cast_schema",
    """select event_id, try_cast(event_id * 1000000 as integer) as id,
    try_cast(json_extract_string(props, '$.k') as smallint)::integer as cmc_rank,
    round(value::float::double, 4) + 0.0 as price from events""",
)

# --- video watching -------------------------------------------------------------

oracle(
    "top_k_per_group",
    f"""with {VIEWS}, watched as (
      select video_id, sum(watch_time_minutes) as total_watch_time from views group by video_id
    ) select type, title, total_watch_time from (
      select type, title, total_watch_time, rank() over (partition by type order by total_watch_time desc) as rn
      from videos join watched using (video_id)) where rn <= 10""",
)
oracle(
    "watch_time_by_video",
    f"with {VIEWS} select video_id, sum(watch_time_minutes) as total_watch_time from views group by video_id",
)
_VIEWERS = f"""with {VIEWS}, totals as (
  select viewer_id, sum(watch_time_minutes) as total_watch_time,
    count(distinct video_id) as total_unique_videos_watched from views group by viewer_id
) select * from totals"""
oracle("viewer_totals", _VIEWERS)
oracle("viewer_totals_merged", _VIEWERS)
oracle(
    "quartiles_over_pulls",
    """select l_returnflag, l_linestatus, count(*) as n, true as "25%", true as "50%", true as "75%"
    from lineitem group by 1, 2""",
)
oracle("top_viewers_by_time", _VIEWERS + " order by total_watch_time desc, viewer_id limit 10")
oracle("top_viewers_by_videos", _VIEWERS + " order by total_unique_videos_watched desc, viewer_id limit 10")
oracle(
    "country_watch_time",
    f"""with {VIEWS} select n_name as country, sum(watch_time_minutes) as total_watch_time
    from views join customer on viewer_id = c_custkey join nation on c_nationkey = n_nationkey
    group by n_name order by total_watch_time desc, country limit 10""",
)
oracle(
    "video_viewers_vs_watch",
    f"""with {VIEWS}, per_video as (
      select video_id, count(distinct viewer_id) as num_unique_viewers, sum(watch_time_minutes) as total_watch_time
      from videos join views using (video_id) group by video_id
    ) select num_unique_viewers, round(avg(total_watch_time), 4) as average_total_watch_time
    from per_video group by num_unique_viewers""",
)
oracle(
    "avg_watch_by_video",
    f"""with {VIEWS} select video_id, round(avg(watch_time_minutes), 4) as average_watch_time
    from videos join views using (video_id) group by video_id""",
)
oracle(
    "avg_watch_by_video_integer",
    f"""with {VIEWS} select video_id, (sum(watch_time_minutes)::bigint // count(*))::bigint as average_watch_time
    from videos join views using (video_id) group by video_id""",
)
oracle(
    "avg_watch_overall",
    f"with {VIEWS} select round(avg(watch_time_minutes), 4) as average_watch_time from views",
)
_GENRES = VIEWS + """, genres as (select video_id, trim(unnest(string_split(genre, ','))) as genre from videos)"""
oracle(
    "genre_watch_time",
    f"""with {_GENRES}, watched as (
      select video_id, sum(watch_time_minutes) as total_watch_time from views group by video_id
    ) select genre, sum(total_watch_time) as total_watch_time from genres join watched using (video_id)
    group by genre order by total_watch_time desc, genre limit 10""",
)
oracle(
    "genre_video_count",
    f"with {_GENRES} select genre, count(distinct video_id) as num_videos from genres group by genre",
)

# --- meet results ---------------------------------------------------------------

oracle("count_negatives", f"with {RESULTS} select Name, FailedAttempts, count(*) as n from results group by all")
oracle(
    "clamp_negative",
    """select c_custkey, case when c_acctbal < 0 then 0.0::double else nullif(c_acctbal, 0) end as balance
    from customer""",
)
oracle(
    "safe_ratio",
    """select o_orderkey, case when c_acctbal > 0 then round(o_totalprice / c_acctbal, 6) end as ratio
    from orders join customer on o_custkey = c_custkey""",
)
oracle("meets", f"with {MEETS} select * from meets")
oracle(
    "meet_means",
    f"""with {MEETS} select round(avg(Participants), 4) as Participants, round(avg(FailedAttempts), 4) as FailedAttempts
    from meets""",
)
oracle(
    "top_federations",
    f"""with {RESULTS} select ParentFederation, count(Name) as participants from results
    where ParentFederation is not null group by 1 order by 2 desc, 1 limit 5""",
)
oracle(
    "top_meet_countries",
    f"""with {MEETS} select MeetCountry, count(MeetName) as meets from meets
    where MeetCountry is not null group by 1 order by 2 desc, 1 limit 10""",
)
oracle(
    "meets_per_year",
    f"""with {MEETS} select "Year"::integer as "Year", count(*) as meets from meets where "Year" <> 2001 group by 1""",
)
oracle(
    "participants_per_year",
    f"""with {RESULTS} select "Year"::integer as "Year", count(*) filter (Sex = 'MACHINERY') as male,
    count(*) filter (Sex is distinct from 'MACHINERY') as non_male from results where "Year" <> 2001 group by 1""",
)
oracle(
    "value_counts",
    f"with {RESULTS} select Federation, count(*) as n from results where Federation is not null group by 1",
)
oracle(
    "value_counts_ordered",
    f"""with {RESULTS}, levels(position, AgeClass) as (values {_LEVEL_ROWS})
    select position::integer as position, l.AgeClass, count(r.AgeClass) as n
    from levels l left join results r on l.AgeClass = r.AgeClass group by 1, 2""",
)
oracle("group_means", f"with {RESULTS} select Sex, {_means(_NUMBERS)} from results where Sex is not null group by Sex")
oracle("group_means_tested", f"with {RESULTS} select Tested, {_means(_NUMBERS[1:])} from results group by Tested")
oracle(
    "group_means_equipment",
    f"with {RESULTS} select Equipment, {_means(_NUMBERS)} from results where Equipment is not null group by Equipment",
)
oracle(
    "group_means_ordered",
    f"""with {RESULTS}, levels(position, AgeClass) as (values {_LEVEL_ROWS})
    select position::integer as position, l.AgeClass, {_means(_NUMBERS)}
    from levels l left join results r on l.AgeClass = r.AgeClass group by 1, 2""",
)
oracle(
    "null_profile",
    f"with {RESULTS} "
    + " union all ".join(
        f"select '{c}' as \"column\", round_even(avg(({c} is null)::int::double), 3) as missing from results"
        for c in ["Name", "AgeClass", "Federation", "ParentFederation", "Best3BenchKg", "SquatRatio"]
    ),
)
oracle(
    "describe",
    f"with {RESULTS} "
    + " union all ".join(
        f"""select '{c}' as "column", count(v)::double as "count", round(avg(v), 4) + 0.0 as mean,
        round(stddev_samp(v), 4) as std, round(min(v), 4) + 0.0 as "min", round(quantile_cont(v, 0.25), 4) + 0.0 as "25%",
        round(quantile_cont(v, 0.5), 4) + 0.0 as "50%", round(quantile_cont(v, 0.75), 4) + 0.0 as "75%",
        round(max(v), 4) + 0.0 as "max" from (select "{c}"::double as v from results)"""
        for c in _NUMBERS[1:]
    ),
)
oracle(
    "corr_matrix",
    f"with {RESULTS}, r as (select "
    + ", ".join(f'corr("{x}"::double, "{y}"::double) as c{i}' for i, (x, y) in enumerate(product(_NUMBERS, _NUMBERS)))
    + " from results) "
    + " union all ".join(
        f"select '{x}' as x, '{y}' as y, case when not isnan(c{i}) then round(c{i}, 6) + 0.0 end as r from r"
        for i, (x, y) in enumerate(product(_NUMBERS, _NUMBERS))
    ),
)
oracle("histogram", f'with {RESULTS} select FailedAttempts::double as "bin", count(*) as n from results group by 1')


def _cells(x: str, x_width: float, y: str, y_width: float) -> str:
    return f"""with {RESULTS} select Sex, (floor({x} / {x_width}) * {x_width})::double as x_bin,
    (floor({y} / {y_width}) * {y_width})::double as y_bin, count(*) as n from results
    where Sex is not null and {x} is not null and {y} is not null group by 1, 2, 3"""


def _panel(name: str, x: str, x_width: float, y: str, y_width: float) -> str:
    return f"""select Sex, '{name}' as panel, (floor({x} / {x_width}) * {x_width})::double as x_bin,
    (floor({y} / {y_width}) * {y_width})::double as y_bin, count(*) as n from results
    where Sex is not null and {x} is not null and {y} is not null group by 1, 2, 3, 4"""


oracle(
    "density_panels",
    f"with {RESULTS} "
    + " union all ".join(
        [
            _panel("weight and squat", "BodyweightKg", 500, "Best3SquatKg", 500),
            _panel("weight and bench", "BodyweightKg", 500, "Best3BenchKg", 5),
            _panel("weight and deadlift", "BodyweightKg", 500, "Best3DeadliftKg", 5000),
            _panel("squat and bench", "Best3SquatKg", 500, "Best3BenchKg", 5),
            _panel("squat and deadlift", "Best3SquatKg", 500, "Best3DeadliftKg", 5000),
            _panel("bench and deadlift", "Best3BenchKg", 5, "Best3DeadliftKg", 5000),
        ]
    ),
)
# eight hexadecimal digits of the hash, below 0.05 * 2^32
oracle(
    "scatter_sample",
    """select l_orderkey || '-' || l_linenumber as id, l_quantity, l_extendedprice from lineitem
    where substr(md5(l_orderkey || '-' || l_linenumber || '|0'), 1, 8) <= '0ccccccc'""",
)
oracle("describe_bracketed", ORACLES["describe"])
oracle(
    "null_profile_all",
    f"with {RESULTS} "
    + " union all ".join(
        f"select '{c}' as \"column\", round_even(avg((\"{c}\" is null)::int::double), 3) as missing from results"
        for c in [
            "Name", "Sex", "Equipment", "AgeClass", "Tested", "Date", "MeetName", "MeetCountry", "Federation",
            "ParentFederation", "BodyweightKg", "Best3SquatKg", "Best3BenchKg", "Best3DeadliftKg", "TotalKg",
            "FailedAttempts", "SquatRatio", "BenchRatio", "DeadliftRatio", "Year",
        ]
    ),
)
oracle("density_2d", _cells("BodyweightKg", 500, "Best3DeadliftKg", 5000))
oracle("density_2d_lifts", _cells("Best3BenchKg", 5, "Best3DeadliftKg", 5000))
oracle(
    "quartiles_by_group",
    f"""with {RESULTS} select Equipment, Tested, round(quantile_cont(TotalKg, 0.25), 4) as q1,
    round(quantile_cont(TotalKg, 0.5), 4) as median, round(quantile_cont(TotalKg, 0.75), 4) as q3
    from results group by 1, 2""",
)
oracle("quartiles_bracketed", ORACLES["quartiles_by_group"])


def _density(data: str, keys: str, points: int, extend: float, scale: str = "") -> str:
    """SQL for a Gaussian density of ``value`` in the table ``data``."""
    on = " and ".join(f"s.{k.strip()} = w.{k.strip()}" for k in keys.split(","))
    named = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""stats as (
      select {keys}, count(*) as n, min(value) as low, max(value) as high,
        stddev_samp(value) * pow(count(*), -0.2) as width from {data} group by {keys}
    ), weighted as (select {keys}, value, count(*) as weight from {data} group by {keys}, value
    ), grid as (
      select s.*, g::integer as point,
        low - {extend} * width + g * ((high - low + 2 * {extend} * width) / {points - 1}) as x
      from stats s, range({points}) r(g)
    ) select {named}, point, round(any_value(x), 6) + 0.0 as x,
      round(sum(weight * exp(-0.5 * pow((x - value) / width, 2))) / any_value(n * width * sqrt(2 * pi())) {scale}, 6)
        as density
    from grid s join weighted w on {on} group by {named}, point"""


oracle(
    "violin_density",
    f"with {RESULTS}, data as (select Equipment, Tested, TotalKg as value from results), "
    + _density("data", "Equipment, Tested", 100, 2, "* 1e6"),
)

# --- release decisions -----------------------------------------------------------

oracle(
    "normalise_category",
    """select case c_mktsegment when 'MACHINERY' then 'male' when 'BUILDING' then 'female' when 'FURNITURE' then 'male'
      when 'HOUSEHOLD' then 'unknown' end as gender,
    case p_type when 'STANDARD' then 'black' when 'ECONOMY' then 'white' when 'MEDIUM' then 'hispanic/latin/mexican'
      when 'PROMO' then 'filipino' when 'LARGE' then 'martian' end as race, count(*) as n
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
      join part on l_partkey = p_partkey group by 1, 2""",
)
oracle("recode_map", f"with {DECISIONS} select Gender, Race, count(*) as n from decisions group by 1, 2")
oracle(
    "assign_groups",
    f"""with {DECISIONS} select Pretrial_Recommendation, Judge_Followed_Recommendation, "Group", count(*) as n
    from decisions group by 1, 2, 3""",
)
oracle(
    "score_label",
    """select l_orderkey, l_linenumber, l_quantity, case when l_quantity <> 1 and l_linenumber <= 5
    then (l_linenumber - 1)::varchar else '5+' end as score from lineitem""",
)
_RATE = "count(*) filter (FTA = 'Yes')::double / nullif(count(FTA), 0)"
oracle("rate_by_group", f'with {DECISIONS} select "Group", round({_RATE}, 6) as FTA_Rate from cases group by 1')
oracle(
    "rate_label",
    f"""with {DECISIONS} select "Group", format('{{:.1f}}%', {_RATE} * 100) as FTA_Label from cases group by 1""",
)
oracle(
    "rate_by_group_release",
    f'with {DECISIONS} select "Group", Release_Type, round({_RATE}, 6) as FTA_Rate from cases group by 1, 2',
)
oracle(
    "rate_by_group_score",
    f"""with {DECISIONS} select "Group", VPRAI_Score_Grouped as VPRAI_Score, round({_RATE}, 6) as FTA_Rate,
    left(VPRAI_Score_Grouped, 1)::integer as position from cases group by 1, 2""",
)
_TABLE = """select "Group", count(*) filter (FTA = 'No') as "No", count(*) filter (FTA = 'Yes') as "Yes"
  from cases where FTA is not null group by 1"""
oracle("contingency", f"with {DECISIONS} {_TABLE}")
oracle("group_sizes", f'with {DECISIONS} select "Group", count(*) as "Count" from cases group by 1')
for _key, _column in {
    "counts_by_score": "VPRAI_Score_Grouped",
    "counts_by_attr": "Gender",
    "counts_by_race": "Race",
}.items():
    oracle(_key, f'with {DECISIONS} select {_column}, "Group", count(*) as "Count" from cases group by 1, 2')
for _key, _column in {"outcome_by_gender": "Gender", "outcome_by_race": "Race"}.items():
    oracle(
        _key,
        f"""with {DECISIONS} select {_column}, coalesce(FTA = 'Yes', false) as FTA_Flag, count(*) as "Count"
        from cases group by 1, 2""",
    )
oracle(
    "missed_by_score",
    f"""with {DECISIONS} select VPRAI_Score_Grouped, "Group", count(*) as "Count" from cases where FTA = 'Yes'
    group by 1, 2""",
)
oracle(
    "monthly_trend",
    f"""with {DECISIONS} select date_trunc('month', Booking_Date)::date as "month",
    count(*) filter ("Group" = 'A') as "A", count(*) filter ("Group" = 'B') as "B"
    from cases where FTA = 'Yes' group by 1""",
)


def _cells_of(row: str) -> str:
    return f"""cells as (
      select r.{row}, c.FTA, (select count(*) from cases x where x.{row} = r.{row} and x.FTA = c.FTA) as observed,
        (r.n * c.n)::double / (select count(*) from cases where FTA is not null) as expected
      from (select {row}, count(FTA) as n from cases where FTA is not null group by 1) r,
        (select FTA, count(*) as n from cases where FTA is not null group by 1) c
    )"""


_CHI2 = f"""with {DECISIONS}, {_cells_of('"Group"')}, test as (
  select sum(pow(abs(observed - expected) - least(0.5, abs(observed - expected)), 2) / expected) as statistic,
    1::bigint as dof from cells)"""
oracle("chi2_test", f"{_CHI2} select round(statistic, 6) as statistic, dof from test")
oracle(
    "chi2_wide",
    f"""with {DECISIONS}, {_cells_of('VPRAI_Score_Grouped')}
    select round(sum(pow(observed - expected, 2) / expected), 6) as statistic,
    ((count(distinct VPRAI_Score_Grouped) - 1) * (count(distinct FTA) - 1))::bigint as dof from cells""",
)
oracle(
    "chi2_nullable",
    f"""with {DECISIONS}, kept as (
      select Gender as r, nullif(Race, 'Other') as c from cases where Gender is not null and nullif(Race, 'Other') is not null
    ), rs as (select r, count(*) as n from kept group by r), cs as (select c, count(*) as n from kept group by c),
    cells as (
      select rs.r, cs.c, (select count(*) from kept k where k.r = rs.r and k.c = cs.c) as observed,
        rs.n * cs.n / (select count(*) from kept)::double as expected from rs, cs
    ) select round(sum(pow(observed - expected, 2) / expected), 6) as statistic,
    ((count(distinct r) - 1) * (count(distinct c) - 1))::bigint as dof from cells""",
)
oracle(
    "chi2_expected",
    f"""with {DECISIONS}, {_cells_of('"Group"')}
    select "Group", FTA, observed, round(expected, 4) as expected from cells""",
)
# one degree of freedom: the upper tail is 1 - erf(sqrt(statistic / 2)), here by its power series
oracle(
    "chi2_pvalue",
    f"""{_CHI2} select round(any_value(statistic), 6) as statistic, any_value(dof) as dof,
    round(1 - 2 / sqrt(pi()) * sum(pow(-1, k) * pow(statistic / 2, k + 0.5) / (gamma(k + 1) * (2 * k + 1))), 6) as p_value
    from test, range(60) r(k)""",
)
oracle(
    "kde_by_group",
    f'with {DECISIONS}, data as (select "Group", AgeAtBooking as value from cases), '
    + _density("data", '"Group"', 200, 3),
)
oracle(
    "kde_all_vs_missed",
    f"""with {DECISIONS}, data as (select 'All' as series, AgeAtBooking as value from cases
    union all select 'FTA Only', AgeAtBooking from cases where FTA = 'Yes'), """
    + _density("data", "series", 200, 3),
)

# --- quotes --------------------------------------------------------------------

oracle(
    "json_flatten",
    """select event_id, user_id as id, event_type as name, case when event_type = 'view' then 'chain' end as platform_name,
    value as "quote_USD_price", value * 100 as "quote_USD_volume_24h" from events""",
)
oracle(
    "ingest_snapshots",
    """select user_id::integer as "CoinID", event_type as "Name", upper(event_type) as "Symbol",
    json_extract_string(props, '$.k')::integer as "CMC_Rank",
    round((value * 10)::float::double, 4) as "Circulating_Supply", round(value::float::double, 4) as "Quote_USD_Price",
    strftime(ts, '%Y-%m-%d %H:%M:%S') as "API_TimeStamp" from events""",
)
oracle(
    "latest_snapshot",
    """select event_id, user_id as id, event_type as name, value as "quote_USD_price",
    strftime(ts, '%Y-%m-%d %H:%M:%S') as "timestamp" from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)

# --- shop orders -----------------------------------------------------------------

oracle(
    "receipt_rows",
    f"""with {RECEIPTS} select receipt_id, buyer_user_id, buyer_name, buyer_email, payment_status,
    round(total_price, 4) as total_price, currency_code, round(shipping_cost, 4) as shipping_cost, created_at, updated_at
    from receipts""",
)
oracle(
    "receipt_times",
    f"""with {RECEIPTS} select receipt_id, created_at,
    strftime(make_timestamp(created_at * 1000000), '%Y-%m-%d %H:%M:%S') as created_at_time,
    strftime(make_timestamp(updated_at * 1000000), '%Y-%m-%d %H:%M:%S') as updated_at_time from receipts""",
)
oracle(
    "sale_line_rows",
    f"""with {SALE_LINES} select transaction_id, receipt_id, listing_id as item_id, 'Item ' || listing_id as title,
    quantity, round(price, 2) as price, 'SKU-' || listing_id as sku,
    '[{{"property_id":' || l_linenumber || ',"value":"size"}}]' as variation_details from sale_lines""",
)
oracle(
    "json_page_explode",
    f"""with {SALE_LINES} select id, transaction_id, status, round(cost, 4) as cost, shipping_method, tracking_number,
    shipped_at from items""",
)
oracle(
    "receipt_lines",
    f"""with {SALE_LINES}, {RECEIPTS} select transaction_id, receipt_id, buyer_user_id, quantity,
    round(price, 2) as price, round(total_price, 2) as total_price from sale_lines join receipts using (receipt_id)""",
)
oracle(
    "order_enrich",
    """select o_orderkey as id, o_orderstatus as status, round(coalesce(subtotal, 0), 4) as subtotal,
    round(coalesce(shipping, 0), 4) as shipping, round(coalesce(tax, 0), 4) as tax
    from orders left join (
      select l_orderkey, sum(l_quantity) as subtotal, max(l_extendedprice) as shipping, min(l_tax) as tax
      from lineitem group by 1 having count(*) > 2) on o_orderkey = l_orderkey""",
)
oracle(
    "fulfilment_match",
    f"""with {SALE_LINES} select i.id, i.transaction_id, i.status, round(i.cost, 4) as cost, s.receipt_id, s.quantity
    from items i left join sale_lines s using (transaction_id)""",
)
oracle(
    "fulfilment_unmatched",
    f"""with {SALE_LINES} select id, transaction_id, status from items
    where transaction_id not in (select transaction_id from sale_lines)""",
)

# --- case notes ------------------------------------------------------------------

oracle("parse_ts", "select o_orderkey, case when o_orderstatus <> 'P' then o_orderdate::date end as day from orders")
oracle("try_numeric", f"with {NOTES} select doc_id, age from notes")
oracle(
    "impute_mean",
    f"with {NOTES} select doc_id, round(coalesce(age, (select avg(age) from notes)), 4) as age from notes",
)
oracle(
    "fill_missing",
    f"""with {NOTES} select doc_id, Gender, Race, Risk, arrests_past_year, ProbationType, DaysOnProbation,
    EpicsDosagePastYear::bigint as EpicsDosagePastYear from notes""",
)
oracle("decade_bucket", f"with {NOTES} select AgeGroup, count(*) as n from aged group by 1")

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_WORD = r"[\p{L}\p{N}_]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The rules of the note cleaning, stated again so that the check does not follow the code.
_CONTRACTIONS = [
    ("what's", 'what is '),
    ("can't", 'cannot '),
    ("i'm", 'i am '),
    ("'ll", ' will '),
    ("'scuse", ' excuse '),
    ("[:|♣'§♠*/?=%&#•~^><►_]", ' '),
]
_ABBREVIATIONS = [
    (' ct ', ' court '),
    (' cort ', ' court '),
    (' crt ', ' court '),
    ('ov ', 'office visit '),
    ('ovwd', 'office visit with defendant '),
    ('hv ', 'home visit '),
    ('h v ', ' home visit '),
    (' jl ', ' jail '),
    (' ltr ', ' letter '),
    (' vm ', ' voicemail '),
    (' msg ', ' message '),
    ('lm ', ' left message '),
    ('l m ', ' left message '),
    ('vm ', ' voicemail '),
    ('v m ', ' voicemail '),
    (' bw ', ' bench warrant '),
    (' vop ', ' violation of probation '),
    (' returbnd ', ' returned '),
    (' comp ', ' completed '),
    (' att ', ' attempted '),
    ('att ', 'attempted '),
    ('recvd ', ' received '),
    ('recv ', ' received '),
    ('t c ', ' call '),
    ('tc ', ' call '),
    (' thru ', ' through '),
    (' rpt ', ' report '),
    (' rptd ', ' reported '),
    (' wdef ', ' with defendant '),
    (' d ', ' defendant '),
    ('def ', ' defendant '),
    ('def[^\\n] ', ' defendant '),
    (' presemt ', ' present '),
    (' yr ', ' year '),
]
_OUTCOME_PHRASES = [
    "death", "passed away", "deceased", "closed", "file close", "terminated",
    "convicted", "conviction", "sentenced", "prison sentence", "jail sentence",
]
_TIDYING = [
    ('([a-zA-Z]+)([/!?.])([a-zA-Z]+)', '$1 $2 $3'),
    (' s ', ' '),
    ("([*!?']+)", ' $1 '),
    ('[ ]{2,}', ' '),
]


def _cleaned(column: str) -> str:
    """The cleaning chain nested into one expression.

    RE2 has neither lookaround nor backreferences. Lone letters are replaced in
    two rounds, as neighbours share a blank; runs are shortened by dropping
    every character equal to the two before it.
    """
    sql = f"lower({column})"

    def apply(pattern: str, replacement: str) -> None:
        nonlocal sql
        sql = f"regexp_replace({sql}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"

    for _ in range(2):
        apply(rf"(^|[^\p{{L}}\p{{N}}_])[uU]($|[^\p{{L}}\p{{N}}_])", r"\1you\2")
    for pattern, replacement in _CONTRACTIONS + _ABBREVIATIONS:
        apply(pattern, replacement)
    for phrase in _OUTCOME_PHRASES:
        apply(phrase, "")
    apply(_SPACE, " ")
    chars = f"string_split({sql}, '')"
    sql = (
        f"(select coalesce(array_to_string(list_filter(l, lambda x, i: not (i > 2 and x = l[i - 1] and x = l[i - 2])), ''), '')"
        f" from (select {chars} as l))"
    )
    for pattern, replacement in _TIDYING:
        for i in "123":
            replacement = replacement.replace(f"${i}", f"\\{i}")
        apply(pattern, replacement)
    return f"trim({sql}, ' ')"


oracle("clean_text", f"select doc_id, {_cleaned('text')} as text from documents")
_STOP = ", ".join(f"'{w}'" for w in ["the", "and", "of", "in", "is", "der", "die", "und", "le", "la", "et", "el", "los"])
oracle(
    "remove_stopwords",
    f"""select doc_id, coalesce(array_to_string(list_filter(regexp_split_to_array(lower(text), '{_SPACE}'),
    lambda w: w <> '' and not list_contains([{_STOP}], w)), ' '), '') as text from documents""",
)
# The English stop words that the classifier drops.
_DEFAULT_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
"""
_STOP_DEFAULT = ", ".join(_quoted(w) for w in _DEFAULT_STOP_WORDS.split())
oracle(
    "remove_stopwords_default",
    f"""select doc_id, coalesce(array_to_string(list_filter(regexp_split_to_array(lower(text), '{_SPACE}'),
    lambda w: w <> '' and not list_contains([{_STOP_DEFAULT}], w)), ' '), '') as text from documents""",
)
_GRAMS = rf"""words as (
  select doc_id, unnest(regexp_extract_all(lower(text), '{_WORD}{{2,}}')) as w,
    generate_subscripts(regexp_extract_all(lower(text), '{_WORD}{{2,}}'), 1) as i from documents
), near as (
  select doc_id, w, lead(w, 1) over seq as w2, lead(w, 2) over seq as w3, lead(w, 3) over seq as w4
  from words window seq as (partition by doc_id order by i)
), grams as (
  select doc_id, w as term from near
  union all select doc_id, w || ' ' || w2 from near where w2 is not null
  union all select doc_id, w || ' ' || w2 || ' ' || w3 from near where w3 is not null
  union all select doc_id, w || ' ' || w2 || ' ' || w3 || ' ' || w4 from near where w4 is not null
)"""
oracle(
    "ngrams",
    f"""with {_GRAMS} select doc_id, len(string_split(term, ' '))::integer as words, count(*) as n,
    count(distinct term) as distinct_terms, min(term) as first_term, max(term) as last_term from grams group by 1, 2""",
)
_VOCABULARY = f"""with {_GRAMS}, counted as (
  select term, count(distinct doc_id) as documents, count(*) as occurrences from grams group by term
), vocabulary as (
  select term, documents, occurrences, ln((n + 1) / (documents + 1)::double) + 1 as idf
  from counted, (select count(*) as n from documents) where documents >= 2 and documents <= 0.5 * n
  order by occurrences desc, term limit 15000
)"""
oracle("tfidf_vocab", f"{_VOCABULARY} select term, documents, occurrences, round(idf, 6) as idf from vocabulary")
oracle(
    "tfidf",
    f"""{_VOCABULARY}, raw as (
      select doc_id, term, count(*) * any_value(idf) as w from grams join vocabulary using (term) group by doc_id, term
    ) select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight from raw""",
)
oracle(
    "one_hot",
    f"with {NOTES} select doc_id, "
    + ", ".join(
        f"({column} = '{level}')::int::double as \"{column}_{level}\""
        for column, levels in {
            "Gender": ["Other/Unknown", "de", "en", "es"],
            "Risk": ["High", "Not Assessed"],
            "ProbationType": ["Felony", "Misdemeanor Probation"],
        }.items()
        for level in levels
    )
    + " from notes",
)
oracle(
    "one_hot_all",
    f"with {NOTES} "
    + " union all ".join(
        f"select doc_id, '{c}_' || {c} as flag from notes" for c in ["Gender", "Race", "Risk", "ProbationType"]
    ),
)
oracle(
    "encoded_categories",
    f"""with {NOTES}, parted as (
      select *, row_number() over (order by md5(doc_id || '|0')) <= ceil(0.3 * count(*) over ()) as held from notes
    ), long as (
      {" union all ".join(f"select doc_id, held, '{c}' as category, {c} as level from parted" for c in ["Gender", "Race", "Risk", "ProbationType"])}
    ), known as (
      select category, level, (row_number() over (partition by category order by level) - 1)::int as position
      from (select distinct category, level from long where not held)
    ), sizes as (select category, count(*)::int as size from known group by 1)
    select doc_id, category, level, size, position from long join sizes using (category) left join known using (category, level)""",
)
# ridge with an intercept that is not penalised: a centred two by two system
oracle(
    "ridge_two_features",
    """with rows as (
      select doc_id, n_chars / 1000.0::double as a, toxic::double as b, case when quality = 1 then 1.0 else -1.0 end::double as y
      from documents join labels using (doc_id)
    ), means as (select avg(a) as ma, avg(b) as mb, avg(y) as my from rows),
    sums as (
      select sum((a - ma) * (a - ma)) + 1 as aa, sum((b - mb) * (b - mb)) + 1 as bb, sum((a - ma) * (b - mb)) as ab,
        sum((a - ma) * (y - my)) as ca, sum((b - mb) * (y - my)) as cb from rows, means
    ), weights as (
      select (bb * ca - ab * cb) / (aa * bb - ab * ab) as wa, (aa * cb - ab * ca) / (aa * bb - ab * ab) as wb from sums
    ) select doc_id, round(my + wa * (a - ma) + wb * (b - mb), 3) + 0.0 as score from rows, means, weights""",
)
oracle(
    "ridge_held_out",
    """with rows as (
      select doc_id, n_chars / 1000.0::double as a, toxic::double as b, case when quality = 1 then 1.0 else -1.0 end::double as y,
        row_number() over (order by md5(doc_id || '|0')) <= ceil(0.3 * count(*) over ()) as held
      from documents join labels using (doc_id)
    ), means as (select avg(a) as ma, avg(b) as mb, avg(y) as my from rows where not held),
    sums as (
      select sum((a - ma) * (a - ma)) + 1 as aa, sum((b - mb) * (b - mb)) + 1 as bb, sum((a - ma) * (b - mb)) as ab,
        sum((a - ma) * (y - my)) as ca, sum((b - mb) * (y - my)) as cb from rows, means where not held
    ), weights as (
      select (bb * ca - ab * cb) / (aa * bb - ab * ab) as wa, (aa * cb - ab * ca) / (aa * bb - ab * ab) as wb from sums
    ), scored as (select doc_id, my + wa * (a - ma) + wb * (b - mb) as s from rows, means, weights where held)
    select doc_id, round(s, 3) + 0.0 as score, case when s > 0 then 1 else 0 end as prediction from scored""",
)
oracle(
    "score_ridge_counts",
    f"""with {NOTES}, parted as (
      select Outcome, row_number() over (order by md5(doc_id || '|0')) <= ceil(0.3 * count(*) over ()) as held from notes
    ) select Outcome, count(*) as n, count(*) as labelled from parted where held group by 1""",
)
# every held-out text against every training text
oracle(
    "knn_votes",
    f"""with {_GRAMS}, parts as (
      select doc_id, quality, row_number() over (order by md5(doc_id || '|0')) <= ceil(0.3 * count(*) over ()) as held
      from documents join labels using (doc_id)
    ), counted as (
      select term, count(distinct doc_id) as documents, count(*) as occurrences
      from grams join parts using (doc_id) where not held group by term
    ), vocabulary as (
      select term, ln((n + 1) / (documents + 1)::double) + 1 as idf
      from counted, (select count(*) as n from parts where not held) where documents >= 2 and documents <= 0.5 * n
      order by occurrences desc, term limit 15000
    ), raw as (
      select doc_id, held, term, count(*) * any_value(idf) as w
      from grams join parts using (doc_id) join vocabulary using (term) group by all
    ), unit as (select doc_id, held, term, w / sqrt(sum(w * w) over (partition by doc_id)) as w from raw),
    pairs as (
      select q.doc_id as query, d.doc_id, round(sum(q.w * d.w), 9) as s
      from unit q join unit d using (term) where q.held and not d.held group by all
    ), best as (
      select *, row_number() over (partition by query order by s desc, doc_id) as r from pairs qualify r <= 5
    ), tally as (select query, quality, count(*) as n from best join parts using (doc_id) group by all)
    select query as doc_id, arg_min(quality, (-n, quality)) as prediction, max(n) as votes, sum(n)::bigint as voters
    from tally group by query""",
)
_SIDE = "(Outcome = 'Successful')::int::double"
oracle(
    "corr_with_outcome",
    f"with {NOTES}, long as ("
    + " union all ".join(
        [
            f"select '{c}' as \"column\", {c}::double as v, {_SIDE} as o from aged"
            for c in ["arrests_past_year", "DaysOnProbation", "EpicsDosagePastYear", "AgeGroup"]
        ]
        + [
            f"select '{c}_' || level, (a.{c} = level)::int::double, {_SIDE} from aged a, (select distinct {c} as level from aged)"
            for c in ["Gender", "Race", "Risk", "ProbationType"]
        ]
    )
    + ') select "column", round(corr(v, o), 6) + 0.0 as r from long group by 1',
)
oracle(
    "split_train_test",
    """select doc_id, case when row_number() over (order by md5(doc_id || '|0')) <= ceil(0.3 * count(*) over ())
    then 'test' else 'train' end as part from documents""",
)
oracle(
    "balance_classes",
    """select doc_id, quality from (
      select *, row_number() over (partition by quality order by md5(doc_id || '|0')) as rn from labels
    ) where rn <= (select min(n) from (select count(*) as n from labels group by quality))""",
)
oracle(
    "union_all",
    "select l_linestatus, count(*) as n, count(distinct l_orderkey) as orders from lineitem group by 1",
)
oracle(
    "accuracy",
    """select round(avg((case when l_returnflag = 'N' then 'O' else 'F' end = l_linestatus)::int), 6) as accuracy
    from lineitem""",
)
