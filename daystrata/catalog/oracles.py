"""The registered queries again, as plain SQL over the driver tables."""

from __future__ import annotations

from daystrata.catalog.queries import DESCRIBED, FIRST_TEST_KEY, MEANS
from daystrata.plans.models import MODEL_COLUMNS, REQUIRED, STRESS_FEATURES, ZERO_FILLED
from daystrata.schema import DAILY_LOG_FIELDS, NON_NEGATIVE, RANGE_RULES

# Of the 32-bit hash of a key: below it, a row is a train row.
TRAIN_CUT = round(0.8 * 2**32)

DAILY_LOG = """
 select cast(l_suppkey as int) as user_id,
  cast(18 + l_suppkey % 60 as int) as age,
  case l_suppkey % 3 when 0 then 'M' when 1 then 'F' end as gender,
  cast(l_shipdate as date) as date,
  cast(400*sum(cast(l_quantity as int)) - 2000 as int) as steps,
  cast(25 + sum(l_orderkey) % 190 as double) as heart_rate_avg,
  cast(1.5 as double) + (sum(l_partkey) % 30)*cast(0.5 as double) as sleep_hours,
  cast(400 + (sum(l_orderkey)*7) % 8000 as double) as calories_burned,
  cast((sum(l_partkey)*3) % 640 - 20 as double) as exercise_minutes,
  cast((sum(l_orderkey)+sum(l_partkey)) % 11 as int) as stress_level,
  cast(40 + l_suppkey % 80 + (sum(l_orderkey) % 8)*cast(0.5 as double) as double) as weight_kg,
  cast(16 + l_suppkey % 20 + (sum(l_partkey) % 4)*cast(0.25 as double) as double) as bmi
 from lineitem group by l_suppkey, cast(l_shipdate as date)"""

FLAWED = """
 select case when stress_level = 3 and steps % 3 = 0 then null else user_id end as user_id, age, gender,
  case when steps % 7 = 0 then '2024-9-6' when steps % 11 = 0 then 'garbage' else cast(date as varchar(10)) end as date,
  steps, heart_rate_avg,
  case when calories_burned % 11 = 0 then null when calories_burned % 13 = 0 then cast(0 as double)
   else sleep_hours end as sleep_hours,
  calories_burned, exercise_minutes, stress_level, weight_kg, bmi
 from daily_log"""

RAW_LOG = "select * from flawed union all select * from flawed where user_id % 5 = 0"

COLUMNS = list(DAILY_LOG_FIELDS)
ISO = (
    "case when regexp_full_match(date,'[0-9]{4}-[0-9]{2}-[0-9]{2}') then cast(try_strptime(date,'%Y-%m-%d') as date) end"
)
WEEKDAY_NUM = "cast((dayofweek(date)+6)%7 as int)"
DATE_KEY = "cast(strftime(date,'%Y%m%d') as int)"

ACTIVITY = "case when steps < 5000 then 'sedentary' when steps < 10000 then 'light' when steps < 15000 then 'moderate' else 'active' end"
SLEEP = (
    "case when sleep_hours >= 0 and sleep_hours < 6 then 'poor' when sleep_hours >= 6 and sleep_hours < 8 then 'fair'"
    " when sleep_hours >= 8 and sleep_hours < 10 then 'good' when sleep_hours >= 10 and sleep_hours < 24 then 'excellent'"
    " else 'poor' end"
)
BMI = "case when bmi < 18.5 then 'underweight' when bmi < 25 then 'normal' when bmi < 30 then 'overweight' else 'obese' end"
STRESS = (
    "case when stress_change_30d >= 3 then 'more_stress' when stress_change_30d <= -3 then 'less_stress' else 'no_changes' end"
)
HEIGHT_M = "case when bmi > 0 then sqrt(weight_kg/bmi) end"
BMR = f"(10*weight_kg + 6.25*({HEIGHT_M}*100) - 5*age + case when gender = 'M' then 5 else -161 end)"
FLAGS = (
    "cast(steps between 0 and 4999 as int) as activity_level_sedentary,"
    " cast(steps between 5000 and 9999 as int) as activity_level_light,"
    " cast(steps between 10000 and 14999 as int) as activity_level_moderate,"
    " cast(steps between 15000 and 999999 as int) as activity_level_active"
)
PARTS = (
    "cast(year(date) as int) as year, cast(month(date) as int) as month, cast(day(date) as int) as day,"
    f" dayname(date) as weekday, {WEEKDAY_NUM} as weekday_num, cast({WEEKDAY_NUM} >= 5 as int) as is_weekend"
)
ROWS_30 = "over (partition by user_id order by date rows between 29 preceding and current row)"
DAYS_30 = "over (partition by user_id order by date range between interval 29 days preceding and current row)"
LAG = "over (partition by user_id order by date)"
LAGS = (
    f"select user_id, date, lag(weight_kg) {LAG} as weight_prev, lag(stress_level) {LAG} as lag1_stress,"
    f" lag(sleep_hours) {LAG} as lag1_sleep_hours from clean"
)


def rd(value: str, digits: int = 2) -> str:
    """Decimal half-up rounding, as Spark rounds."""
    return f"cast(round(cast({value} as decimal(28,12)),{digits}) as double)"


def _clipped() -> str:
    return ", ".join(f"case when {c} < 0 then 0 else {c} end as {c}" if c in NON_NEGATIVE else c for c in COLUMNS)


def _ranges() -> str:
    return " and ".join(f"{c} between {low} and {high}" for c, (low, high) in RANGE_RULES.items())


CLIPPED = f"select {_clipped()} from daily_log"
CLEAN = f"select * from clipped where {_ranges()} and steps > 0"
RAW_CLIPPED = f"select {_clipped()} from raw_log"
RAW_CLEAN = (
    f"select * replace ({ISO} as date) from (select distinct * from raw_clipped where {_ranges()} and steps > 0)"
    f" where user_id is not null and {ISO} is not null"
)
SILVER = f"""
 select *, {FLAGS}, {ACTIVITY} as activity_level, {SLEEP} as sleep_quality, {BMI} as bmi_category, {PARTS},
  lag(weight_kg) {LAG} as weight_prev, weight_kg - lag(weight_kg, 30) {LAG} as weight_change_30d,
  avg(steps) {ROWS_30} as ra30_steps, avg(calories_burned) {ROWS_30} as ra30_calories,
  avg(exercise_minutes) {ROWS_30} as ra30_ex_minutes, lag(stress_level) {LAG} as lag1_stress,
  lag(sleep_hours) {LAG} as lag1_sleep_hours, avg(stress_level) {ROWS_30} as ra30_stress,
  stress_level - lag(stress_level, 30) {LAG} as stress_change_30d,
  {HEIGHT_M} as height_m, ({HEIGHT_M})*100 as height_cm, {BMR} as bmr, calories_burned - {BMR} as caloric_balance
 from raw_clean"""
FACT = f"""
 select user_id, {DATE_KEY} as date_key, age, gender, sleep_hours, heart_rate_avg, stress_level, steps,
  exercise_minutes, calories_burned, weight_kg, bmi, {rd('height_cm')} as height_cm, {rd('bmr')} as bmr,
  {rd('ra30_steps')} as ra30_steps, {rd('ra30_calories')} as ra30_calories, {rd('ra30_ex_minutes')} as ra30_ex_minutes,
  {rd('caloric_balance')} as caloric_balance, {rd('weight_change_30d')} as weight_change_30d,
  lag1_stress as yesterday_stress, lag1_sleep_hours as yesterday_sleep, month, year, day, weekday, weekday_num,
  is_weekend, activity_level, sleep_quality, bmi_category, {rd('ra30_stress')} as ra30_stress, stress_change_30d
 from silver"""

# Frames in order of dependence; a query lists the ones it reads.
FRAMES = {
    "daily_log": DAILY_LOG,
    "flawed": FLAWED,
    "raw_log": RAW_LOG,
    "clipped": CLIPPED,
    "clean": CLEAN,
    "raw_clipped": RAW_CLIPPED,
    "raw_clean": RAW_CLEAN,
    "silver": SILVER,
    "fact_daily": FACT,
}
NEEDS = {
    "daily_log": ["daily_log"],
    "raw_log": ["daily_log", "flawed", "raw_log"],
    "clean": ["daily_log", "clipped", "clean"],
    "raw_clean": ["daily_log", "flawed", "raw_log", "raw_clipped", "raw_clean"],
}
NEEDS["silver"] = [*NEEDS["raw_clean"], "silver"]
NEEDS["fact_daily"] = [*NEEDS["silver"], "fact_daily"]


def over(frame: str, body: str, *more: str) -> str:
    """``body`` with the common table expressions of ``frame`` (and ``more``) in front."""
    names = [n for n in FRAMES if n in {*NEEDS[frame], *(n for m in more for n in NEEDS[m])}]
    return "with " + ",\n".join(f"{n} as ({FRAMES[n]})" for n in names) + "\n" + body


def _means(window: str) -> str:
    inner = ", ".join(f"avg({c}) {window} as {out}" for out, c in MEANS.items())
    outer = ", ".join(f"{rd(out)} as {out}" for out in MEANS)
    return f"select user_id, date, {outer} from (select user_id, date, {inner} from clean)"


def _changes(n: int, clamp: int | None = None) -> str:
    columns = {f"weight_change_{30 if clamp else n}d": "weight_kg", f"stress_change_{30 if clamp else n}d": "stress_level"}
    inner = ", ".join(f"{c} - lag({c}, {n}) {LAG} as {out}" for out, c in columns.items())
    held = "case when {0} > {1} then {1} when {0} < -{1} then -{1} else {0} end as {0}"
    outer = ", ".join(held.format(out, clamp) if clamp else out for out in columns)
    return f"select user_id, date, {outer} from (select user_id, date, {inner} from clean)"


def _first_violation() -> str:
    cases = " ".join(f"when not coalesce({c} between {low} and {high}, false) then '{c}'" for c, (low, high) in RANGE_RULES.items())
    return f"case {cases} end"


def _outliers() -> str:
    rows = " union all ".join(
        f"select '{c}' as \"column\", (select count(*) from marked where first_rule = '{c}') as removed,"
        f" (select count(*) from marked where not coalesce({c} between {low} and {high}, false)) as violations"
        for c, (low, high) in RANGE_RULES.items()
    )
    return f", marked as (select *, {_first_violation()} as first_rule from raw_clipped) {rows}"


def _described() -> str:
    rows = " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n, {rd(f'avg({c})')} as mean, cast(median({c}) as double) as median,"
        f" {rd(f'stddev_samp({c})')} as stddev, cast(min({c}) as double) as min, cast(max({c}) as double) as max from daily_log"
        for c in DESCRIBED
    )
    return rows


def _missing() -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", count(*)-count({c}) as nulls, count(*) as rows,"
        f" {rd(f'100.0*(count(*)-count({c}))/count(*)')} as pct from raw_log"
        for c in COLUMNS
    )


def _categories() -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", {c} as category, count(*) as rows,"
        f" {rd('100.0*count(*)/sum(count(*)) over ()')} as pct from silver group by {c}"
        for c in ("gender", "activity_level", "sleep_quality", "bmi_category")
    )


def _issues() -> str:
    keys = ", ".join(COLUMNS)
    parts = [f"select 'missing' as \"check\", '{c}' as \"column\", count(*) - count({c}) as bad_rows from raw_log" for c in COLUMNS]
    parts += [
        f"select 'out_of_range', '{c}', count(*) filter (where {c} < {low} or {c} > {high}) from raw_log"
        for c, (low, high) in RANGE_RULES.items()
    ]
    parts += [f"select 'zero', '{c}', count(*) filter (where {c} = 0) from raw_log" for c in ("steps", "sleep_hours")]
    parts.append(
        f"select 'duplicate', '*', cast(sum(n-1) as bigint) from (select count(*) as n from raw_log group by {keys})"
    )
    return "select * from (" + " union all ".join(parts) + ") where bad_rows > 0"


def _classification() -> str:
    guess = SLEEP.replace("sleep_hours", "yesterday_sleep")
    return f""", rows as (select sleep_quality as l, {guess} as p from fact_daily),
 classes as (select c, (select count(*) from rows where l = c) as t, (select count(*) from rows where p = c) as q,
  (select count(*) from rows where l = c and p = c) as h from (select l as c from rows union select p from rows))
 select cast(sum(t) as bigint) as rows, {rd('cast(sum(h) as double)/sum(t)', 4)} as accuracy,
  {rd('sum(t*(2.0*h/(t+q)))/sum(t)', 4)} as f1 from classes"""


def _day_changes() -> str:
    return """select a.user_id, a.date, a.weight_kg - b.weight_kg as weight_change_30d,
 a.stress_level - b.stress_level as stress_change_30d
 from clean a left join clean b on b.user_id = a.user_id and b.date = a.date - 30"""


SILVER_SHOWN = (
    "select * replace ("
    + ", ".join(
        f"{rd(c)} as {c}"
        for c in ("ra30_steps", "ra30_calories", "ra30_ex_minutes", "ra30_stress", "height_cm", "bmr", "caloric_balance")
    )
    + f", {rd('height_m', 4)} as height_m) from silver"
)


DIM_USER = (
    "select user_id, age, gender, "
    + ", ".join(f"{rd(f'avg({c})')} as avg_{c}" for c in ("height_cm", "weight_kg", "bmi", "bmr"))
    + " from silver group by user_id, age, gender"
)
DIM_DATE = f"select distinct {DATE_KEY} as date_key, date, day, month, year, weekday from silver"
# Rows of the third arrival, and all rows of the users whose first days come with it.
DEALT = """
 (select user_id, case when user_id % 5 = 1 and date < '1995-10-01' then 2 when date < '1997-04-01' then 0
   when date < '1999-07-01' then 1 else 2 end as arrival, user_id % 5 = 1 and date < '1995-10-01' as early from raw_clean)"""
APPEND_COUNTS = f"""
 select arrival::bigint as batch, count(*) as rows from {DEALT} where arrival < 2 group by arrival
 union all select 2, count(*) from {DEALT} where arrival = 2 or user_id in (
  select user_id from {DEALT} group by user_id having bool_or(early) and bool_or(arrival < 2))"""
LABELED = f"select {STRESS.replace('stress_change_30d', 'coalesce(stress_change_30d, 0)')} as label from fact_daily"


def _index(col: str, missing_last: bool = False) -> str:
    """Rank of a category by falling frequency, ties by name; null comes after all others if kept."""
    first = "name_missing, " if missing_last else ""
    return f"""(select {col} as name, cast(row_number() over (order by {first}n desc, {col}) - 1 as double) as idx from (select {col}, {col} is null as name_missing, count(*) as n from fact_daily group by {col}))"""


INDEXED = f"""
 select f.*, g.idx as gender_idx, a.idx as activity_level_idx from fact_daily f
 join {_index('gender', True)} g on g.name is not distinct from f.gender
 join {_index('activity_level', True)} a on a.name is not distinct from f.activity_level"""

MERGED = """
 select user_id, date_key, stress_level, sleep_quality, weight_change_30d from
 (select user_id, date_key, stress_level from fact_daily where stress_level >= 4)
 full join (select user_id, date_key, sleep_quality from fact_daily where sleep_hours >= 8) using (user_id, date_key)
 full join (select user_id, date_key, weight_change_30d from fact_daily where weight_change_30d is not null)
 using (user_id, date_key)"""


def all_oracles() -> dict[str, str]:
    keys = ", ".join(COLUMNS)
    filled = ", ".join(f"coalesce({c}, 0) as {c}" for c in ZERO_FILLED)
    required = " and ".join(f"{c} is not null" for c in REQUIRED)
    model_columns = ", ".join(f"coalesce({c}, 0) as {c}" if c in ZERO_FILLED else c for c in MODEL_COLUMNS)
    train = " + ".join(f"coalesce({c}, 0)" if c in ZERO_FILLED else c for c in STRESS_FEATURES)
    md5 = "md5(concat_ws('|', coalesce(cast(user_id as varchar), ''), coalesce(cast(date_key as varchar), ''), '42'))"
    return {
        "clip_negative": over("daily_log", f"select {_clipped()} from daily_log"),
        "range_filter": over("daily_log", f"select * from daily_log where {_ranges()}"),
        "drop_zero_steps": over("daily_log", "select * from daily_log where steps > 0"),
        "dedup_rows": over("raw_log", "select distinct * from raw_log"),
        "parse_date": over("raw_log", f"select * replace ({ISO} as date) from raw_log"),
        "drop_null_keys": over("raw_log", "select * from raw_log where user_id is not null and date is not null"),
        "clean": over("raw_clean", "select * from raw_clean"),
        "all_null_columns": over("raw_log", "select 'note' as \"column\" from raw_log limit 1"),
        "missing_values": over("raw_log", _missing()),
        "duplicate_rows": over(
            "raw_log",
            "select cast(sum(n) as bigint) as rows, count(*) as distinct_rows, cast(sum(n-1) as bigint) as duplicate_rows"
            f" from (select count(*) as n from raw_log group by {keys})",
        ),
        "outlier_report": over("raw_clean", _outliers()),
        "outlier_rate": over(
            "raw_clean",
            f"select count(*) as rows, count({_first_violation()}) as outliers,"
            f" {rd(f'100.0*count({_first_violation()})/count(*)')} as pct from raw_clipped",
        ),
        "zero_audit": over(
            "raw_log",
            " union all ".join(
                f"select '{c}' as \"column\", count(*) filter (where {c} = 0) as zeros, count(*) as rows from raw_log"
                for c in ("steps", "sleep_hours")
            ),
        ),
        "describe_numeric": over("daily_log", _described()),
        "age_distribution": over(
            "daily_log",
            f"select cast(min(age) as double) as min, cast(max(age) as double) as max, {rd('avg(age)')} as mean,"
            " cast(median(age) as double) as median from daily_log",
        ),
        "completeness": over(
            "clean",
            "select *, " + rd("100.0*rows_after/rows_before") + " as pct_kept from (select"
            " (select count(*) from daily_log) as rows_before, (select count(*) from clean) as rows_after)",
        ),
        "category_distribution": over("silver", _categories()),
        "quality_issues": over("raw_log", _issues()),
        "activity_one_hot": over("clean", f"select user_id, date, {FLAGS} from clean"),
        "activity_level": over("daily_log", f"select user_id, date, steps, {ACTIVITY} as activity_level from daily_log"),
        "sleep_quality": over("raw_log", f"select user_id, date, sleep_hours, {SLEEP} as sleep_quality from raw_log"),
        "bmi_category": over("clean", f"select user_id, date, bmi, {BMI} as bmi_category from clean"),
        "bucketize": over(
            "daily_log",
            "select user_id, date, steps, case when steps <= 0 then null when steps <= 3000 then 'very_low' when steps <= 7000 then 'low'"
            " when steps <= 12000 then 'moderate' else 'high' end as step_band from daily_log",
        ),
        "date_parts": over("clean", f"select user_id, date, {PARTS} from clean"),
        "date_key": over("clean", f"select user_id, date, {DATE_KEY} as date_key from clean"),
        "height": over(
            "clean",
            f"select user_id, date, {rd(HEIGHT_M, 4)} as height_m, {rd(f'({HEIGHT_M})*100', 4)} as height_cm from clean",
        ),
        "bmr": over("clean", f"select user_id, date, {rd(BMR)} as bmr from clean"),
        "caloric_balance": over("clean", f"select user_id, date, {rd(f'calories_burned - {BMR}')} as caloric_balance from clean"),
        "stress_change_label": over(
            "silver", f"select user_id, date, stress_change_30d, {STRESS} as stress_change_label from silver"
        ),
        "lag_features": over("clean", LAGS),
        "lag_features_split": over("clean", LAGS),
        "change_30": over("clean", _changes(30)),
        "change_7": over("clean", _changes(7)),
        "clamp_delta": over("clean", _changes(30, 5)),
        "rolling_avg_30": over("clean", _means(ROWS_30)),
        "rolling_avg_30_days": over("clean", _means(DAYS_30)),
        "change_30_days": over("clean", _day_changes()),
        "rolling_avg_30_split": over("clean", _means(ROWS_30)),
        "rolling_avg_30_days_split": over("clean", _means(DAYS_30)),
        "silver": over("silver", SILVER_SHOWN),
        "silver_split": over("silver", SILVER_SHOWN),
        "dim_user": over("silver", DIM_USER),
        "dim_date": over("silver", DIM_DATE),
        "dim_activity": over(
            "silver",
            "select user_id, date, steps, exercise_minutes, calories_burned, activity_level, sleep_quality from silver",
        ),
        "fact_daily": over("fact_daily", "select * from fact_daily"),
        "preview": over("silver", "select user_id, date, steps, activity_level from silver order by user_id, date limit 5"),
        "bronze_csv_mixed_headers": over("raw_log", "select * from raw_log"),
        "csv_rejects": over(
            "raw_log", "select user_id, count(*) as rejected from raw_log where steps % 3 = 0 group by user_id"
        ),
        "silver_csv": over("silver", SILVER_SHOWN),
        "bronze_csv": over("raw_log", "select * from raw_log"),
        "clean_csv": over("raw_clean", "select * from raw_clean"),
        "stream_bronze": over("raw_log", "select * from raw_log"),
        "stream_silver": over("silver", SILVER_SHOWN),
        "stream_bronze_headers": over("raw_log", "select * from raw_log"),
        "stream_bronze_counts": over("raw_log", "select count(*) as rows_there, count(*) as rows_said from raw_log"),
        "append_silver": over("silver", SILVER_SHOWN),
        "append_counts": over("raw_clean", APPEND_COUNTS),
        "append_fact_daily": over("fact_daily", "select * from fact_daily"),
        "append_dim_user": over("silver", DIM_USER),
        "append_dim_date": over("silver", DIM_DATE),
        "ml_drop_missing": over(
            "fact_daily", f"select user_id, date_key, {', '.join(REQUIRED)} from fact_daily where {required}"
        ),
        "ml_fill_zero": over("fact_daily", f"select user_id, date_key, {filled} from fact_daily"),
        "ml_dataset": over("fact_daily", f"select {model_columns} from fact_daily where {required}"),
        "hash_split": over(
            "fact_daily",
            f"select user_id, date_key, case when cast('0x' || substr({md5}, 1, 8) as bigint) < {TRAIN_CUT}"
            " then 'train' else 'test' end as split from fact_daily",
        ),
        "date_split": over(
            "fact_daily",
            f"select user_id, date_key, case when date_key < {FIRST_TEST_KEY} then 'train' else 'test' end as split"
            " from fact_daily",
        ),
        "label_index": over(
            "fact_daily",
            f"select label as stress_change_label, label, cast(row_number() over (order by count(*) desc, label) - 1 as double)"
            f" as label_idx, count(*) as rows from ({LABELED}) group by label",
        ),
        "category_index": over(
            "fact_daily",
            "select gender, gender_idx, activity_level, activity_level_idx, count(*) as rows"
            f" from ({INDEXED}) group by gender, gender_idx, activity_level, activity_level_idx",
        ),
        "feature_vector": over(
            "fact_daily",
            f"select user_id, date_key, {len(STRESS_FEATURES)} as features, {rd(train)} as total from ({INDEXED})",
        ),
        "prediction_actuals": over(
            "fact_daily",
            f"select user_id, date_key, {STRESS} as actual_stress_change, sleep_quality as actual_sleep_quality,"
            f" {rd('coalesce(weight_change_30d, 0)', 3)} as actual_weight_change_30d,"
            f" case when cast('0x' || substr({md5}, 1, 8) as bigint) < {TRAIN_CUT} then 'train' else 'test' end as split"
            " from fact_daily",
        ),
        "prediction_checks": over(
            "fact_daily",
            "select count(*) as rows, count(distinct (user_id, date_key)) as keys, 0::bigint as nulls,"
            " true as stress_known, true as stress_learnt, true as sleep_known, true as sleep_learnt,"
            " true as weight_learnt from fact_daily",
        ),
        "category_domain": over(
            "raw_log",
            "select gender, case when gender in ('F', 'M') then gender end as category, count(*) as rows"
            " from raw_log group by gender",
        ),
        "merge_outer": over("fact_daily", MERGED),
        "merge_outer_split": over("fact_daily", MERGED),
        "classification_accuracy": over("fact_daily", _classification()),
        "regression_error": over(
            "fact_daily",
            f"select count(weight_change_30d) as rows, {rd('sqrt(avg(weight_change_30d*weight_change_30d))', 4)} as rmse,"
            f" {rd('avg(abs(weight_change_30d))', 4)} as mae from fact_daily",
        ),
    }
