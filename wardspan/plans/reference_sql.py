"""Plain SQL for the registered queries, written without the operators' own
tricks (no buckets, pieces, sketches or cells), to check them against."""

from __future__ import annotations

# Fixed values, written out here again so that a wrong one in the library shows.
TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "9-SCHEDULED")
ITEMS_F = (50912, 51222, 51002, 50813, 50862, 50983, 99991)
ITEMS_O = (50889, 51237, 50912, 51222, 50813, 99992, 99993)
HORIZONS = {"readmit_30d": 30, "readmit_1y": 365.24, "readmit_5y": 1826.2}
LAB_ITEMS = {
    50912: {"lab_creatinine_max": "max", "lab_creatinine_last": "last"},
    51222: {"lab_hemoglobin_max": "max", "lab_hemoglobin_last": "last"},
    51002: {"lab_troponin_i_max": "max"},
    50813: {"lab_lactate_max": "max", "lab_lactate_last": "last"},
    50862: {"lab_albumin_mean": "mean"},
    50983: {"lab_sodium_mean": "mean"},
    50889: {"lab_crp_max": "max"},
    51237: {"lab_inr_max": "max", "lab_inr_last": "last"},
    50910: {"lab_creatine_kinase_max": "max"},
}
LAB_COLUMNS = (
    "lab_creatinine_max", "lab_creatinine_last", "lab_hemoglobin_max", "lab_hemoglobin_last", "lab_inr_max",
    "lab_inr_last", "lab_creatine_kinase_max", "lab_lactate_max", "lab_lactate_last", "lab_albumin_mean",
    "lab_sodium_mean", "lab_crp_max",
)


def _md5(seed, *parts: str) -> str:
    return f"md5(concat_ws('|', '{seed}', " + ", ".join(f"cast({p} as varchar)" for p in parts) + "))"


def _uniform(seed, *parts: str) -> str:
    return f"((cast('0x' || substr({_md5(seed, *parts)}, 1, 8) as bigint) + 0.5) / 4294967296.0)"


def _normal(seed, *parts: str) -> str:
    radius, angle = _uniform(f"{seed}|r", *parts), _uniform(f"{seed}|a", *parts)
    return f"(sqrt(-2.0 * ln({radius})) * cos(2.0 * pi() * {angle}))"


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_TYPES = _list(TYPES)

_ADM = """adm as (
  select o_custkey as subject_id, o_orderkey as hadm_id, o_orderdate as admittime,
         o_orderdate + to_days(cast(o_orderkey % 40 as integer)) as dischtime,
         o_orderpriority as admission_type
  from orders)"""

_PRIOR = """prior as (
  select *, row_number() over (partition by subject_id order by admittime, hadm_id) - 1
            as prior_admissions
  from adm)"""

_GAP = f"""kept as (
  select *, lead(admittime) over (partition by subject_id order by admittime, hadm_id) as next_time
  from prior where admission_type in ({_TYPES})),
gap as (
  select *, cast(floor((epoch_us(next_time) - epoch_us(dischtime)) / 86400000000.0) as bigint)
            as gap_days
  from kept)"""

_LABELLED = f"""{_ADM}, {_PRIOR}, {_GAP},
labelled as (
  select *, cast(coalesce(gap_days <= 365, false) as bigint) as readmit from gap)"""

_PATIENTS = """patients as (
  select c_custkey as subject_id,
         case when c_acctbal >= 0 then 1992 + c_custkey % 7 end as anchor_year,
         case when c_acctbal >= 0 then 25 + c_custkey % 60 end as anchor_age
  from customer)"""


def _age(table: str) -> str:
    return f"cast(coalesce(anchor_age + year({table}.admittime) - anchor_year >= 65, false) as bigint)"


_ONE_HOT = ", ".join(
    f"cast(admission_type = '{t}' as bigint) as \"admission_type_{t}\"" for t in TYPES
)

_DX = """dx as (
  select l_orderkey as hadm_id, upper(p_brand) as icd_code
  from lineitem join part on l_partkey = p_partkey)"""

_COMORBIDITY = f"""{_DX},
code_map as (
  select 'BRAND#' || n as icd_code, 'G' || (n % 6) as comorbidity,
         (n % 6) * 2.0 - 3 as w_readmit, (n % 6) - 2.0 as w_mortality
  from range(1, 21) t(n)),
once as (
  select distinct hadm_id, comorbidity, w_readmit, w_mortality
  from dx left join code_map using (icd_code)),
scores as (
  select hadm_id, cast(coalesce(sum(w_readmit), 0) as double) as elix_readmit,
         cast(coalesce(sum(w_mortality), 0) as double) as elix_mortality,
         cast(max(cast(comorbidity is not null as integer)) as bigint) as has_chronic
  from once group by hadm_id)"""

_RX = """rx as (
  select l_orderkey as hadm_id, count(*) as num_prescriptions from lineitem group by l_orderkey)"""

_LABEVENTS = f"""labevents as (
  select l_orderkey as hadm_id,
         case when l_linestatus = 'F' then ([{_list(ITEMS_F)}])[l_linenumber]
              else ([{_list(ITEMS_O)}])[l_linenumber] end as itemid,
         case when l_quantity <= 45 then l_quantity end as valuenum,
         row(l_shipdate, l_partkey, l_suppkey, l_linenumber) as order_key
  from lineitem)"""

_LAB_AGGREGATE = {
    "max": "max(valuenum) filter (where itemid = {i})",
    "mean": "avg(valuenum) filter (where itemid = {i})",
    "last": "arg_max(valuenum, order_key) filter (where itemid = {i} and valuenum is not null)",
}
_ALL_LABS = [c for columns in LAB_ITEMS.values() for c in columns]
_LABS = (
    f"""{_LABEVENTS},
labs as (
  select hadm_id, """
    + ", ".join(
        f"cast({_LAB_AGGREGATE[kind].format(i=item)} as double) as {column}"
        for item, columns in LAB_ITEMS.items()
        for column, kind in columns.items()
    )
    + f"""
  from labevents where itemid in ({_list(LAB_ITEMS)}) group by hadm_id)"""
)


def _round(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


def _filled(columns, table: str) -> str:
    return ", ".join(
        f"round(coalesce({c}, (select coalesce(median({c}), 0.0) from {table})), 6) as {c}"
        for c in columns
    )


_FEATURE_TABLE = f"""
with {_LABELLED}, {_PATIENTS}, {_COMORBIDITY}, {_RX}, {_LABS},
wide as (
  select labelled.hadm_id, readmit,
         coalesce(elix_mortality, 0) as elix_mortality, coalesce(elix_readmit, 0) as elix_readmit,
         cast(prior_admissions as bigint) as prior_admissions,
         coalesce(num_prescriptions, 0) as num_prescriptions,
         coalesce(has_chronic, 0) as has_chronic,
         {_age('labelled')} as age_65_plus, {", ".join(LAB_COLUMNS)}, {_ONE_HOT}
  from labelled
  left join patients using (subject_id)
  left join scores on scores.hadm_id = labelled.hadm_id
  left join rx on rx.hadm_id = labelled.hadm_id
  left join labs on labs.hadm_id = labelled.hadm_id)
select hadm_id, readmit, elix_mortality, elix_readmit, prior_admissions, num_prescriptions,
       has_chronic, age_65_plus, {_filled(LAB_COLUMNS, 'wide')},
       {", ".join(f'"admission_type_{t}"' for t in TYPES)}
from wide"""


def _rank(seed, id_col: str, partition: str = "") -> str:
    by = f"partition by {partition} " if partition else ""
    return f"row_number() over ({by}order by {_md5(seed, id_col)}, {id_col})"


_SCORED = f"""{_LABELLED}, {_RX},
scored as (
  select labelled.hadm_id, readmit as label,
         cast(coalesce(num_prescriptions, 0) >= 4 as bigint) as prediction,
         coalesce(num_prescriptions, 0) / 20.0 as probability
  from labelled left join rx on rx.hadm_id = labelled.hadm_id)"""

_REPORT = f"""{_SCORED},
classes as (select label as c from scored union select prediction from scored),
counts as (
  select c, (select count(*) from scored where label = c and prediction = c) as tp,
         (select count(*) from scored where label = c) as support,
         (select count(*) from scored where prediction = c) as predicted
  from classes),
pr as (
  select *, case when predicted = 0 then 0.0 else tp / predicted end as p,
         case when support = 0 then 0.0 else tp / support end as r
  from counts),
prf as (select *, case when p + r = 0 then 0.0 else 2 * p * r / (p + r) end as f from pr),
report as (
  select cast(c as varchar) as name, p as precision, r as recall, f as f1, support from prf
  union all
  select 'accuracy', null, null, sum(tp) / sum(support), sum(support) from prf
  union all
  select 'macro avg', avg(p), avg(r), avg(f), sum(support) from prf
  union all
  select 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
         sum(f * support) / sum(support), sum(support) from prf)"""


def _smote(points: str, distance: str, id_col: str) -> str:
    """``points`` defines table pts(cls, id, ...); yields ``made`` with seed
    row s, neighbour row t, copy and u."""
    return f"""{points},
sizes as (select cls, count(*) as n from pts group by cls),
pairs as (
  select a.cls, a.id, b.id as nn_id,
         row_number() over (partition by a.cls, a.id order by round({distance}, 9), b.id) as r
  from pts a join pts b on a.cls = b.cls and a.id <> b.id
  join sizes on sizes.cls = a.cls
  where sizes.n < (select max(n) from sizes)),
near as (
  select cls, id, list(nn_id order by r) as nn from pairs where r <= 5 group by cls, id),
ranked as (
  select near.*, n, (select max(n) from sizes) - n as lacking,
         {_rank('42|order', 'id', 'near.cls')} as r
  from near join sizes on sizes.cls = near.cls),
unfolded as (
  select *, unnest(range(1, cast(lacking // n + cast(r <= lacking % n as bigint) + 1 as bigint)))
            as copy
  from ranked),
made as (
  select u.cls, u.id as seed_id, u.copy,
         nn[1 + cast(floor({_uniform('42|nn', 'u.id', 'u.copy')} * len(nn)) as bigint)]
           as neighbour_id,
         {_uniform('42|u', 'u.id', 'u.copy')} as u
  from unfolded u)"""


_PERMUTED = ("prior_admissions", "num_prescriptions", "age_65_plus")


def _accuracy(label: str, prediction: str) -> str:
    return f"avg(cast({label} = {prediction} as integer))"


def _weighted_f1(label: str, prediction: str) -> str:
    """Sum over the two classes of support * 2 tp / (support + predicted)."""

    def part(c):
        hit = f"count(*) filter (where {label} = {c} and {prediction} = {c})"
        support = f"count(*) filter (where {label} = {c})"
        predicted = f"count(*) filter (where {prediction} = {c})"
        return f"{support} * 2.0 * {hit} / greatest({support} + {predicted}, 1)"

    return f"(({part(0)} + {part(1)}) / count(*))"


def _importance(metric, n_repeats: int) -> str:
    def rule(changed: str) -> str:
        def value(f):
            return ("d." if f == changed else "b.") + f

        return (
            f"cast({value('prior_admissions')} <= 5 or {value('num_prescriptions')} >= 6 as integer)"
        )

    repeats = " union all ".join(
        f"select {r} as repeat, hadm_id, {_rank(f'42|{r}', 'hadm_id')} as rank, "
        f"{', '.join(_PERMUTED)} from rows_"
        for r in range(n_repeats)
    )
    drops = " union all ".join(
        f"select '{f}' as feature, d.repeat, "
        f"{metric('b.readmit', rule(''))} - {metric('b.readmit', rule(f))}"
        f" as dropped from base b join donors d on b.rank = d.rank group by d.repeat"
        for f in _PERMUTED
    )
    return f"""
with {_LABELLED}, {_PATIENTS}, {_RX},
rows_ as (
  select labelled.hadm_id, readmit, prior_admissions,
         coalesce(num_prescriptions, 0) as num_prescriptions, {_age('labelled')} as age_65_plus
  from labelled left join patients using (subject_id)
  left join rx on rx.hadm_id = labelled.hadm_id),
base as (select *, {_rank('42|rows', 'hadm_id')} as rank from rows_),
donors as ({repeats}),
drops as ({drops})
select feature, round(avg(dropped), 6) as importance_mean,
       round(stddev_pop(dropped), 6) as importance_std
from drops group by feature"""


def _stability() -> str:
    def probability(price: str, days: str) -> str:
        return f"(1.0 / (1.0 + exp(-({price} / 100000 - {days} / 500))))"

    price = f"(o_totalprice + level * sd_price * {_normal(42, 'o_orderkey', chr(39) + 'o_totalprice' + chr(39))})"
    days = f"(age_days + level * sd_days * {_normal(42, 'o_orderkey', chr(39) + 'age_days' + chr(39))})"
    return f"""
with base as (
  select o_orderkey, o_totalprice,
         cast(date_diff('day', date '1992-01-01', cast(o_orderdate as date)) as double) as age_days
  from orders),
sd as (select stddev_samp(o_totalprice) as sd_price, stddev_samp(age_days) as sd_days from base),
moved as (
  select level, sd_price, sd_days, o_totalprice, age_days, {price} as price, {days} as days
  from base, sd, (values (0.1::double), (0.5::double), (1.0::double)) l(level)),
scored as (
  select *, {probability('o_totalprice', 'age_days')} as p0, {probability('price', 'days')} as p1,
         (abs(price - o_totalprice) / sd_price + abs(days - age_days) / sd_days) / 2 as shift
  from moved)
select level, round(avg(cast((p0 > 0.5) <> (p1 > 0.5) as integer)), 6) as flip_rate,
       round(avg(abs(p1 - p0)), 6) as probability_change, round(avg(shift), 6) as input_change,
       round(avg(abs(p1 - p0)) / avg(shift), 6) as sensitivity
from scored group by level"""


_FLAGS = ("has_chronic", "age_65_plus", *(f"admission_type_{t}" for t in TYPES), "many_priors", "many_prescriptions")
_VALUES = f"""flagged as (
  select labelled.hadm_id, readmit, [
      coalesce(has_chronic, 0), {_age('labelled')},
      {", ".join(f"cast(admission_type = '{t}' as bigint)" for t in TYPES)},
      cast(prior_admissions > 5 as bigint), cast(coalesce(num_prescriptions, 0) >= 4 as bigint)]::double[] as v
  from labelled
  left join patients using (subject_id)
  left join scores on scores.hadm_id = labelled.hadm_id
  left join rx on rx.hadm_id = labelled.hadm_id)"""
_STUDY = f"""{_LABELLED}, {_PATIENTS}, {_COMORBIDITY}, {_RX}, {_VALUES},
split as (
  select *, r <= ceil(0.2 * n) as is_test
  from (select *, {_rank(42, 'hadm_id', 'readmit')} as r, count(*) over (partition by readmit) as n from flagged)),
even as (
  select hadm_id from (
    select hadm_id, {_rank(42, 'hadm_id', 'readmit')} as r from split where not is_test)
  where r <= (select min(n) from (select count(*) as n from split where not is_test group by readmit)))"""


def _stump(name: str, train: str, groups: str = "") -> str:
    """CTEs: the split with the largest Gini gain over ``train`` (readmit, v), and the share of 1 in its leaves."""
    by = f"{groups}, " if groups else ""
    window = f"partition by {groups} " if groups else ""
    return f"""{name}_cells as (
  select {by}feature, x, count(*) as n, sum(readmit) as pos
  from (select {by}readmit, unnest(range(1, len(v) + 1)) as feature, unnest(v) as x from {train}) group by all),
{name}_best as (
  select {by}feature from {name}_cells group by {by}feature having count(*) = 2
  qualify row_number() over ({window}order by
    round(sum(n * (1 - (pos / n) * (pos / n) - (1 - pos / n) * (1 - pos / n))) / sum(n), 12), feature) = 1),
{name}_leaf as (select {by}feature, x, pos / n as share from {name}_cells join {name}_best using ({by}feature))"""


def _f1(rows: str, groups: str = "") -> str:
    """Weighted F1 of ``rows`` (readmit, p)."""
    by = f" group by {groups}" if groups else ""
    return f"select {groups + ', ' if groups else ''}{_weighted_f1('readmit', 'p')} as f1 from {rows}{by}"


def _forest_importance() -> str:
    repeats = " union all ".join(
        f"select {r} as repeat, {_rank(f'42|{r}', 'hadm_id')} as rank, x from tested" for r in range(5)
    )
    return f"""
with {_STUDY}, train as (select readmit, v from split join even using (hadm_id)), {_stump('one', 'train')},
tested as (select hadm_id, readmit, v[feature] as x from split, one_best where is_test),
base as (select *, {_rank('42|rows', 'hadm_id')} as rank from tested),
donors as ({repeats}),
drops as (
  select repeat, {_accuracy('readmit', 'cast(a.share > 0.5 as bigint)')}
    - {_accuracy('readmit', 'cast(b.share > 0.5 as bigint)')} as dropped
  from base join donors using (rank) join one_leaf a on a.x = base.x join one_leaf b on b.x = donors.x
  group by repeat),
names(place, feature) as (values {", ".join(f"({i + 1}, '{f}')" for i, f in enumerate(_FLAGS))})
select names.feature, case when one_best.feature is null then 0.0 else round(avg(dropped), 6) end as importance_mean,
       case when one_best.feature is null then 0.0 else round(stddev_pop(dropped), 6) end as importance_std
from names left join one_best on one_best.feature = place, drops group by names.feature, one_best.feature"""


_HOLES = ", ".join(
    f"case when {_uniform(42, 'hadm_id', chr(39) + f + chr(39))} >= 0.3 then v[{i + 1}] end" for i, f in enumerate(_FLAGS)
)
_MIDDLE = ", ".join(f"(select coalesce(median(h[{i + 1}]), 0.0) from holed where not is_test)" for i in range(len(_FLAGS)))


def _named_report(name: str) -> str:
    """The CTEs of a report on ``<name>_scored``, all named after it."""
    report = _REPORT.removeprefix(f"{_SCORED},").replace("scored", f"{name}_scored")
    for cte in ("classes", "counts", "prf", "report"):
        report = report.replace(f"{cte} as", f"{name}_{cte} as").replace(f"from {cte}", f"from {name}_{cte}")
    return report.replace("pr as (", f"{name}_pr as (").replace("from pr)", f"from {name}_pr)")


def _horizon_study() -> str:
    """Per horizon, the stump on the undersampled training rows of one split, and its report on the test rows."""
    labels = ", ".join(f"cast(coalesce(gap_days <= {days}, false) as bigint) as {name}" for name, days in HORIZONS.items())
    both = f"concat_ws(',', {', '.join(HORIZONS)})"
    parts, reports = [], []
    for name in HORIZONS:
        parts.append(f"""{name}_even as (
  select hadm_id from (select hadm_id, {_rank(42, 'hadm_id', name)} as r from split where not is_test)
  where r <= (select min(n) from (select count(*) as n from split where not is_test group by {name}))),
{name}_train as (select {name} as readmit, v from split join {name}_even using (hadm_id)), {_stump(name, f'{name}_train')},
{name}_scored as (
  select {name} as label, cast(share > 0.5 as bigint) as prediction from split, {name}_leaf where is_test and v[feature] = x)""")
        parts.append(_named_report(name))
        reports.append(f"""select '{name}' as horizon, name, round(precision, 6) as precision,
       round(recall, 6) as recall, round(f1, 6) as f1, cast(support as bigint) as support from {name}_report""")
    return f"""
with {_LABELLED}, {_PATIENTS}, {_COMORBIDITY}, {_RX}, {_VALUES.replace("readmit,", f"{labels},", 1)},
split as (
  select *, r <= ceil(0.2 * n) as is_test
  from (select *, {_rank(42, 'hadm_id', both)} as r, count(*) over (partition by {both}) as n from flagged)),
{", ".join(parts)}
{" union all ".join(reports)}"""


def _variants() -> str:
    """Reports of the stump on clean rows, rows with gaps (read as 0), and gaps filled by medians of training rows."""
    holes = ", ".join(
        f"case when {_uniform(42, 'hadm_id', chr(39) + f + chr(39))} >= 0.3 then v[{i + 1}] end"
        for i, f in enumerate(_FLAGS)
    )
    middle = ", ".join(f"(select coalesce(median(h[{i + 1}]), 0.0) from holed where not is_test)" for i in range(len(_FLAGS)))
    parts, reports = [], []
    for name, values in (
        ("clean", "v"),
        ("noisy", "list_transform(h, lambda x: coalesce(x, 0.0))"),
        ("cleaned", "list_transform(range(1, len(h) + 1), lambda i: coalesce(h[i], m[i]))"),
    ):
        parts.append(f"""{name}_rows as (select hadm_id, readmit, is_test, {values} as v from holed, medians),
{name}_train as (select readmit, v from {name}_rows join even using (hadm_id)), {_stump(name, f'{name}_train')},
{name}_scored as (
  select readmit as label, cast(share > 0.5 as bigint) as prediction
  from {name}_rows, {name}_leaf where is_test and v[feature] = x)""")
        report = _REPORT.removeprefix(f"{_SCORED},").replace("scored", f"{name}_scored")
        for cte in ("classes", "counts", "prf", "report"):
            report = report.replace(f"{cte} as", f"{name}_{cte} as").replace(f"from {cte}", f"from {name}_{cte}")
        parts.append(report.replace("pr as (", f"{name}_pr as (").replace("from pr)", f"from {name}_pr)"))
        reports.append(f"""select '{name}' as variant, name, round(precision, 6) as precision,
       round(recall, 6) as recall, round(f1, 6) as f1, cast(support as bigint) as support from {name}_report""")
    return f"""
with {_STUDY},
holed as (select *, [{holes}] as h from split),
medians as (select [{middle}] as m),
{", ".join(parts)}
{" union all ".join(reports)}"""


SQL: dict[str, str] = {
    "csv_scan": f"""
with {_ADM}
select hadm_id, subject_id, admission_type, cast(admittime as varchar) as admittime,
       cast(dischtime as varchar) as dischtime
from adm""",
    "hospital_scan": f"""
with {_ADM}, {_PATIENTS}, {_DX}, {_LABEVENTS},
held(table_name, id, value) as (
  select 'admissions', hadm_id, cast(subject_id as double) from adm
  union all select 'patients', subject_id, anchor_age from patients
  union all select 'diagnoses_icd', hadm_id, length(icd_code) + 1 from dx
  union all select 'prescriptions', l_orderkey, case when l_orderkey % 97 <> 0 then l_orderkey end from lineitem
  union all select 'labevents', hadm_id, case when hadm_id % 89 <> 0 then valuenum end from labevents)
select table_name, count(*) as n, count(*) filter (where id % 97 <> 0) as n_ids,
       cast(sum(id) filter (where id % 97 <> 0) as bigint) as sum_ids, count(value) as n_values,
       round(sum(value), 2) as sum_values
from held group by table_name""",
    "scan_rejects": f"""
with {_ADM}, {_PATIENTS}, {_DX}, {_LABEVENTS},
keys(table_name, key_name, id) as (
  select 'admissions', 'hadm_id', hadm_id from adm
  union all select 'patients', 'subject_id', subject_id from patients
  union all select 'diagnoses_icd', 'hadm_id', hadm_id from dx
  union all select 'prescriptions', 'hadm_id', l_orderkey from lineitem
  union all select 'labevents', 'hadm_id', hadm_id from labevents),
cols(table_name, column_name) as (values
  ('admissions', 'subject_id'), ('admissions', 'hadm_id'), ('admissions', 'admittime'), ('admissions', 'dischtime'),
  ('admissions', 'admission_type'), ('patients', 'subject_id'), ('patients', 'anchor_year'), ('patients', 'anchor_age'),
  ('diagnoses_icd', 'hadm_id'), ('diagnoses_icd', 'icd_code'), ('prescriptions', 'hadm_id'), ('labevents', 'labevent_id'),
  ('labevents', 'hadm_id'), ('labevents', 'itemid'), ('labevents', 'valuenum'))
select table_name, column_name, count(*) as n_rows,
       count(*) filter (where column_name = key_name and id % 97 = 0) as n_unreadable,
       count(*) filter (where column_name = key_name and id % 97 = 0) as n_rejected
from cols join keys using (table_name) group by table_name, column_name""",
    "stage_reuse": f"with {_RX} select hadm_id, num_prescriptions from rx",
    "prior_admissions": f"""
with {_ADM}, {_PRIOR}
select hadm_id, subject_id, cast(prior_admissions as bigint) as prior_admissions from prior""",
    "admission_type_filter": f"""
with {_ADM} select hadm_id, subject_id, admission_type from adm where admission_type in ({_TYPES})""",
    "readmit_label": f"""
with {_LABELLED} select hadm_id, cast(gap_days as double) as gap_days, readmit from labelled""",
    "readmit_horizons": f"""
with {_LABELLED}
select hadm_id, {", ".join(
    f"cast(coalesce(gap_days <= {days}, false) as bigint) as {name}"
    for name, days in HORIZONS.items())}
from labelled""",
    "readmit_label_bounded": f"""
with {_LABELLED}
select hadm_id, cast(coalesce(gap_days between 0 and 365, false) as bigint) as readmit,
       cast(next_time is null as bigint) as censored
from labelled""",
    "age_flag": f"""
with {_ADM}, {_PATIENTS}
select hadm_id, {_age('adm')} as age_65_plus from adm left join patients using (subject_id)""",
    "one_hot": f"""
with {_ADM} select hadm_id, {_ONE_HOT} from adm where admission_type in ({_TYPES})""",
    "one_hot_discovered": f"""
with {_ADM}
select hadm_id, {", ".join(
    f"cast(admission_type = '{t}' as bigint) as \"admission_type_{t}\""
    for t in (*TYPES[:4], '5-LOW'))}
from adm""",
    "code_normalise": f"with {_DX} select hadm_id, icd_code from dx",
    "comorbidity_score": f"""
with {_COMORBIDITY} select hadm_id, elix_readmit, elix_mortality, has_chronic from scores""",
    "comorbidity_by_function": f"""
with {_COMORBIDITY} select hadm_id, elix_readmit, elix_mortality, has_chronic from scores""",
    "prescription_counts": f"with {_RX} select hadm_id, num_prescriptions from rx",
    "lab_features": f"with {_LABS} select hadm_id, {_round(_ALL_LABS)} from labs",
    "lab_align": f"""
with {_LABS} select hadm_id, {_round(_ALL_LABS)} from labs""",
    "median_impute": f"with {_LABS} select hadm_id, {_filled(_ALL_LABS, 'labs')} from labs",
    "lab_medians": f"""
with {_LABS}
select {", ".join(f"round(coalesce(median({c}), 0.0), 6) as {c}" for c in _ALL_LABS)} from labs""",
    "median_fill_applied": f"""
with {_LABELLED}, {_LABS},
split as (
  select hadm_id, r <= ceil(0.2 * n) as is_test
  from (select hadm_id, {_rank(42, 'hadm_id', 'readmit')} as r, count(*) over (partition by readmit) as n from labelled)),
both_ as (select split.hadm_id, is_test, {", ".join(_ALL_LABS)} from split left join labs on labs.hadm_id = split.hadm_id),
medians as (select {", ".join(f"coalesce(median({c}), 0.0) as m_{c}" for c in _ALL_LABS)} from both_ where not is_test)
select hadm_id, {", ".join(f"round(coalesce({c}, m_{c}), 6) as {c}" for c in _ALL_LABS)}
from both_, medians where is_test""",
    "feature_table": _FEATURE_TABLE,
    "feature_table_bucketed": _FEATURE_TABLE,
    "feature_table_reduced": _FEATURE_TABLE,
    "stratified_split": f"""
with {_LABELLED},
ranked as (
  select hadm_id, readmit, {_rank(42, 'hadm_id', 'readmit')} as r,
         count(*) over (partition by readmit) as n
  from labelled)
select hadm_id, readmit, cast(r <= ceil(0.2 * n) as bigint) as is_test from ranked""",
    "kfold_assign": f"""
with {_LABELLED}
select hadm_id, cast(({_rank(42, 'hadm_id')} - 1) % 10 as bigint) as plain_fold,
       cast(({_rank(42, 'hadm_id', 'readmit')} - 1) % 10 as bigint) as fold
from labelled""",
    "undersample": f"""
with {_LABELLED},
ranked as (select hadm_id, readmit, {_rank(42, 'hadm_id', 'readmit')} as r from labelled)
select hadm_id, readmit from ranked
where r <= (select min(n) from (select count(*) as n from labelled group by readmit))""",
    "noise_inject": f"""
select o_orderkey, round(o_totalprice + 0.5 * (select stddev_samp(o_totalprice) from orders)
       * {_normal(42, 'o_orderkey', "'o_totalprice'")}, 2) as o_totalprice
from orders""",
    "missing_inject": f"""
select o_orderkey,
       case when {_uniform(42, 'o_orderkey', "'o_totalprice'")} >= 0.1 then o_totalprice end
         as o_totalprice,
       case when {_uniform(42, 'o_orderkey', "'o_orderpriority'")} >= 0.1 then o_orderpriority end
         as o_orderpriority
from orders""",
    "clean_ranges": """
with firsts as (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate, l_partkey, l_suppkey) as r
  from lineitem),
ruled as (
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey,
         case when l_quantity between 5.0 and 45.0 then l_quantity end as l_quantity,
         case when l_discount between 0.01 and 0.09 then l_discount end as l_discount
  from firsts where r = 1)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(coalesce(l_quantity, (select median(l_quantity) from ruled)), 6) as l_quantity,
       round(coalesce(l_discount, (select median(l_discount) from ruled)), 6) as l_discount
from ruled""",
    "quality_profile": f"""
with {_LABEVENTS}
select 'valuenum' as column_name, 'missing' as metric,
       round(avg(cast(valuenum is null as integer)), 6) as share from labevents
union all
select 'valuenum', 'out_of_range',
       round(avg(cast(coalesce(valuenum not between 5.0 and 40.0, false) as integer)), 6) from labevents
union all
select 'itemid', 'missing', round(avg(cast(itemid is null as integer)), 6) from labevents
union all
select 'itemid', 'out_of_range',
       round(avg(cast(itemid not between 50000 and 60000 as integer)), 6) from labevents
union all
select 'hadm_id', 'duplicated',
       round((count(hadm_id) - count(distinct hadm_id)) / count(*), 6) from labevents""",
    "smote": f"""
with {_smote(
    "pts as (select label as cls, vec_id as id, cast(embedding as double[]) as v from embeddings)",
    "list_distance(a.v, b.v)", "vec_id")},
moved as (
  select made.*, list_transform(range(1, len(s.v) + 1), lambda i: s.v[i] + u * (t.v[i] - s.v[i])) as v
  from made join pts s on s.id = seed_id join pts t on t.id = neighbour_id)
select cast(cls as bigint) as label, seed_id, copy, neighbour_id,
       round(list_sum(v), 6) as vec_sum, round(v[1], 6) as vec_first
from moved""",
    "smote_rows": f"""
with {_LABELLED}, {_RX},
{_smote(
    '''pts as (
  select readmit as cls, labelled.hadm_id as id, cast(num_prescriptions as double) as x,
         o_totalprice / 10000.0 as y, o_totalprice
  from labelled join rx on rx.hadm_id = labelled.hadm_id
  join orders on o_orderkey = labelled.hadm_id)''',
    "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))", "hadm_id")}
select id as hadm_id, 0 as copy, cls as readmit, round(x, 6) as num_prescriptions,
       round(o_totalprice, 6) as o_totalprice
from pts
union all
select seed_id, copy, made.cls, round(s.x + u * (t.x - s.x)),
       round((s.y + u * (t.y - s.y)) * 10000.0, 6)
from made join pts s on s.id = seed_id join pts t on t.id = neighbour_id""",
    "rf_predict_exact": f"""
with {_STUDY}, train as (select readmit, v from split join even using (hadm_id)), {_stump('one', 'train')}
select hadm_id, cast(share > 0.5 as bigint) as prediction, round(share, 6) as probability
from split, one_leaf where is_test and v[feature] = x""",
    "pipeline_saved_exact": f"""
with {_STUDY},
holed as (select *, [{_HOLES}] as h from split),
medians as (select [{_MIDDLE}] as m),
filled as (
  select hadm_id, readmit, is_test, list_transform(range(1, len(h) + 1), lambda i: coalesce(h[i], m[i])) as v
  from holed, medians),
train as (select readmit, v from filled join even using (hadm_id)), {_stump('one', 'train')}
select hadm_id, cast(share > 0.5 as bigint) as prediction, round(share, 6) as probability
from filled, one_leaf where is_test and v[feature] = x""",
    "horizon_study_exact": _horizon_study(),
    "forest_importance_exact": _forest_importance(),
    "cv_tune_exact": f"""
with {_LABELLED}, {_PATIENTS}, {_COMORBIDITY}, {_RX}, {_VALUES},
even as (
  select * from (select *, {_rank(42, 'hadm_id', 'readmit')} as r from flagged)
  where r <= (select min(n) from (select count(*) as n from flagged group by readmit))),
folded as (select *, ({_rank(42, 'hadm_id')} - 1) % 10 as fold from even),
folds as (select distinct fold from folded),
train as (select folds.fold, readmit, v from folded join folds on folded.fold <> folds.fold),
{_stump('one', 'train', 'fold')},
split_rows as (
  select fold, readmit, cast(share > 0.5 as bigint) as p from folded join one_leaf using (fold) where v[feature] = x),
whole as (select fold, cast(avg(readmit) > 0.5 as bigint) as p from train group by fold),
whole_rows as (select fold, readmit, p from folded join whole using (fold)),
scores_ as (
  select 0 as trial, avg(f1) as f1 from ({_f1('split_rows', 'fold')})
  union all select 1, avg(f1) from ({_f1('whole_rows', 'fold')}))
select cast(trial as bigint) as trial, round(f1, 6) as weighted_f1,
       cast(f1 = (select max(f1) from scores_) as bigint) as is_best
from scores_""",
    "quality_compare_exact": _variants(),
    "confusion_matrix_absent": f"""
with {_SCORED}
select c as label, count(*) filter (where label = c and prediction = 0) as predicted_0,
       count(*) filter (where label = c and prediction = 1) as predicted_1,
       count(*) filter (where label = c and prediction = 2) as predicted_2
from scored, (values (0::bigint), (1), (2)) classes(c) group by c""",
    "clean_null_keys": """
with given as (
  select case when o_custkey % 5 <> 0 then o_custkey end as o_custkey, o_orderpriority, o_orderkey from orders)
select o_custkey, o_orderpriority, min(o_orderkey) as o_orderkey from given
where o_custkey is not null group by o_custkey, o_orderpriority
union all
select o_custkey, o_orderpriority, o_orderkey from given where o_custkey is null""",
    "quality_profile_keys": """
select 'l_quantity' as column_name, 'missing' as metric,
       round(avg(cast(l_quantity is null as integer)), 6) as share from lineitem
union all
select 'l_quantity', 'out_of_range', round(avg(cast(l_quantity not between 5 and 45 as integer)), 6) from lineitem
union all
select 'l_orderkey+l_suppkey', 'duplicated',
       round((count(*) - count(distinct (l_orderkey, l_suppkey))) / count(*), 6) from lineitem""",
    "confusion_matrix": f"""
with {_SCORED}
select label, count(*) filter (where prediction = 0) as predicted_0,
       count(*) filter (where prediction = 1) as predicted_1
from scored group by label""",
    "classification_report": f"""
with {_REPORT}
select name, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support
from report""",
    "weighted_f1": f"""
with {_REPORT} select round(f1, 6) as weighted_f1 from report where name = 'weighted avg'""",
    "regression_metrics": """
with pairs as (select l_extendedprice as y, l_quantity * 1500 as p from lineitem)
select count(*) as n, round(avg((y - p) * (y - p)), 2) as mse, round(avg(abs(y - p)), 2) as mae,
       round(1.0 - avg((y - p) * (y - p)) / var_pop(y), 4) as r2
from pairs""",
    "roc_auc": f"""
with {_SCORED},
by_score as (
  select probability, sum(label) as pos, count(*) - sum(label) as neg from scored group by 1),
ordered as (
  select *, coalesce(sum(neg) over (order by probability rows between unbounded preceding
                                    and 1 preceding), 0) as below
  from by_score)
select round(cast(sum(pos * (below + neg / 2)) as double) / (sum(pos) * sum(neg)), 6) as roc_auc
from ordered""",
    "permutation_importance": _importance(_accuracy, 5),
    "permutation_importance_f1": _importance(_weighted_f1, 5),
    "stability": _stability(),
}
