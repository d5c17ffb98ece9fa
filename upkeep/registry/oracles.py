"""The same results as plain SQL over the same tables, for comparison."""

from __future__ import annotations

from upkeep.defaults import FEATURES, HORIZON_DAYS, SEED, SMALL_GRIDS
from upkeep.defaults import VERDICT_CLEAR as CLEAR
from upkeep.defaults import VERDICT_DUE as DUE

VERDICT_CLEAR, VERDICT_DUE = (text.format(days=HORIZON_DAYS) for text in (CLEAR, DUE))


def _round(expression: str, scale: int) -> str:
    """Rounding on the decimal text of a double, half away from zero."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,17)), {scale}) as double)"


def _bucket(salt: str, buckets: int) -> str:
    text = f"concat_ws('|', '{salt}', cast(date as varchar), cast(aircraftid as varchar))"
    return f"cast(cast('0x' || substr(md5({text}), 1, 8) as bigint) % {buckets} as integer)"


READINGS = """
readings as (
  select ts as date, event_type as series, value, user_id as aircraftid
  from events where event_type in ('view', 'click')),
"""
MEANS = """
means as (
  select cast(date as date) as date, aircraftid, avg(value) as sensor_mean_value
  from readings group by 1, 2),
"""
UTILIZATION = """
utilization as (
  select cast(ts as date) as timeid, user_id as aircraftid, sum(value) as flighthours,
         sum(case when event_type = 'purchase' then value else 0.0 end) as delayedminutes,
         count(*) as flightcycles
  from events group by 1, 2),
"""
QUALIFYING = """
qualifying as (
  select event_id % 16 as subsystem, user_id as aircraftregistration,
         cast(ts as date) as starttime, event_type as kind
  from events where event_id % 16 = 3 and event_type in ('error', 'signup')),
"""
JOINED = """
joined as (
  select m.date, m.aircraftid, m.sensor_mean_value, u.flighthours, u.delayedminutes, u.flightcycles
  from means m join utilization u on m.date = u.timeid and m.aircraftid = u.aircraftid),
"""
FEATURE_ROWS = f"""
features as (
  select date, aircraftid, {_round('sensor_mean_value', 2)} as sensor_mean_value,
         {_round('flighthours', 2)} as flighthours,
         {_round('delayedminutes', 2)} as delayedminutes, flightcycles
  from joined),
"""
MATRIX = """
matrix as (
  select f.*, cast(q.starttime is not null as int) as label
  from features f left join qualifying q
    on f.aircraftid = q.aircraftregistration
   and datediff('day', f.date, q.starttime) between 0 and 6),
"""
DEDUPED = """
deduped as (
  select f.*, cast(exists (
    select 1 from qualifying q where f.aircraftid = q.aircraftregistration
       and datediff('day', f.date, q.starttime) between 0 and 6) as int) as label
  from features f),
"""
REQUESTS = """
requests as (
  select distinct user_id as aircraftid, cast(ts as date) as date
  from events where event_type = 'signup'),
"""


def _with(*parts: str, select: str) -> str:
    return "with " + "".join(parts).strip().rstrip(",") + "\n" + select.strip()


_FEATURES = (READINGS, MEANS, UTILIZATION, JOINED, FEATURE_ROWS)
_MATRIX = (*_FEATURES, QUALIFYING, MATRIX)


def _supplier_matrix(horizon: int) -> str:
    return f"""
with joined as (
  select cast(l_shipdate as date) as date, l_suppkey as aircraftid, avg(l_quantity) as sensor_mean_value,
         sum(l_extendedprice) as flighthours,
         sum(case when l_returnflag = 'R' then l_extendedprice else 0.0 end) as delayedminutes,
         count(*) as flightcycles
  from lineitem group by 1, 2),
qualifying as (
  select l_suppkey as aircraftregistration, cast(l_shipdate as date) as starttime
  from lineitem where l_linenumber = 1 and l_returnflag = 'R')
select j.date, j.aircraftid, {_round('j.sensor_mean_value', 2)} as sensor_mean_value,
       {_round('j.flighthours', 2)} as flighthours, {_round('j.delayedminutes', 2)} as delayedminutes,
       j.flightcycles, cast(q.starttime is not null as int) as label
from joined j left join qualifying q on j.aircraftid = q.aircraftregistration
 and datediff('day', j.date, q.starttime) between 0 and {horizon - 1}"""


def _rules(source: str, name: str) -> str:
    return f"""
{name} as (
  select 0 as ordinal, 'Cycles' as Model, label, cast(flightcycles > 3 as int) as prediction from {source}
  union all
  select 1, 'Delay', label, cast(delayedminutes > 0 as int) from {source}
  union all
  select 2, 'Sensor', label, cast(sensor_mean_value > 50 as int) from {source}),
"""


def _f1(source: str, name: str, by: str) -> str:
    """Weighted F1 of ``source(by, label, prediction)``, from precision and recall."""
    keys = by.split(", ")
    same = " and ".join(f"c.{k} = r.{k}" for k in keys)
    return f"""
{name} as (
  select {by}, sum(support * case when hits = 0 then 0.0 else
           2 * (hits / predicted) * (hits / support) / (hits / predicted + hits / support) end)
         / sum(support) as f1
  from (
    select {', '.join('c.' + k for k in keys)}, c.label, cast(count(*) as double) as support,
           cast(sum(cast(r.label = r.prediction as int)) as double) as hits,
           cast((select count(*) from {source} p where p.prediction = c.label
                 and {' and '.join(f'p.{k} = c.{k}' for k in keys)}) as double) as predicted
    from (select distinct {by}, label from {source}) c
    join {source} r on {same} and c.label = r.label
    group by {', '.join('c.' + k for k in keys)}, c.label) classes
  group by {by}),
"""


_RULE_SCORES = f"""
scores as (select ordinal, Model, {_round('f1', 9)} as "F1-Score" from rule_f1),
"""
_RANKED = (*_MATRIX, _rules("matrix", "rules"), _f1("rules", "rule_f1", "ordinal, Model"), _RULE_SCORES)


def _bayes(train: str, prefix: str, smoothing: float = 1.0, by: str = "") -> str:
    """Parameters of multinomial naive Bayes fitted on the relation ``train``."""
    sums = ", ".join(f"sum({c}) as s_{c}" for c in FEATURES)
    total = " + ".join(f"s_{c}" for c in FEATURES)
    thetas = ", ".join(
        f"ln(s_{c} + {smoothing}) - ln({total} + {len(FEATURES) * smoothing}) as theta_{c}" for c in FEATURES
    )
    window = f"partition by {by}" if by else ""
    keep = f"{by}, " if by else ""
    return f"""
{prefix}_params as (
  select {keep}label, ln(n + {smoothing})
         - ln(sum(n) over ({window}) + count(*) over ({window}) * {smoothing}) as pi, {thetas}
  from (select {keep}label, cast(count(*) as double) as n, {sums} from {train} group by {keep}label) t),
"""


def _bayes_predict(rows: str, prefix: str, name: str, keep: str, on: str = "true") -> str:
    """The label with the highest log likelihood for each row; ``rows`` has a row number ``rid``."""
    dot = " + ".join(f"r.{c} * p.theta_{c}" for c in FEATURES)
    return f"""
{name} as (
  select {keep}, prediction from (
    select r.*, p.label as prediction,
           row_number() over (partition by r.rid order by p.pi + {dot} desc) as place
    from {rows} r join {prefix}_params p on {on}) scored
  where place = 1),
"""


def _numbered(source: str, name: str, where: str = "true") -> str:
    return f"""
{name} as (select *, row_number() over () as rid from {source} where {where}),
"""


#: Rows with their number among equal ones, and a bucket of all values and that number.
_COPIES = """
copies as (
  select *, row_number() over (partition by date, aircraftid, sensor_mean_value, flighthours,
         delayedminutes, flightcycles, label) as copy from matrix),
"""


def _row_bucket(salt: str, buckets: int) -> str:
    fractions = ", ".join(f"cast(cast({c} as decimal(38,6)) as varchar)" for c in FEATURES[:3])
    text = (
        f"concat_ws('|', '{salt}', cast(date as varchar), cast(aircraftid as varchar), {fractions}, "
        "cast(flightcycles as varchar), cast(label as varchar), cast(copy as varchar))"
    )
    return f"cast(cast('0x' || substr(md5({text}), 1, 8) as bigint) % {buckets} as integer)"


_MODELS = ", ".join(f"('{name}')" for name in SMALL_GRIDS)
_IN_TRAIN = f"{_bucket('split', 100)} < 70"
_TRAIN = f"""
train as (select * from matrix where {_IN_TRAIN}),
"""
_VALIDATION = _numbered("matrix", "validation", f"not ({_IN_TRAIN})")
_FITTED = (*_MATRIX, _TRAIN, _bayes("train", "nb"))
_COLUMNS = ", ".join(FEATURES)


def _days(part: str, horizon: int) -> str:
    """A part of a query with the default horizon, for another one."""
    return part.replace(f"between 0 and {HORIZON_DAYS - 1}", f"between 0 and {horizon - 1}")


def _scored(source: str, labels: int = HORIZON_DAYS, said: int = HORIZON_DAYS) -> str:
    """Predictions of naive Bayes trained on labels of one horizon, with verdicts that name another."""
    return _with(
        *[_days(part, labels) for part in _FITTED],
        REQUESTS,
        source,
        _bayes_predict("rows", "nb", "predicted", f"date, aircraftid, {_COLUMNS}"),
        select=f"""
select date, aircraftid, {_COLUMNS}, 'NaiveBayes' as model_name,
       cast(prediction as double) as prediction,
       case when prediction = 0 then '{CLEAR.format(days=said)}' else '{DUE.format(days=said)}' end as verdict
from predicted""",
    )


_REQUESTED = _numbered("features", "rows", "(date, aircraftid) in (select (date, aircraftid) from requests)")


def _cv() -> str:
    """Three folds by key and three smoothing values; every fold is predicted from the others."""
    parts = [*_MATRIX, _TRAIN, f"""
folded as (select *, {_bucket('fold', 3)} as fold from train),
others as (select h.fold as held, f.* from folded f join (select distinct fold from folded) h on f.fold <> h.fold),
""", _numbered("folded", "rows")]
    unions = []
    for point, smoothing in enumerate((0.0, 1.0, 2.0)):
        tag = f"nb{point}"
        parts.append(_bayes("others", tag, smoothing, by="held"))
        parts.append(_bayes_predict("rows", tag, f"{tag}_rows", "r_fold, label", "p.held = r.fold").replace(
            "select r.*", "select r.*, r.fold as r_fold"))
        parts.append(_f1(f"{tag}_rows", f"{tag}_f1", "r_fold"))
        unions.append(
            f"select 'Naive Bayes' as Model, {point} as point, '{{\"smoothing\":\"{smoothing}\"}}' as params, "
            f"{_round('avg(f1)', 9)} as mean_f1 from {tag}_f1"
        )
    return _with(*parts, select="\nunion all\n".join(unions))


def all_oracles() -> dict[str, str]:
    matrix = _with(*_MATRIX, select="select * from matrix")
    daily = _with(READINGS, select="select cast(date as date) as date, series, value, aircraftid from readings")
    scored = _scored(_REQUESTED)
    rounded = {c: _round(c, 9) for c in ("sensor_mean_value", "flighthours", "delayedminutes")}
    names = ("flightcycles", "delayedminutes", "flighthours", "sensor_mean_value", "label")
    validity = "\nunion all\n".join(
        f"""select '{c}' as column_name, count(*) as n_rows, count(*) filter (where {c} is null) as nulls,
  count(*) filter (where isnan(cast({c} as double))) as nans, count(*) filter (where {c} < 0) as negatives,
  {"count(*) filter (where label not in (0, 1))" if c == 'label' else 'cast(0 as bigint)'} as off_domain
from matrix"""
        for c in reversed(names)
    )
    validation_confusion = (
        *_FITTED,
        _VALIDATION,
        _bayes_predict("validation", "nb", "predicted", "'Naive Bayes' as Model, label"),
    )
    return {
        "scan_project": """select event_id % 16 as subsystem, user_id as aircraftregistration,
            ts as starttime, event_type as kind from events""",
        "daily_date": daily,
        "csv_scan_roundtrip": daily,
        "drop_project": _with(*_MATRIX, select=f"select {_COLUMNS}, label from matrix"),
        "filter_interruptions": _with(QUALIFYING, select="select * from qualifying"),
        "key_from_path": _with(
            READINGS,
            select="select lpad(cast(aircraftid as varchar), 20, '0') as aircraftid, count(*) as n from readings group by 1",
        ),
        "round_columns": _with(
            UTILIZATION,
            select=f"""select timeid, aircraftid, {_round('flighthours', 2)} as flighthours,
            {_round('delayedminutes', 2)} as delayedminutes, flightcycles from utilization""",
        ),
        "matrix_roundtrip": matrix,
        "daily_mean": _with(
            READINGS,
            MEANS,
            select=f"select date, aircraftid, {rounded['sensor_mean_value']} as sensor_mean_value from means",
        ),
        "sensor_util_join": _with(
            READINGS,
            MEANS,
            UTILIZATION,
            JOINED,
            select="select date, aircraftid, "
            + ", ".join(f"{e} as {c}" for c, e in rounded.items())
            + ", flightcycles from joined",
        ),
        "forward_label_matrix": matrix,
        "forward_label_matrix_expanded": matrix,
        "supplier_label_matrix": _supplier_matrix(7),
        "supplier_label_matrix_interval": _supplier_matrix(90),
        "supplier_label_matrix_interval_dedup": f"select distinct * from ({_supplier_matrix(90)})",
        "dedup_label_matrix": _with(*_FEATURES, QUALIFYING, DEDUPED, select="select * from deduped"),
        "lead_days": _with(
            *_FEATURES,
            QUALIFYING,
            select="""select cast(datediff('day', f.date, q.starttime) as int) as lead_days, count(*) as pairs
            from features f join qualifying q on f.aircraftid = q.aircraftregistration
             and datediff('day', f.date, q.starttime) between 0 and 6 group by 1""",
        ),
        "feature_validity": _with(*_MATRIX, select=validity),
        "point_lookup": _with(
            *_FEATURES, select="select * from features where date = date '2024-01-09' and aircraftid = 7"
        ),
        "request_features": _with(
            *_FEATURES,
            REQUESTS,
            select="select f.* from features f join requests r on f.date = r.date and f.aircraftid = r.aircraftid",
        ),
        "unmatched_requests": _with(
            *_FEATURES,
            REQUESTS,
            select="""select r.date, r.aircraftid from requests r where not exists (
            select 1 from features f where f.date = r.date and f.aircraftid = r.aircraftid)""",
        ),
        "verdict": _with(
            *_MATRIX,
            select=f"""select date, aircraftid, label,
            case when cast(flightcycles > 3 as int) = 0 then '{VERDICT_CLEAR}' else '{VERDICT_DUE}' end as verdict
            from matrix""",
        ),
        "verdict_horizon": _with(
            *_FEATURES,
            QUALIFYING,
            DEDUPED.replace("between 0 and 6", "between 0 and 29"),
            select=f"""select date, aircraftid, label, case when flightcycles <= 1 then null
            when flightcycles > 3 then '{DUE.format(days=30)}' else '{CLEAR.format(days=30)}' end as verdict from deduped""",
        ),
        "confusion_counts": _with(
            *_MATRIX,
            _rules("matrix", "rules"),
            select="""select Model, cast(label as double) as label, cast(prediction as double) as prediction,
            count(*) as n from rules group by 1, 2, 3""",
        ),
        "weighted_f1": _with(*_RANKED, select='select Model, "F1-Score" from scores'),
        "union_scores": _with(
            *_RANKED,
            DEDUPED,
            _rules("deduped", "once"),
            _f1("once", "once_f1", "ordinal, Model"),
            select=f"""select *, 'matrix' as source from scores
            union all select ordinal, Model, {_round('f1', 9)}, 'deduped' from once_f1""",
        ),
        "rank_scores": _with(*_RANKED, select='select * from scores order by "F1-Score" desc, ordinal'),
        "preview_scores": _with(*_RANKED, select='select * from scores order by "F1-Score" desc, ordinal limit 2'),
        "best_model_rule": _with(
            *_RANKED,
            select='select * from scores where "F1-Score" > 0 order by "F1-Score" desc, ordinal limit 1',
        ),
        "assemble_features": _with(
            *_MATRIX,
            select="select date, aircraftid, "
            + ", ".join(f"cast({c} as double) as feature_{i}" for i, c in enumerate(FEATURES))
            + ", label from matrix",
        ),
        "random_split_counts": _with(
            *_MATRIX,
            _COPIES,
            select=f"""select case when {_row_bucket(f'rows-{SEED}', 10_000)} < 7000 then 'train' else 'validation' end
            as part, label, count(*) as n from copies group by 1, 2""",
        ),
        "row_fold_counts": _with(
            *_MATRIX,
            _COPIES,
            select=f"select {_row_bucket(f'fold-{SEED}', 3)} as fold, label, count(*) as n from copies group by 1, 2",
        ),
        "hash_split_counts": _with(
            *_MATRIX,
            select=f"""select case when {_IN_TRAIN} then 'train' else 'validation' end as part, label,
            count(*) as n from matrix group by 1, 2""",
        ),
        "naive_bayes_params": _with(
            *_MATRIX,
            _bayes("matrix", "nb"),
            select=f"select label, {_round('pi', 9)} as pi, "
            + ", ".join(f"{_round('theta_' + c, 9)} as theta_{c}" for c in FEATURES)
            + " from nb_params",
        ),
        "clf_naive_bayes": _with(
            *validation_confusion,
            select="""select Model, cast(label as double) as label, cast(prediction as double) as prediction,
            count(*) as n from predicted group by 1, 2, 3""",
        ),
        **{
            key: _with(
                *_MATRIX,
                select=f"""select '{name}' as Model, label, count(*) filter ({_IN_TRAIN}) as train_rows,
                count(*) filter (not ({_IN_TRAIN})) as validation_rows,
                count(*) filter (not ({_IN_TRAIN})) as scored_rows, true as f1_equal, true as {'as_expression' if trees else 'optimal'}
                from matrix group by label""",
            )
            for key, name, trees in (
                ("clf_decision_tree", "Decision Tree", True),
                ("clf_random_forest", "Random Forest", True),
                ("clf_logistic", "Logistic Regression", False),
                ("clf_gbt", "Gradient-Boosted Trees", True),
                ("clf_linear_svc", "Linear SVC", False),
            )
        },
        "cv_scores": _cv(),
        "leaderboard_order": _with(
            *validation_confusion,
            _f1("predicted", "nb_f1", "Model"),
            select=f"""select Model, {_round('f1', 9)} as known_score, true as in_order
            from (values {_MODELS}) m(Model) left join nb_f1 using (Model)""",
        ),
        "tree_root_split": _with(
            *_MATRIX,
            """
values_ as (
  select cast(flightcycles as double) as value, count(*) filter (where not delayedminutes > 0) as zeros,
         count(*) filter (where delayedminutes > 0) as ones from matrix group by 1),
sums as (
  select (value + lead(value) over (order by value)) / 2 as threshold, sum(zeros) over (order by value) as left_0,
         sum(ones) over (order by value) as left_1, sum(zeros) over () as all_0, sum(ones) over () as all_1 from values_),
sides as (select *, all_0 - left_0 as right_0, all_1 - left_1 as right_1, left_0 + left_1 as l, all_0 + all_1 as n from sums),
gains as (
  select *, 1 - pow(all_0 / n, 2) - pow(all_1 / n, 2) - l / n * (1 - pow(left_0 / l, 2) - pow(left_1 / l, 2))
         - (n - l) / n * (1 - pow(right_0 / (n - l), 2) - pow(right_1 / (n - l), 2)) as gain
  from sides where threshold is not null),
""",
            select=f"""select threshold, {_round('gain', 9)} as gain, cast(left_0 as bigint) as left_0,
            cast(left_1 as bigint) as left_1, cast(right_0 as bigint) as right_0, cast(right_1 as bigint) as right_1,
            true as exact_agrees from gains order by gain desc, threshold limit 1""",
        ),
        **{key: _with(
            *_FITTED,
            """
broken as (
  select date, aircraftid, case when aircraftid % 7 <> 0 then sensor_mean_value end as sensor_mean_value,
         case when aircraftid % 5 = 0 then -1.0 - flighthours else flighthours end as flighthours,
         delayedminutes, flightcycles from features),
judged as (
  select *, case when sensor_mean_value is null then 'column sensor_mean_value is null'
                 when flighthours < 0 then 'column flighthours is negative' end as problem from broken),
""",
            _numbered("judged", "rows", "problem is null"),
            _bayes_predict("rows", "nb", "predicted", "date, aircraftid"),
            select="""select date, aircraftid, problem, null::double as prediction from judged where problem is not null
            union all select date, aircraftid, null, cast(prediction as double) from predicted""",
        ) for key in ("score_bad_rows", "score_stream_split")},
        "end_to_end_all": _with(
            *_FEATURES,
            REQUESTS,
            select="""select f.*, true as scored, true as verdict_agrees
            from features f join requests r on f.date = r.date and f.aircraftid = r.aircraftid""",
        ),
        "score_batch": scored,
        "end_to_end": scored,
        "end_to_end_horizon": _scored(_REQUESTED, 30, 30),
        "score_stream": _scored(_numbered("features", "rows")),
        "score_stream_horizon": _scored(_numbered("features", "rows"), said=30),
        "run_log": _with(
            *validation_confusion,
            _f1("predicted", "nb_f1", "Model"),
            select=f"""select 'Model Training Run' as run_name, Model as model,
            case when f1 is not null then '1.0' end as smoothing,
            case when f1 is not null then 'multinomial' end as model_type, 'F1-Score' as metric,
            {_round('f1', 9)} as value, true as model_kept
            from (values {_MODELS}) m(Model) left join nb_f1 using (Model)""",
        ),
    }
