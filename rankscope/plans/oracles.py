"""Standard SQL for the registered queries, written against the same tables.

Used only to check results: fitted models and sketches have no entry.
"""

from __future__ import annotations

def _history(scores: str, previous: str, periods: str, streak: str, name: str) -> str:
    """Common table expressions up to ``<name>_hist``: ranks and history of ``scores``."""
    window = "partition by pais, key order by fecha"
    so_far = f"{window} rows between unbounded preceding and current row"
    return f"""
{name}_scores as ({scores}),
{name}_ranked as (
  select fecha, pais, key, rank from (
    select fecha, pais, key,
           row_number() over (partition by fecha, pais order by score desc, key) as rank
    from {name}_scores) s),
{name}_dated as (
  select fecha, pais, key, rank,
         row_number() over ({window}) as {periods},
         min(rank) over ({so_far}) as peak_rank,
         lag(fecha) over ({window}) as last_date,
         lag(rank) over ({window}) as last_rank,
         first_value(rank) over ({so_far}) as entry_rank,
         first_value(fecha) over ({so_far}) as entry_date
  from {name}_ranked),
{name}_linked as (
  select *, coalesce(last_date = {previous}, false) as adjacent from {name}_dated),
{name}_hist as (
  select fecha, pais, key, rank, {periods}, peak_rank, entry_rank, entry_date,
         case when adjacent then last_rank end as previous_rank,
         case when last_date is null then 'NEW_ENTRY'
              when not adjacent then 'RE_ENTRY'
              when rank < last_rank then 'MOVED_UP'
              when rank > last_rank then 'MOVED_DOWN'
              else 'NO_CHANGE' end as entry_status,
         {periods} - max(case when not adjacent then {periods} end) over ({so_far}) + 1 as {streak}
  from {name}_linked)"""


DAILY = _history(
    """select cast(ts as date) as fecha, event_type as pais, user_id as key,
              cast(sum(cast(round(value * 100) as bigint)) as bigint) as score
       from events group by 1, 2, 3""",
    "cast(fecha - interval 1 day as date)",
    "days_on_chart",
    "consecutive_days",
    "d",
) + """,
daily as (
  select fecha, pais, rank, 'artist:' || key as artist_uri, 'Artist ' || key as artist_name,
         peak_rank, previous_rank, days_on_chart, consecutive_days, entry_status, entry_rank,
         entry_date, key
  from d_hist)"""

DAILY_RAW = DAILY + """,
daily_raw as (
  select case when key % 13 = 1 then '2023-02-30' when key % 13 = 2 then '2023'
              else cast(fecha as varchar) end as date,
         pais as country,
         case when key % 11 = 1 then 'x' when key % 11 = 2 then '99999999999'
              when key % 11 = 3 then ' 12' else cast(rank as varchar) end as rank,
         artist_uri as uri, artist_name, peak_rank, previous_rank,
         case when key % 17 = 1 then '' when key % 17 = 2 then '7.0'
              else cast(days_on_chart as varchar) end as days_on_chart,
         consecutive_days, entry_status, entry_rank, entry_date
  from daily),
artists as (
  select case when regexp_matches(date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
              then try_cast(date as date) end as fecha,
         country as pais,
         case when regexp_matches(rank, '^-?[0-9]+$') then try_cast(rank as integer) end as rank,
         uri as artist_uri, artist_name, peak_rank, previous_rank,
         case when regexp_matches(days_on_chart, '^-?[0-9]+$')
              then try_cast(days_on_chart as integer) end as days_on_chart,
         consecutive_days, entry_status, entry_rank, entry_date,
         date as date_text, rank as rank_text, days_on_chart as days_text
  from daily_raw)"""

ANOMALY = DAILY + """,
anomaly as (
  select fecha, pais, rank, days_on_chart, entry_status from daily
  union all
  select fecha, 'VE', rank, 1, 'NEW_ENTRY' from daily where pais = 'click')"""

WEEKLY = _history(
    """select cast(date_trunc('week', l_shipdate) as date) as fecha, r_name as pais,
              l_partkey as key, cast(sum(cast(l_quantity as bigint)) as bigint) as score
       from lineitem
       join supplier on s_suppkey = l_suppkey
       join nation on n_nationkey = s_nationkey
       join region on r_regionkey = n_regionkey
       group by 1, 2, 3""",
    "cast(fecha - interval 7 day as date)",
    "weeks_on_chart",
    "consecutive_weeks",
    "w",
) + """,
released as (
  select l_partkey as key, cast(min(o_orderdate) as date) as release_date
  from lineitem join orders on o_orderkey = l_orderkey group by 1),
weekly as (
  select h.*, 'album:' || h.key as album_uri, 'Album ' || h.key as album_name,
         'Artist ' || (h.key % 100) as artist_names, p_brand as label, release_date,
         cast(entry_date - release_date as bigint) as days_release_to_entry
  from w_hist h
  left join part on p_partkey = h.key
  left join released on released.key = h.key)"""

WEEKLY_RAW = WEEKLY + """,
weekly_raw as (
  select fecha, pais, key, album_uri, album_name, artist_names,
         case when key % 11 = 1 then 'x' else cast(rank as varchar) end as rank,
         case when key % 7 = 1 then '  ' when key % 7 = 2 then null else label end as label,
         weeks_on_chart, consecutive_weeks, entry_status,
         case when key % 11 = 4 then 'n/a' when key % 11 = 5 then null
              else cast(entry_rank as varchar) end as entry_rank,
         entry_date,
         case when key % 13 = 1 then '2023-02-30' when key % 13 = 2 then '2023'
              when key % 13 = 3 then null else cast(release_date as varchar) end as release_date
  from weekly),
parsed as (
  select fecha, pais, try_cast(rank as integer) as rank, album_uri, album_name, artist_names, label,
         weeks_on_chart, consecutive_weeks, entry_status,
         try_cast(entry_rank as integer) as entry_rank, entry_date,
         case when regexp_matches(release_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
              then try_cast(release_date as date) end as release_date,
         release_date as release_date_raw, entry_rank as entry_rank_raw
  from weekly_raw),
albums as (
  select *, cast(entry_date - release_date as bigint) as days_release_to_entry from parsed)"""

MONTHLY = _history(
    """select cast(date_trunc('month', l_shipdate) as date) as fecha, n_name as pais,
              l_partkey as key, cast(sum(cast(l_quantity as bigint)) as bigint) as score
       from lineitem
       join supplier on s_suppkey = l_suppkey
       join nation on n_nationkey = s_nationkey
       group by 1, 2, 3""",
    "cast(fecha - interval 1 month as date)",
    "days_on_chart",
    "consecutive_days",
    "m",
) + """,
monthly as (
  select fecha as date, pais as country, rank, 'artist:' || key as artist_uri,
         'Artist ' || key as artist_name, days_on_chart
  from m_hist)"""

PROFILE = MONTHLY + """,
profile as (
  select artist_uri, count(distinct country) as country_count_by_artist,
         max(days_on_chart) as max_days_on_chart,
         case when max(days_on_chart) > 4 then 'Veterano' else 'Nuevo' end as artist_tenure,
         case when count(distinct country) > 16 then 'Global' else 'Local' end as artist_scope
  from monthly where country <> 'NATION_7' group by artist_uri)"""

_IDENTITY = ("country", "m.artist_uri", "cast(date as varchar)", "rank", "m.days_on_chart")


def _keyed(value: str) -> str:
    """A value as its length and its text, ``-`` where it is NULL."""
    return f"coalesce(length({value}::varchar) || ':' || {value}::varchar, '-')"


PEOPLE = PROFILE + f""",
people as (
  select m.*, country_count_by_artist, max_days_on_chart, artist_tenure, artist_scope,
         case when rank <= 8 then 'Top' else 'Estable' end as rank_tier,
         artist_tenure || '-' || artist_scope || '-'
           || case when rank <= 8 then 'Top' else 'Estable' end as partition_id,
         md5('42|' || {" || '|' || ".join(_keyed(c) for c in _IDENTITY)}) as id
  from monthly m left join profile p on p.artist_uri = m.artist_uri
  where country <> 'NATION_7' and date >= date '1996-01-01'),
counted as (
  select partition_id, count(*) as n, count(*) / sum(count(*)) over () as probability
  from people group by partition_id),
strata as (
  select partition_id, n as "count", probability,
         cast(round_even(probability * 5000, 0) as bigint) as n_i,
         least(round_even(probability * 5000, 0) / n, 1.0) as fraction
  from counted)"""

SAMPLE = PEOPLE + """,
drawn as (
  select * exclude (place, n_i) from (
    select people.*, n_i, row_number() over (partition by people.partition_id order by id) as place
    from people join strata on strata.partition_id = people.partition_id) s
  where place <= n_i)"""

FOLDED = SAMPLE + """,
folded as (
  select *, (row_number() over (partition by partition_id order by id) - 1) % 5 as fold_id
  from drawn)"""

LEADERS = DAILY + """,
leaders as (
  select artist_name, count(*) as dias_pais_en_no1, count(distinct pais) as paises_con_no1
  from daily where rank = 1 group by artist_name)"""

LEADER_SHARE = LEADERS + """,
first_ten as (select * from leaders order by dias_pais_en_no1 desc, artist_name limit 10),
leader_share as (
  select (select sum(dias_pais_en_no1) from first_ten)
           / (select sum(dias_pais_en_no1) from leaders) as share_top10,
         (select cast(sum(dias_pais_en_no1) as bigint) from leaders) as total_no1,
         artist_name, dias_pais_en_no1, paises_con_no1
  from leaders order by dias_pais_en_no1 desc, artist_name limit 1)"""


def _share(condition: str) -> str:
    return f"avg(case when {condition} then 1.0 else 0.0 end)"


def _band(name: str) -> str:
    return f"""case when {name} <= 10 then '1-10' when {name} <= 25 then '11-25'
         when {name} <= 50 then '26-50' when {name} <= 100 then '51-100' else '101-200' end"""


def _band_order(name: str) -> str:
    return f"list_position(['1-10', '11-25', '26-50', '51-100', '101-200'], {name})"


TOP_STATUS = f"""
top_status as (
  select fecha, {_share("entry_status = 'NEW_ENTRY'")} as share_new_entry,
         {_share("entry_status = 'RE_ENTRY'")} as share_re_entry,
         {_share("entry_status = 'NO_CHANGE'")} as share_no_change,
         {_share("entry_status in ('MOVED_UP', 'MOVED_DOWN')")} as share_movement
  from daily where rank <= 10 group by fecha)"""

TURNOVER = f"""{TOP_STATUS},
turnover as (
  select avg(share_new_entry + share_re_entry) as promedio_ingresos,
         avg(share_no_change) as promedio_no_change,
         (select fecha from top_status
          order by share_new_entry + share_re_entry desc, fecha limit 1) as pico_fecha,
         max(share_new_entry + share_re_entry) as pico_share_ingresos
  from top_status)"""

DIVERSITY = """
diversity as (
  select fecha, artistas_distintos_en_no1,
         avg(artistas_distintos_en_no1) over (order by fecha
           rows between 29 preceding and current row) as promedio_30d
  from (select fecha, count(distinct artist_name) as artistas_distintos_en_no1
        from daily where rank = 1 group by fecha) d),
diversity_facts as (
  select min(artistas_distintos_en_no1) as minimo, max(artistas_distintos_en_no1) as maximo,
         avg(artistas_distintos_en_no1) as promedio
  from diversity)"""

PERMANENCE = f"""
permanence as (
  select banda_rank,
         cast(quantile_disc(days_on_chart, 0.5) as bigint) as mediana_dias_en_chart,
         cast(quantile_disc(consecutive_days, 0.5) as bigint) as mediana_dias_consecutivos,
         {_share("entry_status = 'NEW_ENTRY'")} as share_new_entry
  from (select *, {_band("rank")} as banda_rank from daily
        where rank is not null and days_on_chart is not null) d
  group by banda_rank)"""


def _diagnostics(source: str) -> str:
    return f"""
diagnostics as (
  select pais, count(*) as observaciones_top10, count(distinct fecha) as dias_cubiertos,
         {_share("entry_status = 'NEW_ENTRY'")} as share_new_entry_top10,
         {_share("entry_status = 'NO_CHANGE'")} as share_no_change_top10,
         cast(quantile_disc(days_on_chart, 0.5) as bigint) as mediana_days_on_chart
  from {source} where rank <= 10 group by pais having count(*) >= 200)"""


_MARKET_COLUMNS = """pais, observaciones_top10, dias_cubiertos,
  round(share_new_entry_top10, 6) as share_new_entry_top10,
  round(share_no_change_top10, 6) as share_no_change_top10, mediana_days_on_chart"""
_ANOMALOUS = """(share_new_entry_top10 >= 0.90
  or (share_no_change_top10 = 0 and mediana_days_on_chart <= 1))"""
_SETTLED = """(share_new_entry_top10 < 0.90
  and not (share_no_change_top10 = 0 and mediana_days_on_chart <= 1))"""

_LABEL = """case when trim(label) = '' then 'Sin etiqueta'
  else coalesce(label, 'Sin etiqueta') end"""


def _label_top(source: str) -> str:
    return f"""
label_top as (
  select {_LABEL} as label_limpio, count(*) as semanas_en_top10,
         count(distinct album_uri) as albumes_distintos
  from {source} where rank <= 10 group by 1)"""


LAGS = """
lags as (
  select bucket_lag, count(*) as "count", count(*) / sum(count(*)) over () as share
  from (select case when days_release_to_entry <= 7 then '0-7'
                    when days_release_to_entry <= 30 then '8-30'
                    when days_release_to_entry <= 180 then '31-180'
                    when days_release_to_entry <= 365 then '181-365'
                    else '366-3650' end as bucket_lag
        from weekly where days_release_to_entry between 0 and 3650) d
  group by bucket_lag),
lag_facts as (
  select sum(case when bucket_lag = '0-7' then share end) as share_7,
         sum(case when bucket_lag in ('0-7', '8-30') then share end) as share_30,
         sum(case when bucket_lag = '366-3650' then share end) as share_catalogo
  from lags)"""

DEBUT = f"""
debut as (
  select banda_entry, cast(quantile_disc(weeks_on_chart, 0.5) as bigint)
           as mediana_semanas_en_chart,
         {_share("rank <= 10")} as share_tiempo_en_top10
  from (select *, {_band("entry_rank")} as banda_entry from weekly
        where entry_rank is not null and weeks_on_chart is not null) d
  group by banda_entry),
debut_facts as (
  select (select banda_entry from debut
          order by mediana_semanas_en_chart desc, {_band_order("banda_entry")} limit 1)
           as banda_mas_longeva,
         max(mediana_semanas_en_chart) as mediana_semanas,
         (select banda_entry from debut
          order by share_tiempo_en_top10 desc, {_band_order("banda_entry")} limit 1)
           as banda_mas_top10,
         max(share_tiempo_en_top10) as share_tiempo_en_top10
  from debut)"""


def _facts() -> str:
    daily = LEADER_SHARE.strip() + f",{TURNOVER},{DIVERSITY},{PERMANENCE}"
    rows = [
        (1, "share_top10", "share_top10", None, "leader_share"),
        (1, "leader_days", "dias_pais_en_no1", None, "leader_share"),
        (1, "leader_markets", "paises_con_no1", None, "leader_share"),
        (1, "leader", None, "artist_name", "leader_share"),
        (2, "mean_intake", "promedio_ingresos", None, "turnover"),
        (2, "mean_unchanged", "promedio_no_change", None, "turnover"),
        (3, "mean_leaders", "promedio", None, "diversity_facts"),
        (3, "min_leaders", "minimo", None, "diversity_facts"),
        (3, "max_leaders", "maximo", None, "diversity_facts"),
        (4, "median_first_band", "first_band", None, "bands"),
        (4, "median_last_band", "last_band", None, "bands"),
        (5, "label_weeks", "semanas_en_top10", None, "best_label"),
        (5, "label", None, "label_limpio", "best_label"),
        (6, "share_week", "share_7", None, "lag_facts"),
        (6, "share_month", "share_30", None, "lag_facts"),
        (6, "share_late", "share_catalogo", None, "lag_facts"),
        (7, "longest_weeks", "mediana_semanas", None, "debut_facts"),
        (7, "best_top_share", "share_tiempo_en_top10", None, "debut_facts"),
        (7, "longest_band", None, "banda_mas_longeva", "debut_facts"),
        (7, "best_top_band", None, "banda_mas_top10", "debut_facts"),
    ]
    facts = " union all ".join(
        f"select {topic} as topic, '{fact}' as fact, "
        f"{f'cast({value} as double)' if value else 'cast(null as double)'} as value, "
        f"{name or 'cast(null as varchar)'} as name from {source}"
        for topic, fact, value, name, source in rows
    )
    return f"""with {daily},{WEEKLY},{_label_top("weekly")},{LAGS},{DEBUT},
bands as (
  select max(case when banda_rank = '1-10' then mediana_dias_en_chart end) as first_band,
         max(case when banda_rank = '101-200' then mediana_dias_en_chart end) as last_band
  from permanence),
best_label as (select * from label_top order by semanas_en_top10 desc, label_limpio limit 1),
facts as ({facts})
select cast(topic as bigint) as topic, fact, round(value, 6) as value, name from facts"""


_TABLE_COLUMNS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
    "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2,
    "labels": 3, "conversations": 4,
}


def _table_row(name: str) -> str:
    return (
        f"select '{name}' as table_name, '{name}.parquet' as file_name, count(*) as row_count, "
        f"cast({_TABLE_COLUMNS[name]} as bigint) as column_count from {name}"
    )


_ARTIST_COLUMNS = (
    "fecha", "pais", "rank", "artist_uri", "artist_name", "peak_rank", "previous_rank",
    "days_on_chart", "consecutive_days", "entry_status", "entry_rank", "entry_date",
)
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
_PART_TYPES = {
    "p_partkey": "int", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
    "p_retailprice": "double",
}
_STRATA = [
    f"{tenure}-{scope}-{tier}"
    for tenure in ("Nuevo", "Veterano")
    for scope in ("Global", "Local")
    for tier in ("Estable", "Top")
]

PREDICTIONS = """
predictions as (
  select documents.doc_id as id, documents.doc_id % 5 as fold_id,
         cast(quality as double) as label, cast(n_chars as double) as score,
         case when n_chars > 1000 then 1.0 else 0.0 end::double as prediction
  from documents join labels on labels.doc_id = documents.doc_id)"""

CONFUSION = PREDICTIONS + """,
confusion as (
  select fold_id, label, prediction, count(*) as "count"
  from predictions group by fold_id, label, prediction)"""


def _class_scores(group: str, source: str) -> str:
    """Table ``<source>_classes``: scores per class from counts, per ``group`` if given."""
    g = f"{group}, " if group else ""
    by = f"group by {g}class_label"
    return f"""
{source}_sums as (
  select {g}class_label, sum(tp) as tp, sum(support) as support, sum(predicted) as predicted
  from (select {g}label as class_label, case when label = prediction then "count" else 0 end as tp,
               "count" as support, 0 as predicted from {source}
        union all
        select {g}prediction, 0, 0, "count" from {source}) v
  {by}),
{source}_rates as (
  select *, case when predicted > 0 then tp / predicted else 0.0 end as p,
         case when support > 0 then tp / support else 0.0 end as r
  from {source}_sums),
{source}_classes as (
  select *, case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end as f1
  from {source}_rates)"""


def _metrics_of(source: str) -> str:
    return _class_scores("fold_id", source) + f""",
{source}_scored as (
  select fold_id, sum(tp) / sum(support) as accuracy,
         sum(f1 * support) / sum(support) as f1_weighted,
         sum(p * support) / sum(support) as precision_weighted,
         sum(r * support) / sum(support) as recall_weighted,
         cast(sum(support) as bigint) as n_test
  from {source}_classes group by fold_id)"""


ROC = PREDICTIONS + """,
per_score as (
  select fold_id, score, count(*) filter (where label = 1) as pos,
         count(*) filter (where label <> 1) as neg
  from predictions group by fold_id, score),
running as (
  select *, sum(pos) over (partition by fold_id order by score desc) as tp,
         sum(neg) over (partition by fold_id order by score desc) as fp,
         sum(pos) over (partition by fold_id) as pos_all,
         sum(neg) over (partition by fold_id) as neg_all
  from per_score),
areas as (
  select fold_id, sum(neg * (tp - pos / 2.0)) / (max(pos_all) * max(neg_all)) as auc_roc
  from running group by fold_id)"""

METRICS = f"""{ROC},
confusion as (
  select fold_id, label, prediction, count(*) as "count"
  from predictions group by fold_id, label, prediction),{_metrics_of("confusion")},
metrics as (
  select s.*, auc_roc from confusion_scored s join areas on areas.fold_id = s.fold_id)"""

_METRIC_NAMES = ("accuracy", "f1_weighted", "precision_weighted", "recall_weighted", "auc_roc")


def _long(source: str, name: str) -> str:
    parts = " union all ".join(
        f"select fold_id, '{m}' as metric, {m} as value from {source}" for m in _METRIC_NAMES
    )
    return f"{name} as ({parts})"


LABEL_COUNTS = """
cells as (select fold_id, label, count(*) as n from predictions group by fold_id, label),
pairs as (
  select f.fold_id, l.label, coalesce(n, 0) as n_test
  from (select distinct fold_id from cells) f
  cross join (select distinct label from cells) l
  left join cells on cells.fold_id = f.fold_id and cells.label = l.label),
label_counts as (
  select *, sum(n_test) over (partition by label) - n_test as n_train from pairs),
majority as (
  select fold_id, label as majority_label from (
    select *, row_number() over (partition by fold_id order by n_train desc, label) as place
    from label_counts) p
  where place = 1),
constant as (
  select label_counts.fold_id, label, majority_label as prediction, n_test as "count"
  from label_counts join majority on majority.fold_id = label_counts.fold_id)"""


BASELINE = f"""{LABEL_COUNTS},{_metrics_of("constant")},
baseline as (
  select accuracy, f1_weighted, precision_weighted, recall_weighted, 0.5::double as auc_roc,
         s.fold_id, majority_label
  from constant_scored s join majority on majority.fold_id = s.fold_id)"""


def _rounded(names) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


def _sample_row_columns() -> str:
    return """cast(date as varchar) as date, country, rank, artist_uri, artist_name, days_on_chart,
  country_count_by_artist, max_days_on_chart, artist_tenure, artist_scope, rank_tier, partition_id"""


def _index_of(column: str) -> str:
    return f"""select '{column}' as column_name, {column} as value,
  cast(row_number() over (order by count(*) desc, {column}) - 1 as double) as index
  from folded group by {column}"""


_COMPARED = f"""with {SAMPLE},
shares as (select partition_id, count(*) as count_M,
                  count(*) / sum(count(*)) over () as prop_M
           from drawn group by partition_id)
select strata.partition_id, "count" as count_P, round(probability, 6) as prop_P,
       count_M, round(prop_M, 6) as prop_M,
       round(abs(probability - prop_M) * 100, 6) as abs_diff_pct
from strata join shares on shares.partition_id = strata.partition_id"""

_FOLD_CHECKS = f"""with {FOLDED},
per_fold as (select fold_id, count(*) as size, count(distinct partition_id) as strata
             from folded group by fold_id),
f as (select count(*) as folds_distintos, cast(sum(size) as bigint) as registros_asignados,
             min(strata) as particiones_por_fold_min, min(size) as fold_min,
             max(size) as fold_max from per_fold),
s as (select count(distinct partition_id) as particiones_totales,
             count(distinct id) as ids_distintos from folded)
select *, folds_distintos = 5 and fold_max - fold_min <= 10 as five_balanced_folds,
       ids_distintos = registros_asignados as unique_ids,
       particiones_por_fold_min = particiones_totales as all_strata_in_folds
from f cross join s"""

_CLUSTER_COLUMNS = ("days_on_chart", "max_days_on_chart", "country_count_by_artist", "rank")
_CENTRES = ((-0.8, -0.9, -0.7, 0.4), (0.9, 0.6, 0.5, -0.6), (0.1, 0.4, 0.8, 1.1))


def _to_centre(point: str) -> str:
    return " + ".join(f"(x{i} - {point}{i}) * (x{i} - {point}{i})" for i in range(4))


def _to_cluster() -> str:
    """Mean squared distance of a row to the rows of a cluster."""
    squares = " + ".join(f"x{i} * x{i}" for i in range(4))
    return f"{squares} + (q - 2 * ({' + '.join(f'x{i} * s{i}' for i in range(4))})) / n"


_FIXED = f"""{FOLDED},
points as (select id, {", ".join(_CLUSTER_COLUMNS)}, {", ".join(
    f"({c} - avg({c}) over ()) / stddev_samp({c}) over () as x{i}" for i, c in enumerate(_CLUSTER_COLUMNS))}
  from folded),
centres(prediction, c0, c1, c2, c3) as (values {", ".join(f"({k}, {', '.join(f'{x}::double' for x in c)})" for k, c in enumerate(_CENTRES))}),
nearest as (select *, {_to_centre("c")} as distance from points cross join centres
  qualify row_number() over (partition by id order by distance, prediction) = 1),
moments as (select prediction as cluster, count(*) as n, sum({" + ".join(f"x{i} * x{i}" for i in range(4))}) as q,
  {", ".join(f"sum(x{i}) as s{i}" for i in range(4))} from nearest group by prediction),
means as (select id, prediction, distance, cluster, n, {_to_cluster()} as mean from nearest cross join moments),
silhouettes as (select id, case when max(case when cluster = prediction then n end) = 1 then 0 else
    (min(case when cluster <> prediction then mean end) - max(case when cluster = prediction then mean * n / (n - 1) end))
    / greatest(min(case when cluster <> prediction then mean end), max(case when cluster = prediction then mean * n / (n - 1) end)) end as s
  from means group by id),
fixed as (select cast(prediction as bigint) as prediction, count(*) as "count", sum(distance) as cost_, avg(s) as silhouette_,
    round(sum(distance), 6) as cost, round(avg(s), 6) as silhouette,
    round(count(*) / sum(count(*)) over () * 100, 6) as pct, {", ".join(f"avg({c}) as {c}" for c in _CLUSTER_COLUMNS)}
  from nearest join silhouettes on silhouettes.id = nearest.id group by prediction)"""

_TREE_SCORES = f"""with {FOLDED},
shares as (select id,
  case when days_on_chart <= 3 then case when max_days_on_chart <= 6 then 0.9 else 0.5 end else 0.2 end as a,
  case when country_count_by_artist <= 14 then 0.75 else case when days_on_chart <= 5 then 0.5 else 0.15 end end as b,
  0.75 as c from folded)
select id, round(((a + b + c) / 3)::double, 6) as score_0, round(((3 - a - b - c) / 3)::double, 6) as score_1,
  case when a + b + c >= 1.5 then 0.0 else 1.0 end::double as prediction from shares"""


ORACLES: dict[str, str] = {
    "leaders": f"with {LEADERS} select * from leaders",
    "leader_share": f"""with {LEADER_SHARE}
        select round(share_top10, 6) as share_top10, total_no1, artist_name, dias_pais_en_no1,
               paises_con_no1 from leader_share""",
    "leader_reach": f"""with {LEADERS},
        strong as (select * from leaders where dias_pais_en_no1 >= 2)
        select * from (select *, 'highlighted' as segment from strong
          order by dias_pais_en_no1 desc, paises_con_no1 desc, artist_name limit 12) a
        union all
        select * from (select *, 'local' as segment from strong where paises_con_no1 <= 1
          order by dias_pais_en_no1 desc, artist_name limit 5) b
        union all
        select * from (select *, 'global' as segment from strong where paises_con_no1 >= 2
          order by dias_pais_en_no1 desc, artist_name limit 5) c""",
    "leader_diversity": f"""with {DAILY},{DIVERSITY}
        select cast(fecha as varchar) as fecha, artistas_distintos_en_no1,
               round(promedio_30d, 6) as promedio_30d from diversity""",
    "leader_diversity_facts": f"""with {DAILY},{DIVERSITY}
        select minimo, maximo, round(promedio, 6) as promedio from diversity_facts""",
    "top10_status": f"""with {DAILY},{TOP_STATUS}
        select cast(fecha as varchar) as fecha, {_rounded((
            "share_new_entry", "share_re_entry", "share_no_change", "share_movement"))}
        from top_status""",
    "turnover_facts": f"""with {DAILY},{TURNOVER}
        select {_rounded(("promedio_ingresos", "promedio_no_change", "pico_share_ingresos"))},
               cast(pico_fecha as varchar) as pico_fecha from turnover""",
    "band_permanence": f"""with {DAILY},{PERMANENCE}
        select banda_rank, mediana_dias_en_chart, mediana_dias_consecutivos,
               round(share_new_entry, 6) as share_new_entry from permanence""",
    "market_diagnostics": f"""with {DAILY},{_diagnostics("daily")}
        select {_MARKET_COLUMNS} from diagnostics""",
    "market_anomalies": f"""with {ANOMALY},{_diagnostics("anomaly")}
        select {_MARKET_COLUMNS} from diagnostics where {_ANOMALOUS}""",
    "market_volatility": f"""with {ANOMALY},{_diagnostics("anomaly")}
        select {_MARKET_COLUMNS} from (select * from diagnostics where {_SETTLED}
          order by share_new_entry_top10 desc, pais limit 15) v""",
    "market_stable": f"""with {ANOMALY},{_diagnostics("anomaly")}
        select {_MARKET_COLUMNS} from (select * from diagnostics where {_SETTLED}
          order by share_no_change_top10 desc, pais limit 3) v""",
    "label_top10": f"with {WEEKLY},{_label_top('weekly')} select * from label_top",
    "label_no1": f"""with {WEEKLY}
        select {_LABEL} as label_limpio, count(*) as semanas_en_no1
        from weekly where rank = 1 group by 1""",
    "label_top10_raw": f"with {WEEKLY_RAW},{_label_top('albums')} select * from label_top",
    "release_lag": f"""with {WEEKLY},{LAGS}
        select bucket_lag, "count", round(share, 6) as share from lags""",
    "release_lag_facts": f"""with {WEEKLY},{LAGS}
        select {_rounded(("share_7", "share_30", "share_catalogo"))} from lag_facts""",
    "debut_permanence": f"""with {WEEKLY},{DEBUT}
        select banda_entry, mediana_semanas_en_chart,
               round(share_tiempo_en_top10, 6) as share_tiempo_en_top10 from debut""",
    "debut_facts": f"""with {WEEKLY},{DEBUT}
        select banda_mas_longeva, mediana_semanas, banda_mas_top10,
               round(share_tiempo_en_top10, 6) as share_tiempo_en_top10 from debut_facts""",
    "executive_facts": _facts(),
    "safe_parse": f"""with {DAILY_RAW}
        select artist_uri as uri, pais as country, cast(entry_date as varchar) as entry_date,
               date_text, rank_text, days_text, cast(fecha as varchar) as fecha,
               cast(rank as bigint) as rank, cast(days_on_chart as bigint) as days_on_chart
        from artists""",
    "typed_albums": f"""with {WEEKLY_RAW}
        select cast(fecha as varchar) as fecha, pais, cast(rank as bigint) as rank, album_uri,
               album_name, artist_names, label, weeks_on_chart, consecutive_weeks, entry_status,
               cast(entry_rank as bigint) as entry_rank, cast(entry_date as varchar) as entry_date,
               cast(release_date as varchar) as release_date, release_date_raw, entry_rank_raw,
               days_release_to_entry
        from albums""",
    "coverage": f"""with {DAILY_RAW},{WEEKLY_RAW}
        select 'Artistas diarios' as dataset, count(*) as filas,
               count(distinct pais) + cast(count(*) > count(pais) as integer) as paises,
               cast(min(fecha) as varchar) as fecha_min, cast(max(fecha) as varchar) as fecha_max
        from artists
        union all
        select 'Albumes semanales', count(*),
               count(distinct pais) + cast(count(*) > count(pais) as integer),
               cast(min(fecha) as varchar), cast(max(fecha) as varchar)
        from albums""",
    "quality": f"""with {DAILY_RAW},{WEEKLY_RAW}
        select 'artistas' as tabla, count(*) filter (where rank is null) as filas_rank_invalido,
               count(*) filter (where fecha is null) as filas_fecha_invalida,
               count(*) filter (where days_on_chart is null) as filas_days_on_chart_invalido,
               null::bigint as filas_release_date_malformada,
               null::bigint as filas_entry_rank_malformado
        from artists
        union all
        select 'albumes', count(*) filter (where rank is null), null, null,
               count(*) filter (where release_date_raw is not null and release_date is null),
               count(*) filter (where entry_rank_raw is not null and entry_rank is null)
        from albums""",
    "table_profile": _table_row("lineitem"),
    "summary_union": " union all ".join(_table_row(name) for name in _TABLE_COLUMNS),
    "null_profile": f"with {DAILY_RAW} "
    + " union all ".join(
        f"""select '{c}' as column_name, count(*) - count({c}) as null_count,
        round((count(*) - count({c})) / count(*) * 100, 4) as null_pct from artists"""
        for c in _ARTIST_COLUMNS
    ),
    "schema_rows": " union all ".join(
        f"select cast({i} as bigint) as ordinal, '{c}' as column_name, '{t}' as data_type, "
        f"count({c}) as value_count from lineitem"
        for i, (c, t) in enumerate(_LINE_TYPES.items(), start=1)
    ),
    "numeric_moments": " union all ".join(
        f"""select '{c}' as column_name, count({c}) as "count",
        round(avg({c}::double), 6) as mean, round(stddev_samp({c}::double), 6) as stddev,
        round(min({c})::double, 6) as min, round(max({c})::double, 6) as max from lineitem"""
        for c, t in _LINE_TYPES.items()
        if t in ("bigint", "int", "double")
    ),
    "numeric_quartiles": " union all ".join(
        f"""select '{c}' as column_name, round(quantile_disc({c}::double, 0.25), 6) as q25,
        round(quantile_disc({c}::double, 0.5), 6) as q50,
        round(quantile_disc({c}::double, 0.75), 6) as q75 from lineitem"""
        for c, t in _LINE_TYPES.items()
        if t in ("bigint", "int", "double")
    ),
    "split_sizes": f"""with {FOLDED}
        select fold_id, count(*) as n_test, (select count(*) from folded) - count(*) as n_train
        from folded group by fold_id""",
    "cluster_totals": f"""with {FOLDED}
        select cast(count(*) as bigint) as rows, 100.0::double as pct from folded""",
    "cluster_strata": f"""with {FOLDED}
        select s.partition_id, count(f.partition_id) as rows
        from (values {", ".join(f"('{s}')" for s in _STRATA)}) s(partition_id)
        left join folded f on f.partition_id = s.partition_id group by 1""",
    "line_quartiles": """select l_returnflag, l_linestatus, count(*) as "count",
        round(quantile_disc(l_extendedprice, 0.25), 6) as q25, round(quantile_disc(l_extendedprice, 0.5), 6) as q50,
        round(quantile_disc(l_extendedprice, 0.75), 6) as q75 from lineitem group by all""",
    "csv_round_trip": f"""with {DAILY_RAW}
        select cast(fecha as varchar) as fecha, pais, cast(rank as bigint) as rank, artist_uri, artist_name,
               peak_rank, previous_rank, cast(days_on_chart as bigint) as days_on_chart, consecutive_days,
               entry_status, entry_rank, cast(entry_date as varchar) as entry_date from artists""",
    "landed_months": f"""with {WEEKLY_RAW}
        select strftime(fecha, '%Y-%m') as month, count(*) as rows, cast(min(fecha) as varchar) as first_date
        from albums where strftime(fecha, '%Y-%m') >= '1998-01' group by 1""",
    "inferred_profile": " union all ".join(
        f"select {i}::bigint as ordinal, '{c}' as column_name, '{t}' as data_type, count({c}) as value_count from part"
        for i, (c, t) in enumerate(_PART_TYPES.items(), start=1)
    ),
    "duplicates": """select count(*) as duplicate_count from (
        select l_orderkey, l_linenumber from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1) d""",
    "population_audit": f"""with {MONTHLY}
        select count(*) as n_original, cast(min(date) as varchar) as min_date,
               cast(max(date) as varchar) as max_date,
               count(*) - count(date) as null_date, count(*) - count(country) as null_country,
               count(*) - count(rank) as null_rank,
               count(*) - count(artist_uri) as null_artist_uri,
               count(*) - count(days_on_chart) as null_days_on_chart,
               (select count(*) from (
                  select 1 from monthly group by date, country, rank, artist_uri, days_on_chart
                  having count(*) > 1) g) as duplicate_count
        from monthly""",
    "entity_profile": f"with {PROFILE} select * from profile",
    "population": f"with {PEOPLE} select {_sample_row_columns()} from people",
    "strata": f"""with {PEOPLE}
        select partition_id, "count", round(probability, 6) as probability, n_i,
               round(fraction, 6) as fraction from strata""",
    "sample_exact": f"with {SAMPLE} select {_sample_row_columns()} from drawn",
    "strata_compare": _COMPARED,
    "written_strata": _COMPARED,
    "sample_bernoulli": f"""with {PEOPLE}
        select {_sample_row_columns()} from (select people.*, fraction from people
          join strata on strata.partition_id = people.partition_id) s
        where ('0x' || substr(id, 1, 13))::bigint / 4503599627370496.0::double < fraction::double""",
    "written_document": _FOLD_CHECKS.replace(
        "select *, folds_distintos = 5", "select folds_distintos, fold_min, fold_max, folds_distintos = 5"
    ),
    "fixed_clusters": f"with {_FIXED}\nselect prediction, count, pct, cost, silhouette, "
    + f"{_rounded(_CLUSTER_COLUMNS)} from fixed",
    "fixed_cluster_score": f"""with {_FIXED}
        select count(*) as k, round(sum(fixed.cost_), 6) as inertia,
               round(sum(silhouette_ * "count") / sum("count"), 6) as silhouette from fixed""",
    "tree_scores": _TREE_SCORES,
    "sample_checks": f"""with {SAMPLE},
        shares as (select partition_id, count(*) / sum(count(*)) over () as prop_M
                   from drawn group by partition_id),
        gaps as (select count(*) as strata, max(abs(probability - prop_M) * 100) as gap
                 from strata join shares on shares.partition_id = strata.partition_id)
        select strata, round(gap, 6) as max_abs_diff_pct, n_M, n_M as n_M_clean,
               strata = 8 as all_strata_sampled, abs(n_M - 5000) / 5000 < 0.03 as size_near_target,
               true as nothing_lost
        from gaps cross join (select count(*) as n_M from drawn
          where coalesce(country, artist_tenure, artist_scope, rank_tier) is not null) d""",
    "critical_nulls": f"with {PEOPLE} select "
    + ", ".join(
        f"count(*) - count({c}) as {c}"
        for c in (
            "country", "rank", "days_on_chart", "max_days_on_chart", "country_count_by_artist",
            "artist_tenure", "artist_scope", "rank_tier", "partition_id",
        )
    )
    + " from people",
    "folds": f"""with {FOLDED}
        select id, partition_id, country, artist_uri, cast(date as varchar) as date, fold_id
        from folded""",
    "fold_sizes": f"""with {FOLDED}
        select fold_id, count(*) as "count",
               round(count(*) / (select count(*) from folded) * 100, 2) as pct_M
        from folded group by fold_id""",
    "fold_pivot": f"""with {FOLDED}
        select partition_id, {", ".join(
            f'count(*) filter (where fold_id = {k}) as "{k}"' for k in range(5))}
        from folded group by partition_id""",
    "fold_checks": _FOLD_CHECKS,
    "class_share": f"""with {FOLDED}
        select fold_id, rank_tier, count(*) as "count",
               round(count(*) / sum(count(*)) over (partition by fold_id) * 100, 6) as pct_fold
        from folded group by fold_id, rank_tier""",
    "class_weights": f"""with {FOLDED},
        train as (select f.fold_id, rank_tier as label, count(*) as n_train
                  from folded join (select distinct fold_id from folded) f
                    on f.fold_id <> folded.fold_id
                  group by f.fold_id, rank_tier)
        select fold_id, label, n_train,
               round(sum(n_train) over (partition by fold_id)
                     / (count(*) over (partition by fold_id) * n_train), 6) as weight
        from train""",
    "label_index": f"with {FOLDED} "
    + " union all ".join(
        _index_of(c) for c in ("country", "artist_tenure", "artist_scope", "rank_tier")
    ),
    "scaled": f"""with {FOLDED}
        select id, {", ".join(
            f"round(({c} - avg({c}) over ()) / stddev_samp({c}) over (), 6) as {c}_scaled"
            for c in ("days_on_chart", "max_days_on_chart", "country_count_by_artist", "rank"))}
        from folded""",
    "run_summary": f"""with {FOLDED},
        sizes as (select fold_id, count(*) as n from folded group by fold_id),
        n as (select count(*) as rows_ from folded)
        select 'sample_rows' as item, format('{{:,}}', rows_) as value from n
        union all select 'clean_rows', format('{{:,}}', rows_) from n
        union all select 'folds', cast(count(*) as varchar) from sizes
        union all select 'smallest_fold', format('{{:,}}', min(n)) from sizes
        union all select 'largest_fold', format('{{:,}}', max(n)) from sizes
        union all (with {METRICS},{_long("metrics", "long")}
          select metric || '_mean', printf('%.4f', avg(value)) from long
            where metric in ('auc_roc', 'f1_weighted') group by metric
          union all select metric || '_std', printf('%.4f', stddev_samp(value)) from long
            where metric in ('auc_roc', 'f1_weighted') group by metric
          union all (select 'best_fold', cast(fold_id as varchar) from metrics
            order by auc_roc desc, f1_weighted desc, fold_id limit 1))""",
    "composition": f"""with {PEOPLE}
        select country, {", ".join(
            f"round(count(*) filter (where partition_id = '{s}') / count(*) * 100, 6) as \"{s}\""
            for s in _STRATA)}
        from people group by country""",
    "confusion": f"with {CONFUSION} select * from confusion",
    "confusion_total": f"""with {CONFUSION}
        select label, prediction, cast(sum("count") as bigint) as "count"
        from confusion group by label, prediction""",
    "confusion_matrix": f"""with {METRICS}
        select case label when 0 then 'low' else 'high' end as class,
               count(*) filter (where prediction = 0) as low,
               count(*) filter (where prediction = 1) as high
        from predictions
        where fold_id = (select fold_id from metrics
          order by auc_roc desc, f1_weighted desc, fold_id limit 1) group by 1""",
    "per_class": f"""with {CONFUSION},{_class_scores("", "confusion")}
        select class_label as label, case class_label when 0 then 'low' else 'high' end as class,
               cast(support as bigint) as support, round(p, 6) as precision, round(r, 6) as recall,
               round(f1, 6) as f1
        from confusion_classes where support > 0""",
    "roc_points": f"""with {ROC}
        select fold_id, score, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
               round(tp / pos_all, 6) as tpr, round(fp / neg_all, 6) as fpr from running
        union all
        select distinct fold_id, 'infinity'::double, 0, 0, 0.0, 0.0 from running""",
    "auc": f"with {ROC} select fold_id, round(auc_roc, 6) as auc_roc from areas",
    "auc_summary": f"""with {ROC}
        select round(avg(auc_roc), 6) as auc_mean, round(stddev_samp(auc_roc), 6) as auc_std
        from areas""",
    "metrics": f"""with {METRICS}
        select fold_id, n_test, {_rounded(_METRIC_NAMES)} from metrics""",
    "metrics_long": f"""with {METRICS},{_long("metrics", "long")}
        select fold_id, metric, round(value, 6) as value from long""",
    "metrics_summary": f"""with {METRICS},{_long("metrics", "long")}
        select metric, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std,
               round(min(value), 6) as min, round(max(value), 6) as max
        from long group by metric""",
    "majority_baseline": f"""with {PREDICTIONS},{BASELINE}
        select {_rounded(_METRIC_NAMES)}, fold_id, majority_label from baseline""",
    "model_vs_baseline": f"""with {METRICS},{BASELINE},
        {_long("metrics", "long")},{_long("baseline", "base_long")},
        m as (select metric, avg(value) as mean, stddev_samp(value) as std, min(value) as min,
                     max(value) as max from long group by metric),
        b as (select metric, avg(value) as baseline_mean, stddev_samp(value) as baseline_std
              from base_long group by metric)
        select m.metric, {_rounded(("mean", "std", "min", "max", "baseline_mean", "baseline_std"))},
               round(mean - baseline_mean, 6) as delta_model_minus_baseline
        from m join b on b.metric = m.metric""",
    "best_fold": f"""with {METRICS}
        select fold_id, n_test, {_rounded(_METRIC_NAMES)} from metrics
        order by auc_roc desc, f1_weighted desc, fold_id limit 1""",
}
