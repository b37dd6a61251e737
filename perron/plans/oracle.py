"""DuckDB twins of the catalog.

They start from the raw attributes (see :mod:`perron.sources.derived`) and
compute every answer with DuckDB's own functions. No XML or JSON is involved:
what a parser should find is what the attributes say.
"""

from __future__ import annotations

from perron.functions.text import CATEGORY_LABELS, CLASS_LABELS, OPERATOR_NAMES, TYPE_LABELS
from perron.plans import catalog
from perron.sources import derived
from perron.sources.derived import DUCKDB, ELEMENTS

# ---- scalar snippets --------------------------------------------------------


def lake_time(x: str) -> str:
    return f"case when regexp_full_match({x}, '[0-9]{{10}}') then try_strptime('20' || {x}, '%Y%m%d%H%M') end"


def warehouse_time(x: str) -> str:
    century = f"case when substr({x}, 1, 2) < '60' then '20' else '19' end"
    return (
        f"case when regexp_full_match({x}, '[0-9]{{10}}') then try_strptime({century} || {x}, '%Y%m%d%H%M') "
        f"when regexp_full_match({x}, '[0-9]{{12}}') then try_strptime({x}, '%Y%m%d%H%M') end"
    )


def dayfirst_time(x: str) -> str:
    ordered = f"'20' || substr({x}, 5, 2) || substr({x}, 3, 2) || substr({x}, 1, 2) || substr({x}, 7)"
    return f"case when regexp_full_match({x}, '[0-9]{{10}}') then try_strptime({ordered}, '%Y%m%d%H%M') end"


def trim_null(x: str) -> str:
    return f"nullif(regexp_replace(regexp_replace({x}, '^\\s+', ''), '\\s+$', ''), '')"


def train_dim(c: str, n: str, o: str) -> str:
    return (
        f"coalesce({trim_null(c)}, 'None') || '_' || coalesce({trim_null(n)}, 'None') || '_' || "
        f"coalesce({trim_null(o)}, 'UNK')"
    )


def train_fact(c: str, n: str, o: str) -> str:
    return f"coalesce({c}, 'None') || '_' || coalesce({n}, 'None') || '_' || coalesce(nullif({o}, ''), 'UNK')"


def label(x: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"when '{code}' then '{text}'" for code, text in labels.items())
    return f"case {x} {cases} end"


def cancelled(x: str) -> str:
    return f"coalesce(lower(trim({x})) = 'c', false)"


def disrupted(x: str) -> str:
    return f"coalesce({x} = '1', false)"


def normalized(x: str) -> str:
    text = f"coalesce({x}, '')"
    for letter, spelled in (
        ("ß", "ss"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")
    ):
        text = f"replace({text}, '{letter}', '{spelled}')"
    text = f"regexp_replace({text}, '^berlin ', '', 'i')"
    text = f"regexp_replace({text}, '(str\\.|stra_e)', 'strasse', 'gi')"
    text = f"regexp_replace({text}, '\\s*\\(.*\\)', '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '[ .\\-]', '_', 'g'), '_+', '_', 'g')"
    return f"trim(lower({text}), '_')"


def lcs(a: str, b: str) -> str:
    """Textbook dynamic programme, one row of lengths per character of ``a``."""
    return (
        f"(list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), "
        f"lambda r, i: list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), "
        f"lambda nr, j: list_append(nr, case when substr({a}, i[1], 1) = substr({b}, j[1], 1) "
        f"then r[j[1]] + 1 else greatest(r[j[1] + 1], nr[j[1]]) end), [0::bigint]), "
        f"list_transform(range(0, length({b}) + 1), lambda x: 0::bigint)))[length({b}) + 1]"
    )


def ratio(a: str, b: str) -> str:
    return (
        f"case when {a} = '' and {b} = '' then 100.0::double when {a} = '' or {b} = '' then 0.0::double "
        f"else 200.0::double * {lcs(a, b)} / (length({a}) + length({b})) end"
    )


def haversine(lat1, lon1, lat2, lon2) -> str:
    lat1, lon1, lat2, lon2 = (f"({v})::double" for v in (lat1, lon1, lat2, lon2))
    h = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * 6371.0088 * asin(sqrt({h}))"


def bucketed_key(text: str, order: str) -> str:
    bucket = f"substr(md5({text}), 1, 3)"
    return (
        f"((('0x' || {bucket})::bigint << 40) + row_number() over (partition by {bucket} order by {order}))::bigint"
    )


def minute_number(ts: str) -> str:
    return f"strftime({ts}, '%Y%m%d%H%M')::bigint"


def calendar(ts: str) -> str:
    return (
        f"cast({ts} as date) as date, year({ts})::int as year, month({ts})::int as month, day({ts})::int as day, "
        f"hour({ts})::int as hour, minute({ts})::int as minute, (isodow({ts}) - 1)::int as weekday, "
        f"isodow({ts}) >= 6 as is_weekend"
    )


def time_row(ts: str) -> str:
    return f"{minute_number(ts)} as time_key, {ts} as timestamp, {calendar(ts)}"


# ---- shared tables ----------------------------------------------------------


def _select(columns: dict[str, str], source: str, star: bool = False) -> str:
    listed = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    return f"select {'*, ' if star else ''}{listed} from {source}"


def _layered(layers, source: str, star: bool = False) -> str:
    for columns in layers:
        sql = _select(columns, source, star)
        source = f"({sql})"
    return sql


def _numbered(source: str, count: str) -> str:
    return f"(select *, unnest(range(1, ({count}) + 1))::int as k from {source})"


def _path(feed: str, period: str, folder: str) -> str:
    return (
        f"'/part=' || cast(part as varchar) || '/{feed}/' || {period} || '/' || {folder} || '/' || "
        "file_station || '_timetable.xml'"
    )


_SNAP_FIRST, _SNAP_REST = derived.snapshot_layers(DUCKDB)
_SNAP_REST = {k: v for k, v in _SNAP_REST.items() if k != "snap"}


def _elements(time_text, name: str, source: str, condition: str, columns: str) -> str:
    parts = []
    for tag, index in ELEMENTS:
        count = "n_ar" if tag == "AR" else "n_dp"
        parts.append(
            f"select {columns}, '{tag}' as tag, {index} as idx, {time_text(DUCKDB, tag, index)} as {name} "
            f"from {source} where {condition} and {count} > {index}"
        )
    return " union all ".join(parts)


_STATION_ROW = (
    "number as station_id, number as station_number, name as station_name, eva as eva_number, ifopt, street, zipcode, "
    "city, state as federal_state, category, price_category, flag_a as has_parking, flag_b as has_bicycle_parking, "
    "flag_a as has_local_public_transport, flag_b as has_public_facilities, flag_a as has_locker_system, "
    "flag_b as has_taxi_rank, flag_a as has_travel_necessities, stepless as has_stepless_access, "
    "mobility as has_mobility_service, flag_b as has_wifi, flag_a as has_travel_center, "
    "flag_b as has_railway_mission, flag_a as has_db_lounge, flag_b as has_lost_and_found, flag_a as has_car_rental, "
    "lon as longitude, lat as latitude, region_number as regional_number, region as regional_name, "
    "'RB' as regional_shortname, carrier as aufgabentraeger_shortname, "
    "case when carrier is not null then 'Verkehrsverbund' end as aufgabentraeger_name, "
    "region_number as szentrale_number, '3-S Zentrale' as szentrale_name, phone as szentrale_phone, "
    "region_number as station_mgmt_number, region as station_mgmt_name, product_line, "
    "case when product_line is not null then 'A' end as segment, ril as ril100_identifier, "
    "case when ril is not null then '1' end as primary_location_code, "
    "case when ril is not null then 'entryAllowed' end as steam_permission"
)

_PLANNED_COLUMNS = (
    "path, pos, part, u, e, period, folder, xml_station, file_station, sid, has_tl, c, n, o, pp, l, ppth, pdest, status"
)
_CHANGE_COLUMNS = "path, pos, e, u, k, change_period, snap_folder, snap, name, sid, cl, cpp, clt, cs, cp, cpth, dis"

TABLES = {
    "stops": _layered(derived.stop_layers(DUCKDB), "events"),
    "planned_stops": (
        f"select *, {_path('timetables', 'period', 'folder')} as path, "
        "(row_number() over (partition by part, period, folder, u order by e) - 1)::int as pos from stops"
    ),
    "planned_el": _elements(derived.planned_time_text, "pt", "planned_stops", "not truncated", _PLANNED_COLUMNS),
    "snaps": (
        _select(
            _SNAP_REST,
            f"({_select(_SNAP_FIRST, _numbered('stops', derived.SNAPSHOTS), True)})",
            True,
        )
    ),
    "change_stops": (
        f"select *, {_path('timetable_changes', 'change_period', 'snap_folder')} as path, "
        "(row_number() over (partition by part, change_period, snap_folder, u order by e) - 1)::int as pos from snaps"
    ),
    "change_el": _elements(
        derived.changed_time_text, "ct", "change_stops", "not change_truncated", _CHANGE_COLUMNS
    ),
    "lake_tt": (
        "select sid, xml_station as station, case tag when 'AR' then 'arrival' else 'departure' end as event_type, "
        "case when has_tl then c else '' end as category, case when has_tl then n else '' end as number, "
        f"case when has_tl then o else '' end as owner, l as line, {lake_time('pt')} as planned_time, "
        "pp as planned_platform, ppth as planned_path from planned_el where idx = 0"
    ),
    "lake_ch": (
        "select sid, name as station, case tag when 'AR' then 'arrival' else 'departure' end as event_type, "
        f"coalesce(cl, '') as line, {lake_time('ct')} as changed_time, {lake_time('clt')} as cancellation_time, "
        "coalesce(cs, '') as cancellation_status, coalesce(cpp, '') as planned_platform, "
        "coalesce(cpth, '') as changed_path from change_el where idx = 0"
    ),
    "movements": (
        "select period, substr(folder, 1, 6) as day, path as file_path, pos as stop_pos, idx as event_pos, "
        "coalesce(xml_station, '') as xml_station, replace(file_station, '_', ' ') as file_station, sid, "
        f"{train_fact('c', 'n', 'o')} as train_id, tag as event_type, status as event_status, "
        f"{warehouse_time('pt')} as planned_time, pp as planned_platform, l as line_number, ppth as planned_path, "
        "pdest as planned_destination from planned_el where sid is not null and has_tl"
    ),
    "wh_changes": (
        "select change_period as period, substr(snap_folder, 1, 6) as day, snap as snapshot_ts, path as file_path, "
        f"pos as stop_pos, idx as event_pos, sid, tag as event_type, {warehouse_time('ct')} as actual_time, "
        "coalesce(nullif(cp, ''), cl) as actual_platform, cpth as actual_path, "
        f"{cancelled('cs')} as is_cancelled, {warehouse_time('clt')} as cancellation_time, "
        f"{disrupted('dis')} as has_disruption from change_el where sid is not null"
    ),
    "newest": (
        "select period, day, sid, event_type, actual_time, actual_platform, actual_path, is_cancelled, "
        "cancellation_time, has_disruption from wh_changes qualify row_number() over (partition by period, day, sid, "
        "event_type order by snapshot_ts desc, file_path desc, stop_pos desc, event_pos desc) = 1"
    ),
    "files": (
        "select distinct 'timetables' as feed, period, folder, file_station, path from planned_stops union all "
        "select distinct 'timetable_changes', change_period, snap_folder, file_station, path from change_stops"
    ),
    "folder_times": f"select distinct feed, {lake_time('folder')} as timestamp from files",
    "train_rows": (
        "select path as file_path, pos as stop_pos, c as category, n as number, o as operator, t as type, f as class "
        "from planned_stops where not truncated and has_tl and coalesce(c, '') <> '' and coalesce(n, '') <> ''"
    ),
    "trains": (
        "select train_id, number as train_number, operator as operator_code, "
        f"{label('operator', OPERATOR_NAMES)} as operator_name, category as train_category, "
        f"{label('category', CATEGORY_LABELS)} as train_category_desc, class as train_class, "
        f"{label('class', CLASS_LABELS)} as train_class_desc, type as train_type, "
        f"{label('type', TYPE_LABELS)} as train_type_desc from ("
        f"select file_path, stop_pos, {train_dim('category', 'number', 'operator')} as train_id, "
        f"{trim_null('category')} as category, {trim_null('number')} as number, {trim_null('operator')} as operator, "
        f"{trim_null('type')} as type, {trim_null('class')} as class from train_rows) "
        "qualify row_number() over (partition by train_id order by file_path, stop_pos) = 1"
    ),
    "dim_train": f"select {bucketed_key('train_id', 'train_id')} as train_key, * from trains",
    "all_trains": (
        "with missing as (select distinct m.train_id from movements m where not exists "
        "(select 1 from dim_train d where d.train_id = m.train_id)), "
        "numbered as (select train_id, substr(md5(train_id), 1, 3) as b, row_number() over (partition by "
        "substr(md5(train_id), 1, 3) order by train_id) as rn from missing), "
        "used as (select train_key >> 40 as b, max(train_key) as top from dim_train group by 1) "
        "select * from dim_train union all by name select (coalesce(used.top, ('0x' || numbered.b)::bigint << 40) "
        "+ rn)::bigint as train_key, train_id from numbered left join used on used.b = ('0x' || numbered.b)::bigint"
    ),
    "all_times": (
        "select timestamp from folder_times where timestamp is not null union "
        "select planned_time from movements where planned_time is not null"
    ),
    "station_raw": _select(derived.station_columns(), "supplier"),
    "stations": f"select {_STATION_ROW} from station_raw",
    "dim_station": (
        "select "
        + bucketed_key(
            "station_number::varchar || '|' || station_name || '|' || coalesce(eva_number::varchar, '')",
            "station_number",
        )
        + " as station_key, * from stations"
    ),
    "name_map": (
        f"select {normalized('station_name')} as normalized, station_key, station_name from dim_station "
        f"qualify row_number() over (partition by {normalized('station_name')} order by station_key desc) = 1"
    ),
    "names": (
        f"select *, {normalized('xml_station')} as xml_norm, {normalized('file_station')} as file_norm "
        "from (select distinct xml_station, file_station from movements)"
    ),
    "exact": (
        "select names.*, coalesce(x.station_key, f.station_key) as station_key, "
        "case when x.station_key is not null then x.station_name else f.station_name end as station_name from names "
        "left join name_map x on x.normalized = xml_norm left join name_map f on f.normalized = file_norm"
    ),
    "scored": (
        f"select name, station_key, station_name, {ratio('name', 'normalized')} as score from "
        "(select xml_norm as name from names union select file_norm from names) cross join name_map"
    ),
    "fuzzy": (
        "select * from scored where score >= 85 "
        "qualify row_number() over (partition by name order by score desc, station_key) = 1"
    ),
    "resolved": (
        "select e.xml_station, e.file_station, coalesce(e.station_key, x.station_key, f.station_key) as station_key, "
        "coalesce(e.station_name, x.station_name, f.station_name) as station_name, "
        "case when e.station_key is not null then 'exact' when coalesce(x.station_key, f.station_key) is not null "
        "then 'fuzzy' end as match "
        "from exact e left join fuzzy x on x.name = e.xml_norm left join fuzzy f on f.name = e.file_norm"
    ),
    "fact": (
        "select md5(file_path || '|' || stop_pos || '|' || m.event_type || '|' || event_pos) as movement_id, "
        "r.station_key, t.train_key, strftime(m.planned_time, '%Y%m%d%H%M')::bigint as time_key, m.event_type, "
        "m.event_status, m.planned_time, n.actual_time, m.planned_platform, n.actual_platform, "
        "floor(date_diff('second', m.planned_time, n.actual_time) / 60.0)::int as delay_minutes, "
        "coalesce(n.is_cancelled, false) as is_cancelled, n.cancellation_time, false as is_hidden, "
        "coalesce(n.has_disruption, false) as has_disruption, null::int as distance_change, m.line_number, "
        "m.planned_path, n.actual_path, m.planned_destination, m.sid "
        "from movements m join resolved r using (xml_station, file_station) join all_trains t using (train_id) "
        "left join newest n on n.period = m.period and n.day = m.day and n.sid = m.sid and n.event_type = m.event_type "
        "where r.station_key is not null"
    ),
    "tt": _select(derived.lake_planned_columns(DUCKDB), "events"),
    "ch": _select(
        derived.lake_change_columns(DUCKDB),
        _numbered("events", derived.LAKE_SNAPSHOTS),
    ),
    "pairs": (
        "select *, (epoch(ch.changed_time) - epoch(tt.planned_time)) / 60 as delay_minutes "
        "from tt join ch using (sid, station, event_type)"
    ),
    "points": _select(derived.point_columns(), "customer"),
}


def _needs(sql: str) -> list[str]:
    words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in sql).split())
    return [name for name in TABLES if name in words]


def with_tables(sql: str) -> str:
    """``sql`` with the shared tables it names, directly or not, in front."""
    needed, todo = set(), _needs(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(n for n in _needs(TABLES[name]) if n != name)
    ctes = ", ".join(f"{name} as materialized ({TABLES[name]})" for name in TABLES if name in needed)
    return f"with {ctes} {sql}" if ctes else sql


# ---- queries ----------------------------------------------------------------

_STATION = f"'{catalog.STATION}'"
_START, _END = (f"timestamp '{t.isoformat(sep=' ')}'" for t in catalog.PERIOD)
_LAT, _LON = catalog.POINT
_MORNING = 'as "morning_avg_departures (7-9)"'
_EVENING = 'as "evening_avg_departures (17-19)"'


def _peak(first: int, last: int, alias: str) -> str:
    return (
        f"select station, avg(n) {alias} from (select station, cast(planned_time as date) as d, count(*) as n from tt "
        f"where event_type = 'departure' and hour(planned_time) >= {first} and hour(planned_time) < {last} "
        "group by all) group by station"
    )


_PEAKS = (
    f"select * from ({_peak(7, 9, _MORNING)}) full outer join ({_peak(17, 19, _EVENING)}) using (station)"
)
_DAILY = (
    "select cast(planned_time as date) as date, avg(delay_minutes) as avg_delay from pairs "
    f"where station = {_STATION} and planned_time is not null and cancellation_time is not null group by 1"
)
_SNAPS_WITH = "select e, k, {} from snaps"
_STOPS_WITH = "select e, {} from stops"
_PT = derived.planned_time_text(DUCKDB, "AR", 0)

SQL = {
    "xml_timetable_scan": "select * from lake_tt",
    "xml_change_scan": "select * from lake_ch",
    "file_inventory": (
        f"select feed, period, folder, {lake_time('folder')} as snapshot_ts, replace(file_station, '_', ' ') as "
        "file_station, path as file_path from files"
    ),
    "change_period_semi_join": (
        "select period, path as file_path from files where feed = 'timetable_changes' and period in "
        "(select period from files where feed = 'timetables')"
    ),
    "archive_member_scan": "select * from lake_tt",
    "snapshot_time_scan": "select distinct timestamp from folder_times where timestamp is not null",
    "station_json_scan": (
        "select number, name, category, price_category, city, "
        "case when k % 10 = 3 then null when k % 10 = 4 then 0 else 1 end::int as n_evas from station_raw"
    ),
    "train_scan": "select * from train_rows",
    "warehouse_change_scan": "select * from wh_changes",
    "warehouse_planned_scan": "select * from movements",
    "parquet_scan": "select event_id, ts, event_type from events",
    "station_name_map": "select * from name_map",
    "parquet_roundtrip": "select * from tt",
    "partitioned_roundtrip": "select *, cast(planned_time as date) as service_date from tt",
    "dim_time_upsert": (
        f"select {time_row('timestamp')} from (select distinct timestamp from folder_times where timestamp is not null)"
    ),
    "dim_train_upsert": None,
    "dim_station_load": "select * from dim_station",
    "fact_build": "select * from fact",
    "warehouse_two_drops": (
        "select f.* exclude (station_key, train_key), s.station_number, s.station_name, s.eva_number, t.train_id "
        "from fact f left join dim_station s using (station_key) left join all_trains t using (train_key)"
    ),
    "warehouse_overlapping_loads": None,
    "surrogate_key": "select train_id, train_key from dim_train",
    "inferred_train_member": "select * from all_trains",
    "inferred_time_member": f"select {time_row('timestamp')} from all_times",
    "fk_violations": (
        "select 'station_key' as foreign_key, count(*) as n_violations from fact where station_key is not null and "
        "station_key not in (select station_key from dim_station) union all "
        "select 'train_key', count(*) from fact where train_key is not null and "
        "train_key not in (select train_key from all_trains) union all "
        "select 'time_key', count(*) from fact where time_key is not null and "
        f"time_key not in (select {minute_number('timestamp')} from all_times)"
    ),
    "fk_orphans": (
        "select 'train_key' as foreign_key, count(*) as n_violations from fact where train_key is not null and "
        "train_key not in (select train_key from dim_train) union all "
        "select 'time_key', count(*) from fact where time_key is not null and "
        f"time_key not in (select {minute_number('timestamp')} from folder_times where timestamp is not null)"
    ),
    "load_counts": (
        "select 'dim_station' as table_name, count(*) as n_rows from dim_station union all "
        "select 'dim_train', count(*) from all_trains union all select 'dim_time', count(*) from all_times union all "
        "select 'fact_train_movement', count(*) from fact"
    ),
    "station_flatten": "select * from stations",
    "array_first": "select number, eva as eva_number, ril as ril100_identifier from station_raw",
    "parse_time_lake": f"select e, text, {lake_time('text')} as parsed from ({_STOPS_WITH.format(_PT + ' as text')})",
    "parse_time_warehouse": (
        f"select e, text, {warehouse_time('text')} as parsed from ({_STOPS_WITH.format(_PT + ' as text')})"
    ),
    "parse_time_folder": (
        f"select e, text, {lake_time('text')} as parsed from "
        f"({_STOPS_WITH.format(derived.folder_text(DUCKDB) + ' as text')})"
    ),
    "parse_time_dayfirst": (
        f"select e, planned_time, {dayfirst_time('planned_time')} as parsed from "
        f"({_STOPS_WITH.format(derived.dayfirst_text(DUCKDB) + ' as planned_time')})"
    ),
    "delay_fractional": (
        f"select event_id, (epoch(actual) - epoch(planned)) / 60 as delay_minutes "
        f"from ({_select(derived.delay_columns(DUCKDB), 'events')})"
    ),
    "delay_floor": (
        f"select event_id, floor((epoch(actual) - epoch(planned)) / 60)::int as delay_minutes "
        f"from ({_select(derived.delay_columns(DUCKDB), 'events')})"
    ),
    "date_part": "select sid, cast(planned_time as date) as date from tt",
    "hour_part": "select sid, hour(planned_time)::int as hour from tt",
    "calendar_decompose": f"select event_id, {calendar('ts')} from events",
    "trim_to_null": _STOPS_WITH.format(
        f"{trim_null('c')} as category, {trim_null('n')} as number, {trim_null('o')} as operator, "
        f"nullif(t, '') as type"
    ),
    "train_id_dim": _STOPS_WITH.format(f"{train_dim('c', 'n', 'o')} as train_id"),
    "train_id_fact": _STOPS_WITH.format(f"{train_fact('c', 'n', 'o')} as train_id"),
    "code_labels": _STOPS_WITH.format(
        f"{label('o', OPERATOR_NAMES)} as operator_name, {label('c', CATEGORY_LABELS)} as category_desc, "
        f"{label('f', CLASS_LABELS)} as class_desc, {label('t', TYPE_LABELS)} as type_desc"
    ),
    "cancelled_flag": _SNAPS_WITH.format(f"{cancelled('cs')} as is_cancelled"),
    "disruption_flag": _SNAPS_WITH.format(f"{disrupted('dis')} as has_disruption"),
    "actual_platform": _SNAPS_WITH.format(
        "coalesce(nullif(cp, ''), cl) as actual_platform, nullif(cp, '') as changed_platform"
    ),
    "station_from_filename": (
        "select path as file_path, replace(file_station, '_', ' ') as file_station from files where feed = 'timetables'"
    ),
    "normalize_station": _STOPS_WITH.format(
        f"{normalized('name')} as name_norm, {normalized('xml_station')} as xml_norm, "
        f"{normalized('file_station')} as file_norm"
    ),
    "indel_ratio": (
        f"select name, xml_station, file_station, {ratio('name', 'x')} as xml_ratio, "
        f"{ratio('name', 'file_station')} as file_ratio from "
        "(select distinct name, xml_station, file_station, coalesce(xml_station, '') as x from stops)"
    ),
    "haversine_distance": (
        f"select point_id, round({haversine(_LAT, _LON, 'lat', 'lon')}, 6) as distance_km from points"
    ),
    "filter_station": f"select sid, station, planned_time from tt where station = {_STATION}",
    "filter_not_null": (
        "select sid, event_type, planned_time, cancellation_time from pairs "
        "where planned_time is not null and cancellation_time is not null"
    ),
    "filter_peak_hours": (
        "select sid, station, planned_time from tt where hour(planned_time) in (7, 8, 17, 18)"
    ),
    "unresolved_stations": (
        "select xml_station, file_station, count(*) as n_rows from movements join resolved "
        "using (xml_station, file_station) where station_key is null group by all"
    ),
    "join_planned_changes": (
        "select sid, station, event_type, tt.line, ch.line as changed_line, tt.planned_platform, "
        "ch.planned_platform as changed_planned_platform, planned_time, changed_time, cancellation_time, "
        "cancellation_status, (epoch(changed_time) - epoch(planned_time)) / 60 as delay_minutes "
        "from tt join ch using (sid, station, event_type)"
    ),
    "peak_outer_join": _PEAKS,
    "left_latest_change": (
        "select m.file_path, m.stop_pos, m.event_type, m.event_pos, m.sid, n.actual_time, n.actual_platform, "
        "n.actual_path, coalesce(n.is_cancelled, false) as is_cancelled, n.cancellation_time, "
        "coalesce(n.has_disruption, false) as has_disruption from movements m left join newest n "
        "using (period, day, sid, event_type)"
    ),
    "station_exact_match": "select xml_station, file_station, xml_norm, file_norm, station_key, station_name from exact",
    "station_fuzzy_match": "select name, station_key, station_name, score from fuzzy",
    "station_resolution": "select * from resolved",
    "anti_join_new_members": (
        "select distinct timestamp from folder_times where feed = 'timetable_changes' and timestamp not in "
        "(select timestamp from folder_times where feed = 'timetables')"
    ),
    "movement_messages": (
        f"select b.movement_id, b.sid, b.event_type, message_sequence, b.message_key, message_code, priority from "
        f"(select sid, event_type, {', '.join(f'{s} as {n}' for n, s in derived.bridge_columns().items())} from "
        "(select *, md5(file_path || '|' || stop_pos || '|' || event_type || '|' || event_pos) as movement_id "
        f"from {_numbered('movements', derived.MESSAGES)})) b join "
        f"({_select(derived.message_columns(DUCKDB), 'orders')}) d using (message_key)"
    ),
    "avg_daily_delay": _DAILY,
    "overall_avg_delay": f"select avg(avg_delay) as overall_avg from ({_DAILY})",
    "avg_daily_delay_all_stations": (
        "select station, cast(planned_time as date) as date, "
        "avg((epoch(changed_time) - epoch(planned_time)) / 60) as avg_delay from tt join "
        "(select * from ch qualify row_number() over (partition by sid, station, event_type "
        "order by snapshot_ts desc) = 1) using (sid, station, event_type) where planned_time is not null group by 1, 2"
    ),
    "peak_morning_avg": _peak(7, 9, _MORNING),
    "peak_evening_avg": _peak(17, 19, _EVENING),
    "peak_hours_report": _PEAKS,
    "distinct_trains": "select * from trains",
    "latest_change": "select * from newest",
    "distinct_timestamps": "select timestamp from folder_times where feed = 'timetable_changes'",
    "avg_delay_per_station": (
        "select station_name, avg(delay_minutes) as avg_delay from fact join dim_station using (station_key) group by 1"
    ),
    "avg_delay_one_station": (
        "select station_name, avg(delay_minutes) as avg_delay from fact join dim_station using (station_key) "
        f"where station_name = {_STATION} group by 1"
    ),
    "cancelled_in_period": (
        f"select count(*) as n_cancelled from fact where is_cancelled and planned_time >= {_START} "
        f"and planned_time < {_END}"
    ),
    "files_per_period": (
        "select feed, period, count(*)::bigint as n_files from files where period in "
        "(select period from files where feed = 'timetables') group by grouping sets ((feed, period), (feed))"
    ),
    "nearest_station": (
        f"select station_key, station_name, round({haversine(_LAT, _LON, 'latitude', 'longitude')}, 6) as distance_km "
        f"from dim_station where latitude is not null order by {haversine(_LAT, _LON, 'latitude', 'longitude')}, "
        "station_key limit 1"
    ),
    "nearest_station_batch": (
        "select point_id, station_key, station_name, round(d, 6) as distance_km from (select point_id, station_key, "
        f"station_name, {haversine('lat', 'lon', 'latitude', 'longitude')} as d from points cross join dim_station "
        "where latitude is not null) qualify row_number() over (partition by point_id order by d, station_key) = 1"
    ),
    "union_snapshot_times": "select distinct timestamp from folder_times where timestamp is not null",
    "union_all_events": (
        "select 'timetables' as feed, sid, station, event_type, line, planned_platform from lake_tt union all "
        "select 'timetable_changes', sid, station, event_type, line, planned_platform from lake_ch"
    ),
    "stream_xml_ingest": "select * from lake_tt",
    "stream_two_runs": "select * from lake_tt",
    "landed_documents": "select * from lake_tt",
    "corrupt_files": "select distinct path as file_path from planned_stops where truncated",
    "logged_counts": (
        "select 'timetables' as table_name, (select count(*) from files where feed = 'timetables') as n_files, "
        "(select count(*) from lake_tt) as n_rows, (select count(distinct path) from planned_stops where truncated) as n_corrupt"
    ),
    "landed_inventory": (
        "select period, folder, regexp_extract(path, '[^/]*$') as file_name, 'landed' as state from files where feed = 'timetables'"
    ),
    "lake_two_drops": "select * from lake_tt",
    "lake_build": (
        "select 'timetables' as table_name, count(*) as n_rows from lake_tt union all "
        "select 'timetable_changes', count(*) from change_el where idx = 0 and change_period in "
        "(select period from planned_stops)"
    ),
}

# Existing members are the lake table's trains; the feed's new ones continue
# the numbering of their bucket.
SQL["dim_train_upsert"] = (
    "with old as (select " + bucketed_key("train_id", "train_id") + " as train_key, train_id, number as train_number, "
    f"owner as operator_code, {label('owner', OPERATOR_NAMES)} as operator_name, category as train_category, "
    f"{label('category', CATEGORY_LABELS)} as train_category_desc, null::varchar as train_class, "
    "null::varchar as train_class_desc, null::varchar as train_type, null::varchar as train_type_desc from "
    f"(select distinct category, number, owner, {train_dim('category', 'number', 'owner')} as train_id from tt)), "
    "fresh as (select trains.*, substr(md5(train_id), 1, 3) as b, row_number() over (partition by "
    "substr(md5(train_id), 1, 3) order by train_id) as rn from trains where train_id not in (select train_id from old)), "
    "used as (select train_key >> 40 as b, max(train_key) as top from old group by 1) "
    "select * from old union all by name select (coalesce(used.top, ('0x' || fresh.b)::bigint << 40) + rn)::bigint as "
    "train_key, fresh.* exclude (b, rn) from fresh left join used on used.b = ('0x' || fresh.b)::bigint"
)

# Loads that run at the same time leave what they leave one after the other.
SQL["warehouse_overlapping_loads"] = SQL["warehouse_two_drops"]


def oracle_queries() -> dict[str, str]:
    return {name: _assemble(sql) for name, sql in SQL.items()}


def _assemble(sql: str) -> str:
    # a query with CTEs of its own becomes one more level
    return with_tables(f"select * from ({sql})" if sql.startswith("with ") else sql)
