"""The registered queries again, as SQL over the same tables.

Written on its own, from the meaning of each operator: only column lists are shared
with the Spark side.
"""

from __future__ import annotations

import re

from regflow.catalog import adapter as a
from regflow.schema import (
    FUEL_HEADERS,
    GRAINS,
    LEGACY_FUEL_HEADERS,
    MEASURES,
    OEM,
    RTO,
    STATE,
    STATES,
    Grain,
    snake,
)

_STATES = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
_PRESENT = {snake(h) for h in a.FUELS.values()} | {"total"}
_CELLS = [*a.FUELS.values(), a.NEW_HEADER]


def _q(name: str) -> str:
    return f'"{name}"'


def _columns(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{_q(n)}" for n in names)


def _folder(state: str) -> str:
    return f"rtrim(regexp_replace({state}, '[^a-zA-Z\\s]', ' ', 'g'))"


def _class_key(name: str) -> str:
    return f"trim(regexp_replace({name}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def _label(date: str) -> str:
    return f"upper(strftime({date}, '%b'))"


# Tables shared by the queries

CTES: dict[str, str] = {
    "reg": f"""
        SELECT s_suppkey, s_name, s_acctbal, n_nationkey, p_type, p_brand,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O'
                         AND year(l_shipdate) >= {a.NEW_HEADER_YEAR} THEN 'XX'
                    ELSE l_returnflag || l_linestatus END AS fuel,
               l_extendedprice AS price
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "state_list": f"SELECT unnest({_STATES}) AS state",
    "offices": f"""
        SELECT s_suppkey, n_regionkey, {_STATES}[n_nationkey + 1] AS state,
               replace(s_name, '#', '/') || CASE WHEN s_acctbal >= 0
                   THEN ' - R' || s_suppkey || '( 01-JAN-2020 )' ELSE '' END AS office_label,
               replace(s_name, '#', '') || CASE WHEN s_acctbal >= 0
                   THEN '_R' || s_suppkey ELSE '' END AS folder,
               s_acctbal >= 0 AS good
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "whole_mapping": """
        SELECT DISTINCT 'CLASS-' || p_type || '(LMV)' AS "Vehicle Class",
               CASE p_type WHEN 'LARGE' THEN 'Goods' WHEN 'MEDIUM' THEN NULL
                    ELSE 'Passenger' END AS "Vehicle Type",
               CASE p_type WHEN 'LARGE' THEN 'Truck' WHEN 'SMALL' THEN ' '
                    ELSE 'Car' END AS "Vehicle Category",
               CASE p_type WHEN 'ECONOMY' THEN '' ELSE 'Private' END AS "Vehicle Use Type"
        FROM part""",
    "mapping": """SELECT * FROM whole_mapping WHERE "Vehicle Class" <> 'CLASS-PROMO(LMV)'""",
    "districts": """
        SELECT 'r' || s_suppkey || ' ' AS rto_code,
               unnest(CASE WHEN n_regionkey = 0 THEN ['North', 'South']
                           ELSE ['District ' || n_regionkey] END) AS district
        FROM offices WHERE n_regionkey < 4""",
    "months": """
        SELECT CAST(unnest(generate_series(date_trunc('month', min(l_shipdate)),
                    date_trunc('month', max(l_shipdate)), INTERVAL 1 MONTH)) AS DATE) AS month_start
        FROM lineitem""",
}


def _raw(grain: Grain, pick: str) -> str:
    """Report rows with whole-number cells and their place in the tree."""
    places = {
        "state": (f"{_folder('state')}", ""),
        "rto": (f"{_folder('state')}", "folder"),
        "oem": (f"{_folder('state')}", _class_key("'CLASS-' || p_type || '(LMV)'")),
    }
    state, inner = places[grain.name]
    label = "p_brand" if grain is OEM else "'CLASS-' || p_type || '(LMV)'"
    keys = {"state": "", "rto": ", s_suppkey", "oem": ", p_brand"}[grain.name]
    codes = [*a.FUELS, "XX"]
    cells = ", ".join(
        f"CAST(floor({pick}(CASE WHEN fuel = '{c}' THEN price END)) AS BIGINT) AS {_q(h)}"
        for c, h in zip(codes, _CELLS)
    )
    joined = "JOIN offices USING (s_suppkey)" if grain is RTO else ""
    placed = "" if grain is RTO else f"{_STATES}[n_nationkey + 1] AS state, "
    total = " + ".join(f"coalesce({_q(h)}, 0)" for h in _CELLS)
    shown = ", ".join(f"format('{{:,}}', {_q(h)}) AS {_q(h)}" for h in _CELLS)
    path = " || '/' || ".join(
        [
            f"'reports/{grain.name}'",
            state,
            *([inner] if inner else []),
            "strftime(month_start, '%Y')",
            _label("month_start"),
            "'reportTable.xlsx'",
        ]
    )
    return f"""
        SELECT {path} AS path, {state} AS state_dir, {inner or "''"} AS inner_dir, month_start,
               {label} AS "Unnamed: 1", {shown}, format('{{:,}}', {total}) AS "Unnamed: 38"
        FROM (SELECT {placed}p_type, month_start{keys}, {cells}
              FROM reg GROUP BY n_nationkey, p_type, month_start{keys}) {joined}"""


def _rto_name(folder: str) -> str:
    return f"CASE WHEN {folder} LIKE '%\\_%' ESCAPE '\\' THEN regexp_replace({folder}, '_[^_]*$', '') ELSE {folder} END"


def _rto_code(folder: str) -> str:
    return f"CASE WHEN {folder} LIKE '%\\_%' ESCAPE '\\' THEN regexp_extract({folder}, '_([^_]*)$', 1) ELSE '' END"


_SPELLED = """CASE state_dir WHEN 'Andaman   Nicobar Island' THEN 'Andaman and Nicobar'
                WHEN 'UT of DNH and DD' THEN 'Dadara and Nagar Havelli' ELSE state_dir END"""


def _others(name: str) -> str:
    return f"coalesce(nullif({_q(name)}, ''), 'Others')"


def _mapped(grain: Grain) -> str:
    """Join condition to the mapping."""
    if grain is OEM:
        return f"inner_dir = {_class_key('"Vehicle Class"')}"
    return '"Unnamed: 1" IS NOT DISTINCT FROM "Vehicle Class"'


def _prep(grain: Grain, raw: str, only_present: bool = False, raw_dims: bool = False) -> str:
    dims = {h: _q(h) if raw_dims else _others(h) for h in
            ("Vehicle Type", "Vehicle Category", "Vehicle Use Type")}
    lead = {
        "year": "strftime(month_start, '%Y')",
        "month": _label("month_start") if raw_dims else "CAST(month(month_start) AS INTEGER)",
        "day": "1",
        "date": f"'1/' || {_label('month_start')} || '/' || strftime(month_start, '%Y')"
        if raw_dims else "strftime(month_start, '%d/%m/%Y')",
        "state": "state_dir" if raw_dims else _SPELLED,
        "rto_name": _rto_name("inner_dir"),
        "rto_code": _rto_code("inner_dir"),
        "vehicle_type": dims["Vehicle Type"],
        "vehicle_category": dims["Vehicle Category"],
        "vehicle_use_type": dims["Vehicle Use Type"],
        "vehicle_class": "inner_dir" if grain is OEM else '"Unnamed: 1"',
        "maker": '"Unnamed: 1"',
    }
    parts = [f"{lead[c]} AS {_q(c)}" for c in grain.lead_columns]
    for header, name in zip([*FUEL_HEADERS, "Unnamed: 38"], MEASURES):
        if name in _PRESENT:
            parts.append(f"{_q(header)} AS {_q(name)}")
        elif not only_present:
            parts.append(f"CAST(NULL AS VARCHAR) AS {_q(name)}")
    return f"SELECT {', '.join(parts)} FROM {raw} LEFT JOIN mapping ON {_mapped(grain)}"


def _as_text(grain: Grain, prep: str, where: str = "", lower_class: bool = False) -> str:
    parts = []
    for c in grain.columns:
        value = f"CAST({_q(c)} AS VARCHAR)"
        if lower_class and c == "vehicle_class":
            value = f"lower({value})"
        parts.append(f"nullif({value}, '') AS {_q(c)}")
    return f"SELECT {', '.join(parts)} FROM {prep} {where}"


def _equal(keys, left: str, right: str) -> str:
    return " AND ".join(f"lower(rtrim({left}.{_q(k)})) = lower(rtrim({right}.{_q(k)}))" for k in keys)


def _curated(grain: Grain, source: str) -> str:
    parts = [f"CAST({c} AS INTEGER) AS {c}" for c in ("year", "month", "day")]
    parts.append("CAST(strptime(date, '%d/%m/%Y') AS DATE) AS date")
    for column, name, width in grain.curated_text:
        parts.append(f"left({'f.' if column == 'rto_code' else ''}{column}, {width}) AS {name}")
    parts += [f"CAST(replace({m}, ',', '') AS INTEGER) AS {m}" for m in MEASURES]
    joined = (
        "LEFT JOIN districts d ON lower(rtrim(f.rto_code)) = lower(rtrim(d.rto_code))"
        if grain is RTO else ""
    )
    return f"SELECT {', '.join(parts)} FROM {source} f {joined}"


def _curated_upsert(grain: Grain, fresh: str) -> str:
    """Curated facts without the keys of `fresh`, plus `fresh`."""
    keys = [k for k in grain.curated_key if k != "date"]
    same = f"n.date = c.date AND {_equal(keys, 'c', 'n')}"
    return f"""SELECT * FROM curated_{grain.name} c
        WHERE NOT EXISTS (SELECT 1 FROM {fresh} n WHERE {same})
        UNION ALL SELECT * FROM {fresh}"""


def _kept(grain: Grain, stage: str) -> str:
    return f"""SELECT * FROM fact_{grain.name} f WHERE NOT EXISTS
        (SELECT 1 FROM {stage} s WHERE {_equal(grain.load_key, 'f', 's')})"""


def _legacy(grain: Grain) -> str:
    kept = [c for c in grain.columns if c not in a.LEGACY_ABSENT]
    return f"""SELECT {_columns(kept)}, '  ' || coalesce(electric_bov, '') || ' ' AS electric_vehicles,
        CAST(NULL AS VARCHAR) AS ethanol,
        CAST(strptime(date, '%d/%m/%Y') AS TIMESTAMP) AS insert_date FROM fact_{grain.name}"""


def _migrated(grain: Grain) -> str:
    parts = [
        f"CAST(NULL AS VARCHAR) AS {c}" if c in a.LEGACY_ABSENT else _q(c) for c in grain.columns
    ]
    return f"SELECT {', '.join(parts)} FROM legacy_{grain.name}"


def _copies(grain: Grain) -> str:
    keys = _columns(grain.backfill_key)
    return f"""SELECT {keys}, '  ' || coalesce(electric_bov, '') || ' ' AS electric_vehicles
        FROM fact_{grain.name} UNION ALL
        SELECT {keys}, '  ' || coalesce(electric_bov, '') || ' ' FROM rescraped_{grain.name}"""


def _backfilled(grain: Grain) -> str:
    return f"""
        SELECT {_columns(grain.backfill_key, 't.')},
               coalesce(t.electric_bov, b.value) AS electric_bov,
               t.electric_bov IS NULL AND b.value IS NOT NULL AS backfilled
        FROM (SELECT * REPLACE (CASE WHEN petrol IS NULL THEN '7' END AS electric_bov)
              FROM fact_{grain.name}) t
        LEFT JOIN (SELECT {', '.join(f'lower(rtrim({k})) AS {_q(k)}' for k in grain.backfill_key)},
                          min(trim(electric_vehicles)) AS value
                   FROM copies_{grain.name} WHERE trim(electric_vehicles) <> '' GROUP BY ALL) b
        ON {_equal(grain.backfill_key, 't', 'b')}"""


for _g in GRAINS.values():
    _n = _g.name
    CTES[f"raw_{_n}"] = _raw(_g, "max")
    CTES[f"rawmin_{_n}"] = _raw(_g, "min")
    CTES[f"prep_{_n}"] = _prep(_g, f"raw_{_n}")
    CTES[f"later_{_n}"] = (
        f"SELECT * FROM rawmin_{_n} WHERE month_start >= DATE '{a.RESCRAPE_FROM}'"
    )
    CTES[f"latest_{_n}"] = f"SELECT * FROM rawmin_{_n} WHERE month_start >= DATE '2001-10-01'"
    CTES[f"prep_later_{_n}"] = _prep(_g, f"later_{_n}")
    CTES[f"prep_latest_{_n}"] = _prep(_g, f"latest_{_n}")
    CTES[f"prep_min_{_n}"] = _prep(_g, f"rawmin_{_n}")
    CTES[f"fact_{_n}"] = _as_text(_g, f"prep_{_n}")
    CTES[f"rescraped_{_n}"] = _as_text(_g, f"prep_min_{_n}")
    CTES[f"stage_{_n}"] = _as_text(_g, f"prep_later_{_n}", lower_class=True)
    CTES[f"run_{_n}"] = _as_text(_g, f"prep_latest_{_n}")
    CTES[f"upserted_{_n}"] = f"{_kept(_g, f'stage_{_n}')} UNION ALL SELECT * FROM stage_{_n}"
    CTES[f"run_fact_{_n}"] = f"{_kept(_g, f'run_{_n}')} UNION ALL SELECT * FROM run_{_n}"
    CTES[f"curated_{_n}"] = _curated(_g, f"fact_{_n}")
    _window = "WHERE strptime(date, '%d/%m/%Y') >= DATE '2001-10-01'"
    CTES[f"window_{_n}"] = f"SELECT * FROM stage_{_n} {_window}"
    CTES[f"fresh_{_n}"] = _curated(_g, f"window_{_n}")
    CTES[f"run_window_{_n}"] = f"SELECT * FROM run_fact_{_n} {_window}"
    CTES[f"run_fresh_{_n}"] = _curated(_g, f"run_window_{_n}")
    CTES[f"legacy_{_n}"] = _legacy(_g)
    CTES[f"migrated_{_n}"] = _migrated(_g)
    CTES[f"copies_{_n}"] = _copies(_g)
    CTES[f"filled_{_n}"] = _backfilled(_g)
    CTES[f"files_{_n}"] = (
        f'SELECT path, count("DIESEL") > 0 AS valid FROM raw_{_n} GROUP BY path'
    )

CTES["legacy_rows"] = """
    SELECT *, CASE WHEN year(month_start) < 1998 THEN 'Unnamed: 23' ELSE 'Unnamed: 26' END AS total_at
    FROM raw_state"""
CTES["grid_state"] = f"""
    SELECT state, month_start, {_label('month_start')} AS month,
           strftime(month_start, '%Y') AS year,
           'reports/state/' || {_folder('state')} || '/' || strftime(month_start, '%Y') || '/'
           || {_label('month_start')} || '/reportTable.xlsx' AS path
    FROM state_list, months"""
CTES["grid_oem"] = f"""
    SELECT state, vehicle_class, month_start, {_label('month_start')} AS month,
           strftime(month_start, '%Y') AS year,
           'reports/oem/' || {_folder('state')} || '/' || {_class_key('vehicle_class')} || '/'
           || strftime(month_start, '%Y') || '/' || {_label('month_start')}
           || '/reportTable.xlsx' AS path
    FROM state_list, months,
         (SELECT DISTINCT 'CLASS-' || p_type || '(LMV)' AS vehicle_class FROM part)"""
CTES["stored_oem"] = """
    SELECT path, state_dir, month_start, TRUE AS stored,
           row_number() OVER (PARTITION BY path ORDER BY "Unnamed: 1") - 1 AS position
    FROM raw_oem UNION ALL
    SELECT path, rtrim(regexp_replace(state, '[^a-zA-Z\\s]', ' ', 'g')), month_start, FALSE, NULL
    FROM grid_oem WHERE path NOT IN (SELECT path FROM raw_oem)"""
CTES["grid_rto"] = f"""
    SELECT state, office_label, month_start, {_label('month_start')} AS month,
           strftime(month_start, '%Y') AS year,
           CASE WHEN good THEN 'reports/rto/' || {_folder('state')} || '/' || folder || '/'
               || strftime(month_start, '%Y') || '/' || {_label('month_start')}
               || '/reportTable.xlsx' END AS path
    FROM offices JOIN state_list USING (state), months"""

SQL: dict[str, str] = {}

SQL["discover_state"] = """SELECT DISTINCT path, upper(strftime(month_start, '%b')) AS "Month",
    strftime(month_start, '%Y') AS "Year", state_dir AS "State" FROM raw_state"""
SQL["discover_rto"] = f"""SELECT DISTINCT path, upper(strftime(month_start, '%b')) AS "Month",
    strftime(month_start, '%Y') AS "Year", {_rto_name('inner_dir')} AS rto_name,
    {_rto_code('inner_dir')} AS rto_code, state_dir AS "State" FROM raw_rto"""
SQL["discover_oem"] = """SELECT DISTINCT path, upper(strftime(month_start, '%b')) AS "Month",
    strftime(month_start, '%Y') AS "Year", inner_dir AS "Vehicle Class", state_dir AS "State"
    FROM raw_oem"""
SQL["valid_workbooks"] = """SELECT path, count(*) > 1 AND contains(any_value(inner_dir), '_') AS valid
    FROM raw_rto GROUP BY path"""
SQL["read_workbooks"] = f"""
    SELECT path, row_no, "Unnamed: 1", {_columns(_CELLS)}, "Unnamed: 38" FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY path ORDER BY "Unnamed: 1") - 1 AS INTEGER)
                  AS row_no FROM raw_rto)"""
# An empty cell of a workbook is NULL.
SQL["mapping_dim"] = """SELECT * REPLACE (nullif("Vehicle Use Type", '') AS "Vehicle Use Type")
    FROM whole_mapping"""
SQL["mapping_dim_normalized"] = f"""SELECT * REPLACE ({_class_key('"Vehicle Class"')} AS "Vehicle Class")
    FROM whole_mapping"""
SQL["office_map_scan"] = "SELECT state, office_label FROM offices WHERE n_regionkey <> 4"
SQL["csv_stage_scan"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text,
    nullif(lang, '') AS lang, nullif(source, '') AS source, CAST(n_chars AS VARCHAR) AS n_chars
    FROM documents"""
SQL["csv_ranges_scan"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
    nullif(replace(text, '. ', '."' || chr(10)), '') AS text, nullif(lang, '') AS lang FROM documents"""
SQL["csv_monthly_sink"] = f"""SELECT {', '.join(f"nullif(CAST({_q(c)} AS VARCHAR), '') AS {_q(c)}" for c in RTO.columns)},
    'rto_level_ev_data_' || upper(strftime(make_date(CAST(year AS INTEGER), month, 1), '%b')) || '_'
    || year || '.csv' AS file FROM prep_min_rto"""
SQL["stage_load"] = "SELECT * FROM rescraped_rto"
SQL["archive_manifest"] = """
    SELECT p AS path, substr(p, length('reports/rto/') + 1) AS object_name FROM (
        SELECT DISTINCT unnest([path, replace(path, '.xlsx', ' (1).xlsx')]) AS p FROM raw_rto)"""
SQL["archive_csv_pick"] = """
    SELECT l_suppkey, min(CASE WHEN l_linestatus = 'O' AND year(l_shipdate) = 1996
                                    AND month(l_shipdate) = 1
                               THEN 'rto_level_ev_data_JAN_1996_' || l_returnflag || '.csv' END) AS csv_name
    FROM lineitem GROUP BY l_suppkey"""
SQL["archive_history_grid"] = """SELECT DISTINCT path, substr(path, length('reports/rto/') + 1) AS object_name
    FROM raw_rto WHERE year(month_start) BETWEEN 1996 AND 2000"""
SQL["tag_metadata"] = f"""
    SELECT path, "Unnamed: 1", "Unnamed: 38", upper(strftime(month_start, '%b')) AS "Month",
           strftime(month_start, '%Y') AS "Year", {_rto_name('inner_dir')} AS rto_name,
           {_rto_code('inner_dir')} AS rto_code, state_dir AS "State", 1 AS "Day",
           '1/' || upper(strftime(month_start, '%b')) || strftime(month_start, '/%Y') AS "Date"
    FROM raw_rto"""
SQL["fill_missing_columns"] = _prep(STATE, "raw_state", raw_dims=True)
_known = ", ".join(f"'{h}'" for h in OEM.rename_map)
SQL["unexpected_columns"] = f"""SELECT DISTINCT header FROM (
        SELECT unnest(map_keys(MAP {{'Unnamed: 1': 1, 'Unnamed: 38': 1,
                   {', '.join(f"'{h}': 1" for h in a.CELL_HEADERS if h != a.NEW_HEADER)}}})) AS header FROM raw_oem
        UNION ALL SELECT '{a.NEW_HEADER}' FROM raw_oem WHERE year(month_start) >= {a.NEW_HEADER_YEAR}
        UNION ALL SELECT 'REMARK ' || inner_dir FROM raw_oem WHERE month(month_start) = 12)
    WHERE header NOT IN ({_known})"""
_unused = [h for h in FUEL_HEADERS if h not in a.FUELS.values()]
CTES["drift_found"] = "SELECT DISTINCT path, inner_dir, month_start FROM raw_oem"
SQL["header_drift"] = f"""
    SELECT 'absent' AS kind, unnest([{', '.join(f"'{h}'" for h in _unused)}]) AS header, count(*) AS reports FROM drift_found
    UNION ALL SELECT 'unknown', '{a.NEW_HEADER}', count(*) FROM drift_found
        WHERE year(month_start) >= {a.NEW_HEADER_YEAR} HAVING count(*) > 0
    UNION ALL SELECT 'unknown', 'REMARK ' || inner_dir, count(*) FROM drift_found
        WHERE month(month_start) = 12 GROUP BY inner_dir"""
SQL["default_dimensions"] = f"""SELECT path, "Unnamed: 1", {_others('Vehicle Type')} AS "Vehicle Type",
    {_others('Vehicle Category')} AS "Vehicle Category", {_others('Vehicle Use Type')} AS "Vehicle Use Type"
    FROM raw_state LEFT JOIN mapping ON {_mapped(STATE)}"""
SQL["normalize_state"] = f"""SELECT path, "Unnamed: 1", {_SPELLED} AS "State" FROM raw_state"""
SQL["filter_states"] = """SELECT path, "Unnamed: 1", state_dir AS "State" FROM raw_rto
    WHERE state_dir IN ('Delhi', 'Goa', 'Kerala')"""
SQL["skip_empty_reports"] = """SELECT path, CAST(position AS INTEGER) AS row_no FROM stored_oem
    WHERE stored"""
SQL["incremental_window"] = """SELECT * FROM fact_rto
    WHERE strptime(date, '%d/%m/%Y') >= DATE '2001-10-01'"""
SQL["project_if_exists"] = "SELECT * FROM migrated_oem"
SQL["first_existing_timestamp"] = """SELECT date, state, vehicle_class, insert_date AS inserted_at
    FROM legacy_state"""
SQL["null_repair"] = """SELECT * REPLACE (CAST(NULL AS VARCHAR) AS electric_bov,
    CAST(NULL AS VARCHAR) AS ethanol_e100) FROM fact_state"""
for _n in ("rto", "oem"):
    SQL[f"null_repair_{_n}"] = SQL["null_repair"].replace("fact_state", f"fact_{_n}")


def _legacy_cells(names: dict[str, str], total: str) -> str:
    known = {"DIESEL", "PETROL", "PURE EV", "ELECTRIC(BOV)", "CNG ONLY"}
    zeros = {"PLUG-IN HYBRID EV", "PURE EV", "STRONG HYBRID EV"}
    parts = []
    for header, name in names.items():
        value = _q(header) if header in known else "CAST(NULL AS VARCHAR)"
        parts.append(f"{f'''coalesce({value}, '0')''' if header in zeros else value} AS {_q(name)}")
    return ", ".join([*parts, f'"Unnamed: 38" AS {_q(total)}'])


SQL["history_defaults"] = f"""SELECT path, 0 AS row_no, "Unnamed: 1",
    {_legacy_cells({h: h for h in LEGACY_FUEL_HEADERS}, 'Unnamed: 26')} FROM legacy_rows"""
_legacy_names = {h: snake(h) for h in LEGACY_FUEL_HEADERS} | {"ELECTRIC(BOV)": "electric_vehicles"}
SQL["history_state_preprocess"] = f"""
    SELECT strftime(month_start, '%Y') AS year, CAST(month(month_start) AS INTEGER) AS month, 1 AS day,
           strftime(month_start, '%d/%m/%Y') AS date, {_SPELLED} AS state,
           {_others('Vehicle Type')} AS vehicle_type, {_others('Vehicle Category')} AS vehicle_category,
           {_others('Vehicle Use Type')} AS vehicle_use_type, "Unnamed: 1" AS vehicle_class,
           {_legacy_cells(_legacy_names, 'total')}
    FROM legacy_rows LEFT JOIN mapping ON {_mapped(STATE)}"""
SQL["join_district"] = """
    SELECT date, state, f.rto_code, rto_name, vehicle_class, district, total FROM fact_rto f
    LEFT JOIN districts d ON lower(rtrim(f.rto_code)) = lower(rtrim(d.rto_code))"""
SQL["expected_grid_oem"] = "SELECT * FROM grid_oem"
SQL["expected_grid_rto"] = "SELECT * FROM grid_rto"
SQL["merge_office_map"] = """
    SELECT state, office_label FROM offices WHERE n_regionkey <= 2 UNION ALL
    SELECT state, 'OLD ' || office_label FROM offices WHERE n_regionkey >= 1
    AND state NOT IN (SELECT state FROM offices WHERE n_regionkey <= 2)"""
SQL["states_without_offices"] = """SELECT state FROM state_list
    WHERE state NOT IN (SELECT state FROM offices)"""
SQL["redownload_plan"] = """
    SELECT state, office_label, month, year,
           CASE WHEN path IS NULL THEN 'malformed' ELSE 'download' END AS action
    FROM grid_rto WHERE path IS NULL OR path NOT IN (SELECT path FROM files_rto WHERE valid)"""
SQL["redownload_plan_force"] = """
    SELECT state, office_label, month, year,
           CASE WHEN path IS NULL THEN 'malformed' ELSE 'download' END AS action FROM grid_rto"""
SQL["reconcile_counts"] = " UNION ALL ".join(
    f"""SELECT '{g.fact_table}_backup' AS table_name, count(*) AS row_count FROM legacy_{g.name}
        UNION ALL SELECT '{g.fact_table}', count(*) FROM fact_{g.name}"""
    for g in GRAINS.values()
)
SQL["repair_check"] = " UNION ALL ".join(
    f"""SELECT '{g.fact_table}' AS table_name, count(*) AS non_null_rows FROM fact_{g.name}
        WHERE electric_bov IS NOT NULL OR ethanol_e100 IS NOT NULL"""
    for g in GRAINS.values()
) + "".join(f" UNION ALL SELECT '{g.fact_table}_repaired', 0" for g in GRAINS.values())
SQL["backfill_counts"] = " UNION ALL ".join(
    f"""SELECT '{g.fact_table}' AS table_name,
        count(*) FILTER (WHERE backfilled) AS electric_bov_rows_updated FROM filled_{g.name}"""
    for g in GRAINS.values()
)
SQL["backfill_dates"] = """SELECT DISTINCT date FROM copies_state
    WHERE trim(electric_vehicles) <> ''"""
SQL["coverage_summary"] = """
    SELECT state, count(g.path) AS expected, count(f.path) AS existing,
           count(g.path) - count(f.path) AS missing, count(*) - count(g.path) AS malformed
    FROM grid_rto g LEFT JOIN (SELECT path FROM files_rto WHERE valid) f ON g.path = f.path
    GROUP BY state"""
SQL["preprocess_summary"] = """
    SELECT state_dir AS "State", strftime(month_start, '%Y') AS "Year",
           count(DISTINCT path) AS files_found,
           count(DISTINCT path) - count(DISTINCT CASE WHEN stored THEN path END) AS empty_reports,
           count(*) FILTER (WHERE stored) AS output_rows
    FROM stored_oem GROUP BY ALL"""
SQL["month_windows"] = f"""
    SELECT l_suppkey, {_label('m')} AS month, strftime(m, '%Y') AS year FROM (
        SELECT l_suppkey, unnest(generate_series(date_trunc('month', min(l_shipdate)),
               date_trunc('month', max(l_shipdate)), INTERVAL 1 MONTH)) AS m
        FROM lineitem GROUP BY l_suppkey)"""
SQL["union_reports"] = f"""SELECT path, "Unnamed: 1", {_columns(h for h in _CELLS if h not in (a.NEW_HEADER, 'STRONG HYBRID EV'))},
    CASE WHEN year(month_start) < 2000 THEN "STRONG HYBRID EV" END AS "STRONG HYBRID EV",
    CASE WHEN year(month_start) >= 2000 THEN "{a.NEW_HEADER}" END AS "{a.NEW_HEADER}", "Unnamed: 38"
    FROM raw_state"""
SQL["flagged_tail"] = """
    SELECT user_id, day, CASE WHEN length(t) <= 40 THEN t
               ELSE '...' || chr(10) || ltrim(right(t, 40), ' ' || chr(10)) END AS excerpt
    FROM (SELECT user_id, day, string_agg(line, chr(10) ORDER BY ts, event_id) AS t
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) AS nth
                FROM (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id,
                             event_type || ' ' || props || ' #' || event_id AS line,
                             event_type = 'error' AS flagged,
                             bool_or(event_type = 'error')
                                 OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS any_flagged
                      FROM events)
                WHERE flagged OR NOT any_flagged)
          WHERE nth <= 2 GROUP BY user_id, day)"""
SQL["snapshot_backup"] = "SELECT * FROM fact_state"
SQL["resume_from_backup"] = "SELECT * FROM migrated_oem"

SQL["fn_convert_date"] = f"""
    SELECT o_orderkey, '1/' || {_label('o_orderdate')} || strftime(o_orderdate, '/%Y') AS written,
           strftime(date_trunc('month', o_orderdate), '%d/%m/%Y') AS converted FROM orders"""
SQL["fn_month_number"] = f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN lower({_label('o_orderdate')})
               ELSE {_label('o_orderdate')} END AS label,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(month(o_orderdate) AS INTEGER) END AS number,
           CASE WHEN o_orderstatus <> 'P' THEN {_label('o_orderdate')} END AS name FROM orders"""
SQL["fn_remove_special"] = r"""SELECT doc_id,
    regexp_replace(text, '[^\p{L}\p{N}_]+', ' ', 'g') AS cleaned FROM documents"""
SQL["fn_state_folder"] = f"""SELECT s_suppkey, {_folder('state')} AS folder FROM offices UNION ALL
    SELECT page_id, {_folder('url')} FROM pages"""
SQL["fn_office_name_code"] = """SELECT office_label, CASE WHEN good THEN folder END AS folder,
    CASE WHEN good THEN 'R' || s_suppkey END AS code FROM offices"""
SQL["fn_split_office_folder"] = f"""SELECT folder, {_rto_name('folder')} AS rto_name,
    {_rto_code('folder')} AS rto_code FROM offices"""
SQL["fn_label_match"] = """SELECT 'R' || s_suppkey AS code, office_label FROM offices
    WHERE contains(office_label, ' - R' || s_suppkey || '(')"""
_tail = f"strftime(day, '/%Y/') || {_label('day')} || '/reportTable.xlsx'"
SQL["fn_report_path"] = f"""
    SELECT s_suppkey, 'reports/state/' || {_folder('state')} || {_tail} AS state_path,
           CASE WHEN good THEN 'reports/rto/' || {_folder('state')} || '/' || folder || {_tail} END AS rto_path,
           'reports/oem/' || {_folder('state')} || '/' || {_class_key('office_label')} || {_tail} AS oem_path
    FROM offices JOIN (SELECT l_suppkey, min(l_shipdate) AS day FROM lineitem GROUP BY ALL)
    ON s_suppkey = l_suppkey"""
SQL["fn_parse_count"] = """SELECT l_orderkey, l_linenumber,
    format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS written,
    CAST(floor(l_extendedprice) AS INTEGER) AS value FROM lineitem"""
SQL["fn_parse_date_103"] = """SELECT o_orderkey,
    day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) AS written,
    CAST(o_orderdate AS DATE) AS value FROM orders"""
SQL["fn_varchar"] = """SELECT doc_id, CAST(left(text, 100) AS VARCHAR) AS wide,
    left(text, 50) AS narrow FROM documents"""
SQL["fn_blank_to_null"] = """SELECT event_id,
    CASE WHEN event_type <> 'click' THEN event_type END AS value FROM events"""
SQL["fn_previous_month"] = f"""SELECT o_orderkey,
    {_label('o_orderdate - INTERVAL 1 MONTH')} AS month,
    strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y') AS year FROM orders"""
SQL["fn_month_label"] = f"SELECT o_orderkey, {_label('o_orderdate')} AS label FROM orders"
SQL["fn_history_title"] = f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {_STATES}[c_nationkey + 1] || ' ' END AS state,
           CASE WHEN o_orderstatus <> 'P' THEN {_label('o_orderdate')} END AS month,
           CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y') END AS year
    FROM orders JOIN customer ON o_custkey = c_custkey"""
SQL["fn_context_text"] = """
    SELECT event_id, concat_ws(', ', CASE WHEN event_type <> 'view' THEN 'event=' || event_type END,
           CASE WHEN event_type <> 'click' AND props <> '' THEN 'props=' || props END,
           'user=' || user_id) AS value FROM events"""


def _artifact(text: str, width: int) -> str:
    clean = f"trim(regexp_replace({text}, '[^A-Za-z0-9._-]+', '_', 'g'), '_')"
    return f"left(coalesce(nullif({clean}, ''), 'unknown'), {width})"


SQL["fn_artifact_label"] = f"""SELECT page_id, {_artifact("coalesce(url, '')", 80)} AS label,
    {_artifact("coalesce(html, '')", 200)} AS html_label FROM pages"""
SQL["fn_first_message_line"] = r"""
    SELECT doc_id, source || ': ' || coalesce(list_filter(list_transform(string_split(text, chr(10)),
           lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, '#')
           AND x NOT IN ('Message:', 'Stacktrace:'))[1], source) AS summary FROM documents"""
_reasons = " ".join(
    f"WHEN contains(html, '{m}') THEN 'page_source_contains_' || '{label}'"
    for m, label in zip(a.BLOCKED_MARKERS, ("track_0", "nicht", "que_amp"))
)
SQL["blocked_pages"] = f"""SELECT page_id,
    CASE WHEN trim(regexp_extract(html, '<title>(.*?)</title>', 1)) = '{a.BLOCKED_TITLE}'
         THEN 'page_title_access_forbidden' {_reasons} END AS blocked_reason FROM pages"""

for _g in GRAINS.values():
    _n = _g.name
    SQL[f"rename_project_{_n}"] = _prep(_g, f"raw_{_n}", only_present=True, raw_dims=True)
    SQL[f"curate_{_n}"] = f"SELECT * FROM curated_{_n}"
    _seen = '"Unnamed: 1"' + (', inner_dir AS "Vehicle Class"' if _g is OEM else "")
    SQL[f"enrich_class_{_n}"] = f"""SELECT path, {_seen}, "Vehicle Type", "Vehicle Category",
        "Vehicle Use Type" FROM raw_{_n} LEFT JOIN mapping ON {_mapped(_g)}"""
    SQL[f"delete_staged_{_n}"] = _kept(_g, f"stage_{_n}")
    SQL[f"upsert_fact_{_n}"] = f"SELECT * FROM upserted_{_n}"
    SQL[f"curated_upsert_{_n}"] = _curated_upsert(_g, f"fresh_{_n}")
    SQL[f"backfill_electric_{_n}"] = f"SELECT * FROM filled_{_n}"
    SQL[f"missing_reports_{_n}"] = f"""SELECT path, state, month, year FROM grid_{_n}
        WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM files_{_n} WHERE valid)"""
    SQL[f"preprocess_{_n}"] = f"SELECT * FROM prep_{_n}"
    SQL[f"schema_migration_{_n}"] = f"SELECT * FROM migrated_{_n}"
    SQL[f"stored_migration_{_n}"] = f"SELECT * FROM migrated_{_n}"
    SQL[f"stored_backfill_{_n}"] = f"SELECT {_columns(_g.backfill_key)}, electric_bov FROM filled_{_n}"
    SQL[f"stored_repair_{_n}"] = f"""SELECT * REPLACE (CAST(NULL AS VARCHAR) AS electric_bov,
        CAST(NULL AS VARCHAR) AS ethanol_e100) FROM fact_{_n}"""
    SQL[f"quarantine_{_n}"] = f"""SELECT {_columns(_g.load_key)},
        CASE WHEN diesel IS NULL THEN '1st' ELSE day END AS day,
        total || CASE WHEN petrol IS NULL THEN '.0' ELSE '' END AS total,
        concat_ws(',', CASE WHEN diesel IS NULL THEN 'day' END, CASE WHEN petrol IS NULL THEN 'total' END) AS faults
        FROM fact_{_n} WHERE diesel IS NULL OR petrol IS NULL"""
    _no_key = " OR ".join(f"{_q(k)} IS NULL" for k in _g.curated_key)
    _same_key = ", ".join("date" if k == "date" else f"lower(rtrim({_q(k)}))" for k in _g.curated_key)
    SQL[f"curated_counted_{_n}"] = f"""SELECT {_columns(_g.curated_key)}, total,
        CASE WHEN {_no_key} THEN 1 ELSE count(*) OVER (PARTITION BY {_same_key}) END AS copies FROM ({_curated_upsert(_g, f"fresh_{_n}")})"""
    SQL[f"monthly_run_{_n}"] = (
        f"SELECT * FROM run_fact_{_n}" if _g is STATE else _curated_upsert(_g, f"run_fresh_{_n}")
    )
SQL["preprocess_rows_oem"] = "SELECT * FROM prep_oem"
SQL["preprocess_workbooks_rto"] = "SELECT * FROM prep_rto"
SQL["full_refresh_rto"] = "SELECT * FROM curated_rto"
CTES["history_raw"] = """SELECT * FROM rawmin_rto WHERE state_dir = 'Maharashtra'
    AND month_start BETWEEN DATE '1996-03-01' AND DATE '1999-08-01'"""
CTES["history_prep"] = _prep(RTO, "history_raw")
CTES["history_stage"] = _as_text(RTO, "history_prep")
SQL["history_backfill"] = f"{_kept(RTO, 'history_stage')} UNION ALL SELECT * FROM history_stage"


def _with_ctes(body: str) -> str:
    """Prefix a query with the shared tables it uses, in order of dependency."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"[a-z_]+", re.sub(r"'[^']*'", "", sql)):
            if name in CTES and name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    tables = ", ".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {tables} {body}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_ctes(body) for name, body in SQL.items()}
