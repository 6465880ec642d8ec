"""The SQL each registered query must agree with."""

from __future__ import annotations

from checks.sql_tables import best, distance, query, utc

# Names of the models in the SQL chain.
SQL_NAMES = {
    "int_positions_deduplicated": "deduplicated",
    "fct_aircraft_positions": "positions",
    "fct_traffic_hourly": "traffic_hourly",
    "fct_airport_activity": "airport_activity",
    "fct_airline_airport_activity": "airline_airport",
    "fct_airport_hourly_air_quality": "panel",
}

# Columns whose last digits differ between engines; both sides round them.
INEXACT = {"distance_km", "on_ground_ratio"}


def columns(*names: str) -> str:
    return ", ".join(f"round({name}, 6) as {name}" if name in INEXACT else name for name in names)


def whole(table: str, doubles: str = "") -> str:
    """All columns of a table, the named ones rounded."""
    replaced = ", ".join(f"round({name}, 6) as {name}" for name in doubles.split())
    return query(f"select * {f'replace ({replaced})' if replaced else ''} from {table}")


def _quoted(names) -> str:
    return ", ".join(f"'{name}'" for name in sorted(names))


LATEST = "(select * from positions where snapshot_at = (select max(snapshot_at) from positions))"
NOW = "timestamp '2024-01-03 23:45:00'"
USAGE = """select aircraft_icao24, callsign, ingest_date, origin_country, min(snapshot_at) as first_seen_at,
    max(snapshot_at) as last_seen_at, count(*) as observation_count, max(barometric_altitude_m) as max_altitude_m,
    max(ground_speed_kt) as max_ground_speed_kt, count(*) filter (is_on_ground) as ground_count
    from positions group by aircraft_icao24, callsign, ingest_date, origin_country"""
UNUSED = ", ".join(f"null::varchar as {name}" for name in ("local_code", "home_link", "wikipedia_link", "keywords"))
# Every tenth snapshot was delivered again without states.
EMPTIED = "snapshot_ts // 900 % 10 = 0"
NEAR = columns(
    "aircraft_icao24", "snapshot_at", "callsign", "origin_country", "latitude", "longitude",
    "barometric_altitude_m", "ground_speed_kt", "vertical_rate_ms", "is_on_ground",
    "flight_phase", "ingest_date", "ingest_hour", "airport_id", "airport_icao_code",
    "airport_iata_code", "airport_name", "airport_label", "airport_iso_country",
    "airport_municipality", "distance_km",
)
STATES = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude",
    "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
)
STATES_TAIL = ("geo_altitude", "squawk", "spi", "position_source", "category", "snapshot_ts")
SENSORS = "array_to_string(sensors, ',') as sensors"


# Fixed values, written out from the models' definitions and not taken from the engine. Per table: columns that are
# never null, the unique column, ranges (column, low, high, severity), allowed values, and references.
SENSIBLE, SURE = "warn", "error"
AIRPORT_KEY = ("airport_id", "dim_airport", "airport_id")
EVERYWHERE = [("latitude", -90, 90, SURE), ("longitude", -180, 180, SURE)]
EXPECTED: dict[str, dict] = {
    "stg_states": {
        "filled": "aircraft_icao24 snapshot_at latitude longitude is_on_ground",
        "ranges": [
            *EVERYWHERE, ("barometric_altitude_m", -500, 20000, SENSIBLE), ("ground_speed_ms", 0, 400, SENSIBLE),
            ("heading_deg", 0, 360, SURE),
        ],
    },
    "stg_airports": {
        "filled": "airport_id airport_ident latitude longitude", "unique": "airport_id", "ranges": EVERYWHERE,
        "values": ("airport_type", "large_airport medium_airport small_airport"),
    },
    "stg_air_quality": {
        "filled": "airport_icao measured_hour",
        "ranges": [("no2_ugm3", 0, 1000, SENSIBLE), ("pm25_ugm3", 0, 1000, SENSIBLE)],
    },
    "stg_registry": {"filled": "aircraft_icao24", "unique": "aircraft_icao24"},
    "stg_airlines": {"filled": "airline_icao airline_name", "unique": "airline_icao"},
    "int_positions_deduplicated": {"filled": "aircraft_icao24 snapshot_at"},
    "fct_aircraft_positions": {
        "filled": "aircraft_icao24 snapshot_at flight_phase",
        "ranges": [
            ("barometric_altitude_ft", -1650, 66000, SENSIBLE), ("ground_speed_kt", 0, 780, SENSIBLE),
            ("position_age_seconds", 0, None, SURE),
        ],
        "values": ("flight_phase", "sol montee descente croisiere inconnu"),
        "reference": ("aircraft_icao24", "dim_aircraft", "aircraft_icao24"),
    },
    "fct_traffic_hourly": {
        "filled": "traffic_hour origin_country distinct_aircraft position_count",
        "ranges": [("distinct_aircraft", 1, None, SURE), ("position_count", 1, None, SURE)],
    },
    "fct_airport_activity": {
        "filled": "airport_id activity_hour distinct_aircraft", "reference": AIRPORT_KEY,
        "ranges": [("distinct_aircraft", 1, None, SURE), ("avg_distance_km", 0, 8, SURE)],
    },
    "dim_aircraft": {
        "filled": "aircraft_icao24 observation_count first_seen_at last_seen_at", "unique": "aircraft_icao24",
        "ranges": [("observation_count", 1, None, SURE), ("on_ground_ratio", 0, 1, SURE)],
    },
    "dim_airport": {"filled": "airport_id airport_label grid_cell", "unique": "airport_id", "ranges": EVERYWHERE},
    "fct_airport_hourly_air_quality": {
        "filled": "airport_id activity_hour hour_of_day distinct_aircraft", "reference": AIRPORT_KEY,
        "ranges": [("hour_of_day", 0, 23, SURE), ("distinct_aircraft", 1, None, SURE)],
    },
    "dim_airline": {"filled": "airline_icao airline_name", "unique": "airline_icao"},
    "fct_airline_airport_activity": {
        "filled": "airport_id airline_icao distinct_aircraft", "reference": AIRPORT_KEY,
        "ranges": [("distinct_aircraft", 1, None, SURE)],
    },
}


def summary() -> str:
    """Violations of every expected check, counted one by one."""
    lines = []
    for model, known in EXPECTED.items():
        table = SQL_NAMES.get(model, model)

        def line(column, check, severity, body):
            lines.append(
                f"select '{model}' as table_name, '{column}' as column_name, '{check}' as check_name, "
                f"'{severity}' as severity, ({body})::bigint as violations"
            )

        for column in known["filled"].split():
            line(column, "not_null", "error", f"select count(*) from {table} where {column} is null")
        for column, low, high, severity in known.get("ranges", ()):
            inside = [f"{column} >= {low}"] if low is not None else []
            inside += [f"{column} <= {high}"] if high is not None else []
            line(column, "accepted_range", severity,
                 f"select count(*) from {table} where not ({' and '.join(inside)})")
        if "values" in known:
            column, allowed = known["values"]
            line(column, "accepted_values", "error",
                 f"select count(*) from {table} where {column} not in ({_quoted(allowed.split())})")
        if "unique" in known:
            column = known["unique"]
            line(column, "unique", "error",
                 f"select count(*) from (select {column} from {table} where {column} is not null "
                 f"group by 1 having count(*) > 1)")  # fmt: skip
        if "reference" in known:
            column, parent, key = known["reference"]
            line(column, "relationships", "error",
                 f"select count(*) from {table} where {column} is not null and {column} not in "
                 f"(select {key} from {SQL_NAMES.get(parent, parent)})")  # fmt: skip
    return query(" union all ".join(lines))


def levels(x: str, y: str, key: str) -> str:
    """Pearson r after removing group means, straight from the residuals."""
    return f"""
        select count(*) as n, corr(x, y) as plain,
               corr(case when k is not null then x - kx end, y - ky) as within,
               corr(case when k is not null then x - hx end, y - hy) as resid
        from (select x, y, k, avg(x) over (partition by k) as kx, avg(y) over (partition by k) as ky,
                     avg(x) over (partition by k, h) as hx, avg(y) over (partition by k, h) as hy
              from (select {x}::double as x, {y} as y, {key} as k, hour_of_day as h from panel
                    where {x} is not null and {y} is not null))"""


def finite(name: str) -> str:
    return f"case when isfinite({name}) then round({name}, 6) end"


def pollutant(name: str, column: str) -> str:
    return (
        f"select '{name}' as pollutant, n, {finite('plain')} as naive, {finite('within')} as within, "
        f"{finite('resid')} as resid from ({levels('distinct_aircraft', column, 'airport_iata_code')})"
    )


REPEATS = (
    "select '{0}' as table_name, '{1}' as column_name, 'unique' as check_name, 'error' as severity, "
    "count(*) as violations from (select {2} as key from {3} group by 1 "
    "having count(*) > 1 and key is not null)"
)

TRACKED = """(values ('LFPG', 49.0128, 2.55), ('LFPO', 48.7233, 2.3794), ('LFLL', 45.7256, 5.0811),
    ('LFMN', 43.6584, 7.2159), ('LFML', 43.4393, 5.2214), ('LFBO', 43.6291, 1.3638),
    ('LFBD', 44.8283, -0.7156), ('LFRS', 47.1532, -1.6107), ('LFSB', 47.5896, 7.5299),
    ('LSZH', 47.4647, 8.5492), ('LEBL', 41.2971, 2.0785), ('LIMC', 45.6306, 8.7281),
    ('EGKK', 51.1481, -0.1903), ('EDDF', 50.0379, 8.5622)) tracked(airport_icao, alat, alon)"""

HOUR_SERIES = "case when {0} then ((k * {1} + h) % 97 / 2.0::double) end as {2}"

ORACLE: dict[str, str] = {
    "scan_states": query(
        f"select {columns(*STATES)}, {SENSORS}, {columns(*STATES_TAIL)}, ingested_at, region, source, "
        "ingest_date, ingest_hour from air_states"
    ),
    "scan_reference": query(
        """select 'airports' as source_name, count(*) as rows from air_airports
        union all select 'air_quality', count(*) from air_quality
        union all select 'registry', count(*) from air_registry
        union all select 'airlines', count(*) from air_airlines"""
    ),
    "scan_airports": query(f"select *, {UNUSED} from air_airports"),
    "scan_air_quality": whole("air_quality"),
    "scan_registry": whole("air_registry"),
    "scan_airlines": whole("air_airlines"),
    "payload_quarantine": query(
        """select reason, count(*) as payloads, true as intact from (
            select case when last_contact % 17 = 0 then 'not JSON' when last_contact % 19 = 0 then 'no time'
                when last_contact % 23 = 0 then 'time out of range' when last_contact % 29 = 0 then 'states are no list'
                else 'readable' end as reason from air_states) group by reason"""
    ),
    "landed_states": query(
        f"""select snapshot_ts, region, count(*) as rows, count(distinct icao24) as aircraft,
            max(last_contact) as last_contact
        from air_states where not ({EMPTIED}) group by snapshot_ts, region"""
    ),
    "empty_snapshots": query(
        f"""select snapshot_ts, region, 0 as rows, 2 as deliveries from air_states where {EMPTIED}
        group by snapshot_ts, region"""
    ),
    "regions_landed": query(
        """select region, ingest_date, ingest_hour, count(*) as rows, count(distinct snapshot_ts) as snapshots
        from (select * from air_states union all
              select * replace ('benelux/nord' as region) from air_states where last_contact % 3 = 0)
        group by region, ingest_date, ingest_hour"""
    ),
    "lake_files": query(
        """select distinct ingest_date, ingest_hour, snapshot_ts, 1 as files, true as has_bytes from air_states"""
    ),
    "facts_after_prune": query(
        """select *, 'build' as state from positions
        union all select *, 'full refresh' from positions where ingest_date >= date '2024-01-02'
        union all select *, 'present' from positions where ingest_date >= date '2024-01-02'"""
    ),
    "gate_blocks": query(
        "select *, 1 as refused, (select count(*) from dim_airline) as airlines from dim_airport"
    ),
    "decode_states": query(
        f"""select {columns(*(c for c in STATES if c != 'time_position'))}, {SENSORS},
            {columns(*(c for c in STATES_TAIL if c != 'category'))},
            case when last_contact % 7 <> 0 then time_position end as time_position,
            case when last_contact % 6 <> 0 then category end as category,
            {NOW} as ingested_at, region, source
        from air_states where last_contact % 13 <> 0 and last_contact % 11 <> 0"""
    ),
    "audit_snapshots": query(
        """select snapshot_ts, region, count(*) as payloads,
            count(*) filter (last_contact % 13 <> 0) as received,
            count(*) filter (last_contact % 13 <> 0 and last_contact % 11 <> 0) as rows
        from air_states group by all"""
    ),
    "flatten_hourly": query(
        f"""select 'A' || k as airport_icao, null::varchar as airport_iata,
            (k % 90)::double as latitude, (k % 180)::double as longitude,
            timestamp '2024-01-05' + to_hours(h::int) as measured_at,
            {HOUR_SERIES.format('k % 3 <> 0 or h < 20', 7, 'nitrogen_dioxide')},
            {HOUR_SERIES.format('(k + h) % 5 <> 0', 3, 'pm2_5')},
            {HOUR_SERIES.format('k % 4 <> 0', 5, 'pm10')},
            {HOUR_SERIES.format('true', 11, 'ozone')},
            {NOW} as ingested_at, 'adapter' as source
        from (select s_suppkey as k from supplier), range(24) hours(h)"""
    ),
    "csv_airports": query(
        f"""select * replace (nullif(icao_code, '') as icao_code, nullif(iata_code, '') as iata_code), {UNUSED}
        from air_airports"""
    ),
    "csv_airlines": query(
        """select airline_id, name, alias, nullif(iata, '') as iata, icao, callsign, country, active
        from air_airlines"""
    ),
    "registry_filter": query(
        """select * from air_registry where trim(icao24) <> ''
        and coalesce(typecode, '') || coalesce(manufacturername, '') || coalesce(operator, '') <> ''"""
    ),
    "tracked_activity": query(
        f"""select airport_icao, count(*) as position_count, round(min(km), 6) as closest_km from (
            select *, {distance('latitude', 'longitude', 'alat', 'alon')} as km
            from low_positions, {TRACKED} where km <= 60
            {best('aircraft_icao24, snapshot_at', 'km, airport_icao')})
        group by airport_icao"""
    ),
    "partition_counts": query(
        """select ingest_date, ingest_hour, count(*) as rows, count(distinct snapshot_ts) as snapshots
        from air_states group by all"""
    ),
    "lake_inventory": query(
        f"""select count(*) as rows, count(distinct snapshot_ts) as snapshots,
            {utc('min(snapshot_ts)')} as oldest, {utc('max(snapshot_ts)')} as newest from air_states"""
    ),
    "retention_keep": query(
        """select ingest_date, count(*) as rows from air_states
        where ingest_date >= date '2024-01-02' group by all"""
    ),
    "warehouse_inventory": query(
        " union all ".join(
            f"select '{schema}' as table_schema, '{model}' as table_name, count(*) as rows from {table}"
            for schema, model, table in [
                ("marts", "fct_aircraft_positions", "positions"),
                ("marts", "dim_airport", "dim_airport"),
                ("marts", "dim_airline", "dim_airline"),
                ("marts", "dim_aircraft", "dim_aircraft"),
                ("intermediate", "int_positions_near_airports", "near"),
                ("marts", "fct_traffic_hourly", "traffic_hourly"),
                ("marts", "fct_airport_activity", "airport_activity"),
                ("marts", "fct_airline_airport_activity", "airline_airport"),
                ("marts", "fct_airport_hourly_air_quality", "panel"),
                ("intermediate", "int_aircraft_usage", f"({USAGE})"),
                ("marts", "fct_airport_aircraft_sketches", "airport_activity"),
            ]
        )
    ),
    "stg_states": whole("stg_states"),
    "stg_airports": whole("stg_airports"),
    "stg_air_quality": whole("stg_air_quality"),
    "stg_registry": whole("stg_registry"),
    "stg_airlines": whole("stg_airlines"),
    "dedup_latest": whole("deduplicated"),
    "positions": whole("positions"),
    "airline_prefix": query(
        "select upper(left(callsign, 3)) as airline_icao, count(*) as rows from positions group by all"
    ),
    "haversine": query(
        f"""select aircraft_icao24, snapshot_at,
            round({distance('48.8566::double', '2.3522::double', 'latitude', 'longitude')}, 6)
                as distance_km from positions"""
    ),
    "grid_density": query(
        """select floor(latitude)::int || '_' || floor(longitude)::int as grid_cell, count(*) as rows
        from positions group by all"""
    ),
    "bbox_filter": query(
        """select count(*) filter (latitude between 41 and 51.5 and longitude between -5.5 and 9.8)
                as france,
            count(*) filter (latitude between 49.4 and 53.6 and longitude between 2.4 and 7.3)
                as benelux,
            count(*) filter (latitude between 35 and 62 and longitude between -12 and 32) as europe,
            count(*) as world from positions"""
    ),
    "phase_counts": query("select flight_phase, count(*) as rows from positions group by all"),
    "low_positions": whole("low_positions"),
    "dim_airport": whole("dim_airport"),
    "dim_airline": whole("dim_airline"),
    "aircraft_usage": query(USAGE),
    "aircraft_over_days": query(
        "select airport_id, count(distinct aircraft_icao24) as distinct_aircraft from near group by airport_id"
    ),
    "aircraft_per_day": query(
        """select airport_id, ingest_date, count(distinct aircraft_icao24) as distinct_aircraft
        from near group by airport_id, ingest_date"""
    ),
    "aircraft_profile": whole("profile", "on_ground_ratio"),
    "most_frequent_callsign": whole("usual_callsign"),
    "dim_aircraft": whole("dim_aircraft", "on_ground_ratio"),
    "near_airports": query(f"select {NEAR} from near"),
    "traffic_hourly": whole("traffic_hourly"),
    "airport_activity": whole("airport_activity"),
    "airline_airport": whole("airline_airport"),
    "traffic_air_panel": whole("panel"),
    "overview": query(
        """select count(*) as positions, count(distinct aircraft_icao24) as aeronefs,
            count(distinct snapshot_at) as snapshots, min(snapshot_at) as debut,
            max(snapshot_at) as fin from positions"""
    ),
    "active_airports": query("select count(distinct airport_id) as n from airport_activity"),
    "freshness": query(
        f"""select fin, round(age, 6) as age_minutes, round(span, 6) as span_hours,
            case when age <= 20 then 'ok' when age <= 45 then 'warn' else 'err' end as status
        from (select max(snapshot_at) as fin, (epoch({NOW}) - epoch(max(snapshot_at))) / 60 as age,
                  (epoch(max(snapshot_at)) - epoch(min(snapshot_at))) / 3600 as span from positions)"""
    ),
    "latest_region": query(
        "select ingestion_region from positions order by snapshot_at desc, ingestion_region desc limit 1"
    ),
    "snapshot_series": query(
        """select snapshot_at, count(*) as positions, count(distinct aircraft_icao24) as aeronefs,
            count(distinct aircraft_icao24) filter (is_on_ground) as au_sol
        from positions group by snapshot_at"""
    ),
    "latest_snapshot": query(
        "select "
        + columns(
            "latitude", "longitude", "callsign", "origin_country", "barometric_altitude_ft",
            "ground_speed_kt", "flight_phase", "aircraft_icao24",
        )
        + f" from {LATEST}"
    ),
    "flight_phase_mix": query(
        f"select flight_phase, count(*) as aeronefs from {LATEST} group by flight_phase"
    ),
    "latest_medians": query(
        f"""select round(median(barometric_altitude_ft), 6) as median_altitude_ft,
            round(median(ground_speed_kt), 6) as median_speed_kt from {LATEST}"""
    ),
    "hourly_trend": query(
        """select traffic_hour, sum(position_count)::bigint as positions from traffic_hourly
        group by traffic_hour"""
    ),
    "top_countries": query(
        """select origin_country, sum(position_count)::bigint as positions from traffic_hourly
        group by 1 order by 2 desc, 1 limit 12"""
    ),
    "top_airports": query(
        """select airport_label as aeroport, airport_municipality as ville,
            sum(distinct_aircraft)::bigint as aeronefs, sum(descending_aircraft)::bigint as en_approche,
            sum(climbing_aircraft)::bigint as en_montee, round(avg(avg_distance_km), 2) as distance_moy_km
        from airport_activity group by 1, 2 order by 3 desc, 1, 2 limit 15"""
    ),
    "top_airports_exact": query(
        """select airport_label as aeroport, airport_municipality as ville,
            count(distinct aircraft_icao24) as aeronefs
        from near group by 1, 2 order by 3 desc, 1, 2 limit 15"""
    ),
    "airline_rows": query("select count(airline_name) as n from airline_airport"),
    "top_airline_airports": query(
        """select airport_iata_code, airport_label, sum(distinct_aircraft)::bigint as n
        from airline_airport where airline_name is not null and airport_iata_code is not null
        group by 1, 2 order by 3 desc, 1, 2 limit 12"""
    ),
    "airline_market_share": query(
        """select airline_name, sum(distinct_aircraft)::bigint as aeronefs from airline_airport
        where airport_iata_code = 'EAC' and airline_name is not null
        group by 1 order by 2 desc, 1 limit 10"""
    ),
    "airline_market_share_exact": query(
        """select airport_iata_code, upper(left(trim(callsign), 3)) as airline_icao, airline_name,
            count(distinct aircraft_icao24) as aeronefs
        from near join dim_airline l on l.airline_icao = upper(left(trim(callsign), 3))
        where airport_iata_code is not null and length(trim(callsign)) >= 3 group by all"""
    ),
    "manufacturer_mix": query(
        """select manufacturer_group, count(*) as aeronefs from dim_aircraft
        where manufacturer_group <> 'Inconnu' group by 1"""
    ),
    "top_aircraft_types": query(
        """select aircraft_type, count(*) as aeronefs from dim_aircraft
        where aircraft_type is not null group by 1 order by 2 desc, 1 limit 15"""
    ),
    "dashboard_correlation": query(
        f"""select n, {finite('plain')} as r_naive, {finite('within')} as r_within
        from ({levels('distinct_aircraft', 'no2_ugm3', 'airport_id')})"""
    ),
    "corr_levels": query(
        pollutant("NO2", "no2_ugm3") + " union all " + pollutant("PM2.5", "pm25_ugm3")
    ),
    "corr_per_airport": query(
        f"""select aeroport, heures, {finite('c')} as r from (
            select airport_iata_code as aeroport, count(*) as heures, corr(distinct_aircraft, no2_ugm3) as c
            from panel where no2_ugm3 is not null and airport_iata_code is not null
            group by 1 having count(*) >= 10)"""
    ),
    "corr_negative": query(
        """select count(*) as airports, count(*) filter (c < 0) as negative from (
            select corr(distinct_aircraft, no2_ugm3) as c
            from panel where no2_ugm3 is not null and airport_iata_code is not null
            group by airport_iata_code having count(*) >= 10)"""
    ),
    "demeaned_panel": query(
        """select airport_id, activity_hour,
            round(distinct_aircraft - avg(distinct_aircraft) over (partition by airport_id), 6)
                as ac_within,
            round(no2_ugm3 - avg(no2_ugm3) over (partition by airport_id, hour_of_day), 6) as no2_resid
        from panel"""
    ),
    "scatter_panel": query(
        f"""select {columns('distinct_aircraft', 'no2_ugm3', 'airport_iata_code')} from panel
        where no2_ugm3 is not null"""
    ),
    "panel_summary": query(
        """select count(*) as observations, count(distinct airport_iata_code) as airports,
            min(activity_hour) as first_hour, max(activity_hour) as last_hour from panel"""
    ),
    "dq_summary": summary(),
    "dq_unique": query(
        " union all ".join(
            REPEATS.format(*parts)
            for parts in [
                ("registry", "key", "lower(trim(icao24))", "air_registry"),
                ("airlines", "key", "upper(trim(icao))", "air_airlines"),
                ("airports", "key", "id", "air_airports"),
                ("stg_registry", "aircraft_icao24", "aircraft_icao24", "stg_registry"),
                ("stg_airlines", "airline_icao", "airline_icao", "stg_airlines"),
            ]
        )
    ),
    "dq_relationships": query(
        """select airline_icao as key_value, count(*) as row_count from airline_airport
        where airline_icao not in (select airline_icao from dim_airline) group by 1"""
    ),
    "dq_grain": query(
        """select aircraft_icao24, snapshot_at, count(*) as row_count from stg_states
        group by 1, 2 having count(*) > 1"""
    ),
    "dq_consistency": query(
        """select traffic_hour, origin_country, distinct_aircraft, position_count, aircraft_on_ground,
            aircraft_cruising from traffic_hourly
        where greatest(aircraft_on_ground, aircraft_cruising) > distinct_aircraft
           or distinct_aircraft > position_count"""
    ),
    "dq_consistency_planted": query(
        """select traffic_hour, origin_country, distinct_aircraft, position_count, aircraft_on_ground,
            aircraft_cruising from (
            select * replace (
                case when hour(traffic_hour) % 5 = 1 then distinct_aircraft - 1 else position_count end as position_count,
                case when hour(traffic_hour) % 7 = 2 then distinct_aircraft + 1 else aircraft_on_ground end
                    as aircraft_on_ground,
                case when hour(traffic_hour) % 11 = 3 then distinct_aircraft + 2 else aircraft_cruising end
                    as aircraft_cruising) from traffic_hourly)
        where distinct_aircraft > position_count or aircraft_on_ground > distinct_aircraft
           or aircraft_cruising > distinct_aircraft"""
    ),
    "dq_future": query(
        """select aircraft_icao24, snapshot_at, ingested_at from positions
        where snapshot_at > timestamp '2024-01-03 12:05:00'"""
    ),
    "source_freshness": query(
        """select source_name, newest, round(age, 6) as age_hours,
            case when age > error then 'error' when age > warn then 'warn' else 'pass' end as status
        from (select *, (epoch(timestamp '2024-01-31 06:00:00') - epoch(newest)) / 3600 as age from (
            select 'states' as source_name, max(ingested_at) as newest, 2 as warn, 12 as error
            from air_states
            union all select 'air_quality', max(ingested_at), 36, 96 from air_quality))"""
    ),
    "latest_nonempty": query(
        f"""select max(snapshot_ts) as snapshot_ts, max_by(rows, snapshot_ts) as rows,
            count(*) as snapshots, max_by(rows, snapshot_ts) > 0 as passed
        from (select snapshot_ts, count(*) filter (not ({EMPTIED})) as rows from air_states group by 1)"""
    ),
    "incremental_slice": query(
        "select "
        + columns(
            "aircraft_icao24", "snapshot_at", "callsign", "origin_country", "latitude", "longitude",
            "barometric_altitude_m", "geometric_altitude_m", "barometric_altitude_ft",
            "ground_speed_ms", "ground_speed_kt", "heading_deg", "vertical_rate_ms", "is_on_ground",
            "squawk", "has_special_purpose_indicator", "flight_phase", "position_age_seconds",
            "ingestion_region", "ingested_at", "ingest_date", "ingest_hour",
        )
        + " from positions where snapshot_at > timestamp '2024-01-02 12:00:00'"
    ),
    "append_new": whole("positions"),
    "evolved_facts": query(
        """select aircraft_icao24, snapshot_at, callsign, ingest_hour,
            case when snapshot_at > timestamp '2024-01-02 12:00:00' then squawk end as squawk,
            case when snapshot_at > timestamp '2024-01-02 12:00:00' then position_age_seconds end
                as position_age_seconds
        from positions"""
    ),
    "upsert_replay": whole("positions"),
    "near_after_upsert": query(f"select {NEAR} from near"),
    "traffic_after_upsert": whole("traffic_hourly"),
    "activity_after_upsert": whole("airport_activity"),
    "panel_after_upsert": whole("panel"),
    "aircraft_after_upsert": whole("dim_aircraft", "on_ground_ratio"),
    "stream_upsert": whole("positions"),
    "stream_late": query(
        f"""select {utc('snapshot_ts // 3600 * 3600')} as traffic_hour, region as ingestion_region, count(*) as rows
        from air_states where snapshot_ts <= 1704196800
            and snapshot_ts < (select max(snapshot_ts) from air_states) - 6 * 3600
        group by all"""
    ),
    "stream_hourly": query(
        """select date_trunc('hour', snapshot_at) as traffic_hour, ingestion_region,
            count(*) as position_count from positions group by all"""
    ),
}
