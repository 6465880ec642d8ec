"""Raw-shaped air traffic tables derived from a star schema and an event stream.

The engine's own inputs are landed files; this adapter lets the same jobs run over tables
``nation supplier customer events``. Columns come from integer arithmetic on the keys,
including the flaws the cleaning rules are there for (blanks, padding, nulls,
out-of-range coordinates, repeated keys). Thirty days of events are squeezed into three.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

EPOCH = 1704067200  # 2024-01-01 00:00 UTC
SNAPSHOT_SECONDS = 900
NO_BREAK_SPACE = "\u00a0"


@dataclass(frozen=True)
class Bronze:
    """The five raw tables every plan starts from, and the payloads that could not be read into them."""

    states: DataFrame
    airports: DataFrame
    air_quality: DataFrame
    registry: DataFrame
    airlines: DataFrame
    quarantine: DataFrame | None = None


def _prefix(n: str) -> str:
    return f"concat(char(65 + {n}), char(65 + ({n} * 7) % 26), char(65 + ({n} * 11) % 26))"


def _address(key: str) -> str:
    """A 24-bit address in hexadecimal."""
    return f"lpad(lower(hex({key} % 16777216)), 6, '0')"


def _latitude(k: str) -> str:
    return f"(41 + (({k} * 617) % 10500) / 1000.0D)"


def _longitude(k: str) -> str:
    return f"(-5.5D + (({k} * 911) % 15300) / 1000.0D)"


def _ident(k: str) -> str:
    return f"concat('X', lpad(cast({k} as string), greatest(3, length(cast({k} as string))), '0'))"


def _iata(k: str) -> str:
    letters = f"concat(char(65 + {k} % 26), char(65 + ({k} div 26) % 26), char(65 + ({k} * 7) % 26))"
    return f"if({k} % 8 = 7, '', {letters})"


# Declared, so that reading a table does not first have to look into its files.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}.parquet")


def states_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    timed = events.selectExpr(
        "event_id as e",
        "user_id as u",
        "user_id % 25 as n",
        "event_id % 5 = 0 as near",
        "(event_id div 5) % 10 as a",
        "cast(ts as timestamp) as ingested_at",
        f"(unix_seconds(cast(ts as timestamp)) - {EPOCH}) div 10 as t",
    )
    named = timed.join(nation.selectExpr("n_nationkey as n", "n_name"), "n")
    states = named.selectExpr(
        f"""case e % 4 when 1 then upper({_address('u')})
                when 2 then concat(' ', {_address('u')}, ' ')
                when 3 then concat({_address('u')}, '{NO_BREAK_SPACE}')
                else {_address('u')} end as icao24""",
        f"""case when e % 37 = 0 then null when e % 31 = 0 then '        '
                else rpad(concat({_prefix('n')}, 100 + e % 7), 8, ' ') end as callsign""",
        "if(u % 41 = 0, null, n_name) as origin_country",
        f"if(e % 43 = 0, null, {EPOCH} + t) as time_position",
        f"{EPOCH} + t + e % 5 as last_contact",
        f"""if(near, {_longitude('a')} + ((e * 17) % 61 - 30) / 1000.0D,
               -5.5D + ((e * 104729) % 15300) / 1000.0D) as longitude""",
        f"""case when e % 501 = 1 then 95.0D
                when near then {_latitude('a')} + ((e * 31) % 61 - 30) / 1000.0D
                else 41 + ((e * 7919) % 10500) / 1000.0D end as latitude""",
        """case when near then cast((e * 37) % 1100 as double)
                when e % 59 = 0 then null
                else cast(8000 + (e * 53) % 4000 as double) end as baro_altitude""",
        "if(e % 47 = 0, null, near and e % 9 < 4) as on_ground",
        "cast((e * 7) % 260 as double) as velocity",
        "cast((e * 11) % 360 as double) as true_track",
        "if(e % 29 = 0, null, ((e * 13) % 121 - 60) / 10.0D) as vertical_rate",
        "if(e % 3 = 0, array(cast(e % 1000 as int), cast(e % 7 as int)), null) as sensors",
        "if(e % 19 = 0, null, cast(8030 + (e * 53) % 4000 as double)) as geo_altitude",
        """case e % 5 when 1 then null when 2 then '    '
                else lpad(cast(e % 7777 as string), 4, '0') end as squawk""",
        "if(e % 11 = 0, null, e % 97 = 0) as spi",
        "cast(e % 4 as int) as position_source",
        "if(e % 13 = 0, null, cast(e % 20 as int)) as category",
        f"{EPOCH} + (t div {SNAPSHOT_SECONDS} + 1) * {SNAPSHOT_SECONDS} as snapshot_ts",
        "ingested_at",
        "'france' as region",
        "'adapter' as source",
    )
    return states.selectExpr(
        "*",
        "cast(timestamp_seconds(snapshot_ts) as date) as ingest_date",
        "hour(timestamp_seconds(snapshot_ts)) as ingest_hour",
    )


def airports_from_suppliers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    named = supplier.selectExpr("s_suppkey as k", "s_name", "s_nationkey as n").join(
        nation.selectExpr("n_nationkey as n", "n_name"), "n"
    )
    return named.selectExpr(
        "cast(k as string) as id",
        f"concat({_ident('k')}, if(k % 3 = 1, ' ', '')) as ident",
        """case when k < 10 or k % 4 = 0 then 'large_airport' when k % 4 = 1 then 'medium_airport'
                when k % 4 = 2 then 'small_airport' else 'heliport' end as type""",
        "s_name as name",
        f"cast({_latitude('k')} as string) as latitude_deg",
        f"cast({_longitude('k')} as string) as longitude_deg",
        """case when k % 10 = 9 then 'n/a' when k % 10 = 3 then concat((k * 37) % 5000, '.5')
                else cast((k * 37) % 5000 as string) end as elevation_ft""",
        "'EU' as continent",
        "concat(' ', n_name) as iso_country",
        "concat(n_name, '-', k % 9) as iso_region",
        "if(k % 17 = 0, '  ', concat('City ', k % 50)) as municipality",
        "case k % 3 when 0 then 'yes' when 1 then ' YES ' else 'no' end as scheduled_service",
        f"if(k % 6 = 5, '', {_ident('k')}) as icao_code",
        f"{_iata('k')} as iata_code",
        f"if(k % 12 = 5, {_ident('k')}, null) as gps_code",
        "cast(null as string) as local_code",
        "cast(null as string) as home_link",
        "cast(null as string) as wikipedia_link",
        "cast(null as string) as keywords",
    )


def airlines_from_nations(nation: DataFrame) -> DataFrame:
    """Every airline twice, once active and once not; one in six has no valid code."""
    copies = nation.selectExpr("n_nationkey as n", "n_name", "explode(array(0, 1)) as copy")
    return copies.selectExpr(
        "cast(n * 2 + copy as string) as airline_id",
        "if(copy = 0, n_name, concat('A former ', n_name)) as name",
        "cast(null as string) as alias",
        "if(copy = 0, cast(n as string), '') as iata",
        f"""case when n % 6 = 5 then if(copy = 0, '-', null) when copy = 0 then lower({_prefix('n')})
                else concat({_prefix('n')}, ' ') end as icao""",
        "concat('CALL', n) as callsign",
        "concat('Country ', n % 7) as country",
        "case when copy = 0 then 'Y' when n % 2 = 0 then 'N' else null end as active",
    )


def registry_from_customers(customer: DataFrame) -> DataFrame:
    """Some aircraft twice, and one entry in nine without any useful field."""
    return customer.selectExpr(
        "c_custkey as k",
        "c_name",
        "explode(if(c_custkey % 13 = 0, array(0, 1), array(0))) as copy",
    ).selectExpr(
        f"if(copy = 0, {_address('k')}, upper({_address('k')})) as icao24",
        "if((k + copy) % 4 = 0, ' ', concat('R-', k, copy)) as registration",
        "if(k % 9 = 4, '', concat('T', k % 20)) as typecode",
        """case when k % 9 = 4 then '' when k % 11 = 0 then null
                else element_at(array('Airbus SAS', 'Boeing', 'Embraer', 'Canadair', 'Bombardier',
                                      'ATR', 'Cessna'), cast(k % 7 as int) + 1)
           end as manufacturername""",
        "concat('Model ', k % 30) as model",
        "if(k % 9 = 4, '', concat(' Operator ', k % 40)) as operator",
        f"if(k % 5 = 0, null, lower({_prefix('(k % 25)')})) as operatoricao",
        "c_name as owner",
        """case k % 6 when 0 then null when 1 then 'abcd' when 2 then ''
                else concat(1970 + k % 50, '-01-01') end as built""",
        "'Large' as categoryDescription",
    )


def air_quality_from_events(events: DataFrame, supplier: DataFrame) -> DataFrame:
    """One reading per airport and hour for the airports the events are assigned to."""
    hours = events.selectExpr(
        f"""({EPOCH} + ((unix_seconds(cast(ts as timestamp)) - {EPOCH}) div 10
             div {SNAPSHOT_SECONDS} + 1) * {SNAPSHOT_SECONDS}) div 3600 as h""",
        "(event_id div 5) % 10 as k",
    ).distinct()
    known = hours.join(supplier.selectExpr("s_suppkey as k"), "k")
    return known.selectExpr(
        f"if(k % 2 = 0, {_ident('k')}, concat(lower({_ident('k')}), ' ')) as airport_icao",
        f"{_iata('k')} as airport_iata",
        f"{_latitude('k')} as latitude",
        f"{_longitude('k')} as longitude",
        "timestamp_seconds(h * 3600 + 60 * (k % 3)) as measured_at",
        """if((h + k) % 17 = 0, null,
              ((h % 100000) * 7 + k * 13) % 400 / 10.0D) as nitrogen_dioxide""",
        "if((h + k) % 19 = 0, null, ((h % 100000) * 5 + k * 11) % 300 / 10.0D) as pm2_5",
        "((h % 100000) * 3 + k * 17) % 500 / 10.0D as pm10",
        "((h % 100000) * 11 + k * 5) % 1200 / 10.0D as ozone",
        "timestamp_seconds(h * 3600 + 7200) as ingested_at",
        "'adapter' as source",
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events").select("event_id", "ts", "user_id")
    return events


def bronze_from_tables(spark: SparkSession, folder: str) -> Bronze:
    nation = read(spark, folder, "nation")
    supplier = read(spark, folder, "supplier")
    events = read_events(spark, folder)
    return Bronze(
        states=states_from_events(events, nation),
        airports=airports_from_suppliers(supplier, nation),
        air_quality=air_quality_from_events(events, supplier),
        registry=registry_from_customers(read(spark, folder, "customer")),
        airlines=airlines_from_nations(nation),
    )
