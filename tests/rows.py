"""Small inputs shared by the tests."""

from skyledger.schema import FLIGHT_SCHEMA, RAW_COLUMNS

# Five reports whose metrics are known.
SAMPLE_CSV = """flight_id,start_time,end_time,duration_minutes,region_code,region_name,latitude,longitude,vehicle_category
RU-2024-0001,2024-01-15T06:45:00Z,2024-01-15T07:30:00Z,45,RU-MOW,Москва,55.7558,37.6173,quadrotor
RU-2024-0002,2024-01-22T09:10:00Z,2024-01-22T09:42:00Z,32,RU-SPE,Санкт-Петербург,59.9311,30.3609,quadrotor
RU-2024-0105,2024-02-05T04:00:00Z,2024-02-05T05:05:00Z,65,RU-MOW,Москва,55.7512,37.6184,fixed-wing
RU-2024-0110,2024-02-18T11:30:00Z,2024-02-18T12:00:00Z,30,RU-SVE,Свердловская область,56.8389,60.6057,quadrotor
RU-2024-0201,2024-03-03T08:25:00Z,2024-03-03T09:15:00Z,50,RU-KDA,Краснодарский край,45.0355,38.9753,hybrid VTOL
"""


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def raw(spark, rows):
    """Raw rows from dicts, in list order."""
    cols = [c for c in (*RAW_COLUMNS, "_src_tz", "ingested_at") if any(c in r for r in rows)]
    data = [tuple(r.get(c) for c in cols) + (i,) for i, r in enumerate(rows)]
    kinds = ", ".join(f"{c} {'int' if c == 'ingested_at' else 'string'}" for c in cols)
    return spark.createDataFrame(data, f"{kinds}, _row_ord int")


def flights(spark, rows):
    """Canonical flights from dicts, missing fields null."""
    data = [tuple(r.get(c, False if c == "superseded" else None) for c in FLIGHT_SCHEMA.names) for r in rows]
    return spark.createDataFrame(data, FLIGHT_SCHEMA)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
