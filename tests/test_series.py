"""Hourly-to-daily roll-up, deltas and summary parts: golden sample and invariants."""

from pyspark.sql import functions as F, types as T

from kestrel.operators import layout, series
from kestrel.sources.tables import inline_rows

# The 9-row hourly weather sample and the results stated for it
# (place, degrees C, local time with offset, cloud cover, UV, pressure, wind).
SAMPLE = [
    ("El Poblado", 20.5, "2024-01-01 08:00:00 -05:00", "Mínima", 4.2, 1012.3, 5.1),
    ("El Poblado", 22.1, "2024-01-01 09:00:00 -05:00", "Parcial", 5.8, 1011.9, 6.3),
    ("El Poblado", 23.8, "2024-01-01 10:00:00 -05:00", "Total", 3.1, 1011.0, 7.0),
    ("Envigado", 21.0, "2024-01-01 08:00:00 -05:00", "Mínima", 4.0, 1013.1, 4.8),
    ("Sabaneta", 19.3, "2024-01-01 08:00:00 -05:00", "Parcial", 3.9, 1013.5, 4.2),
    ("Bello", 24.6, "2024-01-01 08:00:00 -05:00", "Total", 5.0, 1010.8, 8.1),
    ("El Centro", 18.2, "2024-01-01 08:00:00 -05:00", "Mínima", 3.5, 1014.2, 3.6),
    ("El Poblado", 17.9, "2024-01-02 08:00:00 -05:00", "Mínima", 4.1, 1012.8, 5.5),
    ("Envigado", 20.4, "2024-01-02 08:00:00 -05:00", "Parcial", 4.3, 1012.2, 4.9),
]
EXPECTED_DAILY_F = {("El Poblado", "2024-01-01"): 71.84, ("El Poblado", "2024-01-02"): 64.22}
EXPECTED_DAILY_DELTA_F = -7.62
EXPECTED_HOURLY_DELTAS_C = [None, 1.60, 1.70]
DEFAULT_COUNTRY = "Colombia"

GIVEN = T.StructType([
    T.StructField("localidad", T.StringType()), T.StructField("temperatura_c", T.DoubleType()),
    T.StructField("fecha_hora_txt", T.StringType()), T.StructField("cobertura_nubes", T.StringType()),
    T.StructField("indice_uv", T.DoubleType()), T.StructField("presion_atm", T.DoubleType()),
    T.StructField("velocidad_viento", T.DoubleType())])
FULL = T.StructType(GIVEN.fields + [T.StructField("pais", T.StringType())])


def hourly(spark):
    df = inline_rows(spark, SAMPLE, GIVEN, defaults={"pais": DEFAULT_COUNTRY}, full_schema=FULL)
    df = df.withColumn("fecha_hora", F.to_timestamp("fecha_hora_txt", "yyyy-MM-dd HH:mm:ss XXX"))
    return df.withColumn("id", F.monotonically_increasing_id())


def test_defaults_fill_omitted_column_only(spark):
    df = hourly(spark)
    assert {r[0] for r in df.select("pais").distinct().collect()} == {DEFAULT_COUNTRY}
    explicit = inline_rows(spark, [("X", None)], "localidad string, pais string",
                           defaults={"pais": DEFAULT_COUNTRY},
                           full_schema=T.StructType([T.StructField("localidad", T.StringType()),
                                                     T.StructField("pais", T.StringType())]))
    assert explicit.first()["pais"] is None  # an explicit null is not replaced


def test_golden_daily_fahrenheit_and_deltas(spark):
    daily = series.daily_rollup(hourly(spark), "localidad", "fecha_hora", "temperatura_c", "id", "cobertura_nubes",
                                country="pais", avg_cols={"presion_atm": "presion_atm",
                                                          "velocidad_viento": "velocidad_viento"},
                                max_cols={"indice_uv": "indice_uv"})
    got = {(r["localidad"], str(r["fecha"])): r["temperatura_f"] for r in daily.collect()}
    for k, v in EXPECTED_DAILY_F.items():
        assert got[k] == v
    first = {(r["localidad"], str(r["fecha"])): r["cobertura_nubes"] for r in daily.collect()}
    assert first[("El Poblado", "2024-01-01")] == "Mínima"
    deltas = series.delta_to_previous(daily, ["localidad"], ["fecha"], "temperatura_f", "d")
    d = {str(r["fecha"]): r["d"] for r in deltas.filter("localidad = 'El Poblado'").collect()}
    assert d["2024-01-01"] is None and d["2024-01-02"] == EXPECTED_DAILY_DELTA_F
    assert daily.count() == 7


def test_golden_hourly_deltas(spark):
    h = series.delta_to_previous(hourly(spark), ["localidad"], ["fecha_hora", "id"], "temperatura_c", "d")
    rows = h.filter("localidad = 'El Poblado'").orderBy("fecha_hora").collect()
    assert [r["d"] for r in rows][:3] == EXPECTED_HOURLY_DELTAS_C
    assert rows[3]["d"] == -5.90  # the previous row, across the day boundary


def test_first_in_group_matches_row_number(spark):
    df = hourly(spark)
    first = series.first_in_group(df, ["localidad"], ["fecha_hora", "id"], ["temperatura_c"])
    got = {r["localidad"]: r["temperatura_c"] for r in first.collect()}
    assert got["El Poblado"] == 20.5 and got["Envigado"] == 21.0


def test_summary_parts_average_equals_direct(spark):
    df = hourly(spark).withColumn("viento", F.when(F.col("localidad") != "Bello", F.col("velocidad_viento")))
    parts = layout.daily_summary_parts(df, "localidad", "fecha_hora", "temperatura_c", "viento")
    avg = layout.summary_averages(parts)
    got = {(r["localidad"], str(r["fecha"])): r for r in avg.collect()}
    poblado = got[("El Poblado", "2024-01-01")]
    assert poblado["lecturas"] == 3 and poblado["temp_prom"] == 22.13
    bello = got[("Bello", "2024-01-01")]
    assert bello["viento_prom_cero"] == 0.0 and bello["viento_prom"] is None  # null-as-zero vs ignore-null


def test_one_row_per_place_and_day_even_with_country(spark):
    """The roll-up takes the first reading in the same aggregate, so no join can fan out."""
    daily = series.daily_rollup(hourly(spark), "localidad", "fecha_hora", "temperatura_c", "id", "cobertura_nubes",
                                country="pais")
    assert daily.count() == daily.select("localidad", "fecha").distinct().count()
