"""The five end-to-end jobs, on files, as a user runs them: each composes the library's operators.

    offers_job            sectioned offer file -> (Agente, Planta, Hora_1..Hora_24) [+ CSV]
    declarations_job      master sheet + hourly declarations -> plants of chosen agents/types with a
                          positive daily total [+ CSV]
    weather_job           hourly readings -> hourly deltas, daily degrees F roll-up with daily deltas
    ticket_load / ticket_report / ticket_consolidate / ticket_export
                          delimited bulk load of a 7-table ticket warehouse, statistics, star
                          consolidation, single-file export
    fraud_job             cleaned feature files -> 5-fold AUC, fitted forest, scored test file
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kestrel.functions.numeric import exact_sum, round_half_up
from kestrel.operators import features, model, series, shape, star, stats
from kestrel.operators.quality import row_counts
from kestrel.sources.lines import hour_columns, read_declarations, read_sectioned_offers
from kestrel.sources.sinks import export_named_files, export_single_csv, write_csv
from kestrel.session import case_sensitive
from kestrel.sources.tables import (bulk_load_delimited, project_master, read_header_names, read_headered_csv,
                                    with_auto_timestamps)

HOURS = hour_columns()


# ---------------------------------------------------------------- offers and declarations

def offers_job(spark: SparkSession, path: str, out_csv: str | None = None, header_prefix: str = "AGENTE:",
               record_type: str = "D") -> tuple[DataFrame, DataFrame]:
    """Typed records of a sectioned offer file; returns (records, summary: rows and distinct agents)."""
    records = read_sectioned_offers(spark, path, header_prefix, record_type)
    if out_csv:
        write_csv(records, out_csv)
    summary = records.agg(F.count(F.lit(1)).alias("registros"), F.count_distinct("Agente").alias("agentes"))
    return records, summary


# The four master columns kept and their new names, the agents and plant types chosen.
MASTER_COLUMNS = ("Nombre visible Agente", "AGENTE (OFEI)", "CENTRAL (dDEC, dSEGDES, dPRU…)",
                  "Tipo de central (Hidro, Termo, Filo, Menor)")
MASTER_NAMES = ("Nombre_Agente", "Agente_OFEI", "Central", "Tipo_Central")
AGENTS = ("EMGESA", "EMGESA S.A.")
PLANT_TYPES = ("H", "T")


def declarations_job(spark: SparkSession, master_csv: str, declarations_path: str, out_csv: str | None = None,
                     agents: Iterable[str] = AGENTS, plant_types: Iterable[str] = PLANT_TYPES,
                     master_columns=MASTER_COLUMNS, master_names=MASTER_NAMES) -> DataFrame:
    """Master rows of the chosen agents (either name column) and plant types, first per plant in
    file order, joined on the raw plant name with the declarations, total of 24 hours, kept when
    positive."""
    raw = spark.read.option("header", True).csv(master_csv)
    ordered = raw.select("*", F.col("_metadata.file_path").alias("__file"),
                         F.monotonically_increasing_id().alias("__line"))
    # kept columns in the file's order, then renamed by position (order keys last)
    keyed = project_master(ordered, list(master_columns) + ["__file", "__line"],
                           list(master_names) + ["__file", "__line"])
    agents, plant_types = list(agents), list(plant_types)
    chosen = shape.filter_by_sets(keyed, any_of=[(master_names[0], agents), (master_names[1], agents)],
                                  all_of=[(master_names[3], plant_types)])
    first = shape.keep_first(chosen, [master_names[2]], ["__file", "__line"]).drop("__file", "__line")
    decl = read_declarations(spark, declarations_path, key_col=master_names[2])
    joined = first.join(decl, on=master_names[2], how="inner").select(*master_names, *HOURS)
    result = shape.keep_positive(shape.with_row_total(joined, HOURS, "Suma_Horas"), "Suma_Horas")
    if out_csv:
        write_csv(result, out_csv)
    return result


# ---------------------------------------------------------------- weather

def weather_job(hourly: DataFrame, place: str = "localidad", ts: str = "fecha_hora", temp: str = "temperatura_c",
                tiebreak: str = "id", cloud: str = "cobertura_nubes", country: str | None = "pais",
                offset: str = "-05:00") -> tuple[DataFrame, DataFrame]:
    """(hourly with delta_temp_c, daily in degrees F with delta_temp_f), as the weather script does."""
    hourly_delta = series.delta_to_previous(hourly, [place], [ts, tiebreak], temp, "delta_temp_c")
    daily = series.daily_rollup(hourly, place, ts, temp, tiebreak, cloud, country=country, offset=offset,
                                max_cols={"indice_uv": "indice_uv"},
                                avg_cols={"presion_atm": "presion_atm", "velocidad_viento": "velocidad_viento"})
    daily_delta = series.delta_to_previous(daily, [place], ["fecha"], "temperatura_f", "delta_temp_f")
    return hourly_delta, daily_delta


# ---------------------------------------------------------------- ticket warehouse

def _schema(spec: str) -> T.StructType:
    return T.DataType.fromDDL(spec)


# The declared warehouse tables (names, columns, types) and how each file is delimited.
TICKET_TABLES = {
    "users": ("userid int, username string, firstname string, lastname string, city string, state string, "
              "email string, phone string, likesports boolean, liketheatre boolean, likeconcerts boolean, "
              "likejazz boolean, likeclassical boolean, likeopera boolean, likerock boolean, likevegas boolean, "
              "likebroadway boolean, likemusicals boolean", "|", None),
    "venue": ("venueid short, venuename string, venuecity string, venuestate string, venueseats int", "|", None),
    "category": ("catid short, catgroup string, catname string, catdesc string", "|", None),
    "date": ("dateid short, caldate date, day string, week short, month string, qtr string, year short, "
             "holiday boolean", "|", None),
    "event": ("eventid int, venueid short, catid short, dateid short, eventname string, starttime timestamp_ntz",
              "|", "auto"),
    "listing": ("listid int, sellerid int, eventid int, dateid short, numtickets short, "
                "priceperticket decimal(8,2), totalprice decimal(8,2), listtime timestamp_ntz", "|", None),
    "sales": ("salesid int, listid int, sellerid int, buyerid int, eventid int, dateid short, qtysold short, "
              "pricepaid decimal(8,2), commission decimal(8,2), saletime timestamp_ntz", "\t", "M/d/yyyy H:mm:ss"),
}


def ticket_load(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Bulk load each table present in ``paths`` with its declared schema and delimiter."""
    out = {}
    for name, path in paths.items():
        spec, sep, stamp = TICKET_TABLES[name]
        if stamp == "auto":
            text_schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(
                f.dataType, T.TimestampNTZType) else f.dataType) for f in _schema(spec).fields])
            ts_cols = [f.name for f in _schema(spec).fields if isinstance(f.dataType, T.TimestampNTZType)]
            out[name] = with_auto_timestamps(bulk_load_delimited(spark, path, text_schema, sep=sep), ts_cols)
        else:
            out[name] = bulk_load_delimited(spark, path, _schema(spec), sep=sep, timestamp_format=stamp)
    return out


def ticket_report(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Row counts, users liking jazz, liking opera and rock, price statistics, median and mode,
    and the average sale of buyers who like rock but not jazz."""
    users, sales = t["users"], t["sales"]
    price = sales.select(F.col("pricepaid").cast("double").alias("pricepaid"), "salesid", "buyerid")
    return {
        "row_counts": row_counts(dict(t)),
        "jazz": users.filter(F.col("likejazz") == True).agg(F.count(F.lit(1)).alias("usuarios_jazz")),  # noqa: E712
        "opera_and_rock": users.filter((F.col("likeopera") == True) & (F.col("likerock") == True)).agg(  # noqa: E712
            F.count(F.lit(1)).alias("usuarios_opera_y_rock")),
        "price_stats": stats.describe(price, "pricepaid"),
        "median_mode": stats.one_row([stats.exact_median(price, "pricepaid", "mediana_ventas"),
                                      stats.mode_with_frequency(price, "pricepaid", "moda_ventas", "frecuencia")]),
        "rock_not_jazz": price.join(users.filter((F.col("likerock") == True) & (F.col("likejazz") == False)),  # noqa: E712
                                    F.col("buyerid") == F.col("userid")).agg(
            round_half_up(F.try_divide(exact_sum("pricepaid"), F.count("pricepaid"))).alias("promedio_ventas"),
            F.count("salesid").alias("total_ventas"), F.count_distinct("buyerid").alias("total_compradores")),
    }


def ticket_consolidate(t: Mapping[str, DataFrame]) -> DataFrame:
    """Sales by buyer names and e-mail, event name, venue name and sale date (the date dimension
    joins on the sale's date), summing quantity and price."""
    s = t["sales"].select("buyerid", "eventid", F.col("dateid").alias("s_dateid"), "qtysold", "pricepaid")
    dims = [
        (t["users"].select("userid", "firstname", "lastname", "email"), F.col("buyerid") == F.col("userid")),
        (t["event"].select(F.col("eventid").alias("e_eventid"), "venueid", "eventname"),
         F.col("eventid") == F.col("e_eventid")),
        (t["venue"].select(F.col("venueid").alias("v_venueid"), "venuename"), F.col("venueid") == F.col("v_venueid")),
        (t["date"].select("dateid", "caldate"), F.col("s_dateid") == F.col("dateid")),
    ]
    keys = [F.col("firstname").alias("nombre_usuario"), F.col("lastname").alias("apellido_usuario"),
            F.col("email").alias("correo_usuario"), F.col("eventname").alias("nombre_evento"),
            F.col("venuename").alias("lugar_evento"), F.col("caldate").alias("fecha_evento")]
    return star.consolidate(s, dims, keys, [F.sum("qtysold").cast("long").alias("cantidad_vendida"),
                                            F.sum("pricepaid").alias("total_vendido")])


def ticket_export(consolidated: DataFrame, path: str) -> None:
    """One CSV file with a header, largest totals first."""
    export_single_csv(consolidated, path, [F.col("total_vendido").desc()])


def ticket_unload(consolidated: DataFrame, prefix: str, max_records: int = 0) -> list[str]:
    """The same rows as files named ``<prefix>000``, ``<prefix>001``, ..., written by one task, over files of these names."""
    return export_named_files(consolidated, prefix, [F.col("total_vendido").desc()], max_records)


# ---------------------------------------------------------------- fraud model

# Identifier, date and target columns left out of the features.
FRAUD_DROP = ("ID", "id", "FRAUDE", "FECHA", "FECHA_VIN", "OFICINA_VIN", "FECHA_FRAUDE")


def fraud_job(spark: SparkSession, train_csv: str, test_csv: str, out_csv: str | None = None,
              label: str = "FRAUDE", num_trees: int = model.NUM_TREES, max_depth: int = 30,
              folds: int = 5) -> dict[str, DataFrame]:
    """Clean both files (case-insensitive duplicate headers keep their first copy), features common to
    both, numeric vs text split, 5-fold AUC, fit on all training rows, score the test file and write
    it back with the label column replaced by the probability (all other columns as read).

    The returned ``scored`` frame has Spark's unique names for case-clashing headers (a suffix with
    the position); the written file has the header exactly as in the input."""
    train, test = read_headered_csv(spark, train_csv), read_headered_csv(spark, test_csv)
    x_train = shape.drop_if_present(train, FRAUD_DROP)
    x_test = shape.drop_if_present(test, FRAUD_DROP)
    common = shape.common_columns(x_train, x_test)
    num, text = shape.split_by_type(x_train.select(*common))
    order_col = "__row"
    labelled = train.withColumn(order_col, F.monotonically_increasing_id())
    with_folds = features.stratified_folds(labelled, label, order_col, folds, "__fold")
    cv = model.cross_validated_auc(with_folds, label, num, text, "__fold", num_trees=num_trees, max_depth=max_depth)
    fitted = model.fit_forest(train, label, num, text, num_trees=num_trees, max_depth=max_depth)
    original, names = read_headered_csv(spark, test_csv, dedup_case=False), read_header_names(spark, test_csv)
    at = [n.upper() for n in names].index(label)  # the first of the name, as cleaned; the others stay as read
    scored = shape.replace_from_clean(original, names, original.columns[at],
                                      lambda x: model.score(fitted, x.drop(label), "__p"), "__p")
    label = original.columns[at]
    if out_csv:  # the file keeps the header as written, case-clashing names included
        with case_sensitive(spark):
            write_csv(scored.toDF(*names), out_csv)
    summary = scored.agg(F.avg(label).alias("p_media"), F.count_if(F.col(label) >= 0.5).alias("n_fraude"),
                         F.count(F.lit(1)).alias("filas"))
    return {"cv_auc": cv, "scored": scored, "summary": summary}
