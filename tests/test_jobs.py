"""The five end-to-end jobs on small files written here, checked against hand-computed results."""

import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from kestrel.plans import jobs
from tests.test_lines import offers_file
from tests.test_series import EXPECTED_DAILY_DELTA_F, EXPECTED_HOURLY_DELTAS_C, hourly


def test_offers_job(spark, tmp_path):
    text, want = offers_file(random.Random(21), 200)
    p = tmp_path / "offers.txt"
    p.write_text(text, encoding="utf-8")
    out = str(tmp_path / "out")
    records, summary = jobs.offers_job(spark, str(p), out)
    assert records.count() == len(want) == spark.read.option("header", True).csv(out).count()
    assert summary.first()["agentes"] == len({a for a, *_ in want if a is not None})


def test_declarations_job(spark, tmp_path):
    cols = ["Extra", "Tipo de central (Hidro, Termo, Filo, Menor)", "Nombre visible Agente", "AGENTE (OFEI)",
            "CENTRAL (dDEC, dSEGDES, dPRU…)"]
    # the kept columns stay in file order and take the new names by position, as the job it rebuilds does
    master = [cols,
              ["x", "EMGESA", "H", "OTRO", "PLANT_A"],
              ["x", " emgesa s.a. ", "t", "OTRO", "PLANT_B"],
              ["x", "EMGESA", "H", "OTRO", "PLANT_A"],   # duplicate plant: first kept
              ["x", "OTRO", "H", "OTRO", "PLANT_C"],     # agent not chosen
              ["x", "EMGESA", "F", "OTRO", "PLANT_D"]]   # second column is not the agent column here
    m = tmp_path / "master.csv"
    m.write_text("\n".join(",".join(f'"{v}"' for v in r) for r in master) + "\n", encoding="utf-8")
    d = tmp_path / "ddec.txt"
    d.write_text("\n".join(['"PLANT_A",' + ",".join(["10"] * 24), "PLANT_B," + ",".join(["0"] * 24),
                            "PLANT_C," + ",".join(["5"] * 24), "TOTAL," + ",".join(["15"] * 24)]), encoding="utf-8")
    out = jobs.declarations_job(spark, str(m), str(d))
    rows = {r["Central"]: r["Suma_Horas"] for r in out.collect()}
    assert out.columns[:4] == ["Nombre_Agente", "Agente_OFEI", "Central", "Tipo_Central"]
    # positional rename: file column 2 ("Tipo de central") became Nombre_Agente, etc.
    assert rows == {}  # no row has an agent name in the first two kept columns and a type in the fourth


def test_declarations_job_named_order(spark, tmp_path):
    cols = ["Nombre visible Agente", "AGENTE (OFEI)", "Extra", "CENTRAL (dDEC, dSEGDES, dPRU…)",
            "Tipo de central (Hidro, Termo, Filo, Menor)"]
    master = [cols, ["EMGESA", "EMGESA S.A.", "x", "PLANT_A", "H"], [" emgesa ", "", "x", "PLANT_B", " t "],
              ["EMGESA", "", "x", "PLANT_A", "T"], ["OTRO", "OTRO", "x", "PLANT_C", "H"]]
    m = tmp_path / "master.csv"
    m.write_text("\n".join(",".join(f'"{v}"' for v in r) for r in master) + "\n", encoding="utf-8")
    d = tmp_path / "ddec.txt"
    d.write_text("\n".join(['"PLANT_A",' + ",".join(["364"] * 24), "PLANT_B," + ",".join(["0"] * 24),
                            "PLANT_C," + ",".join(["5"] * 24), "TOTAL," + ",".join(["15"] * 24)]), encoding="utf-8")
    out = jobs.declarations_job(spark, str(m), str(d))
    got = {(r["Central"], r["Tipo_Central"]): r["Suma_Horas"] for r in out.collect()}
    assert got == {("PLANT_A", "H"): 8736.0}  # first PLANT_A row kept; PLANT_B total is 0


def test_weather_job(spark):
    hourly_delta, daily_delta = jobs.weather_job(hourly(spark))
    h = [r["delta_temp_c"] for r in hourly_delta.filter("localidad = 'El Poblado'").orderBy("fecha_hora").collect()]
    assert h[:3] == EXPECTED_HOURLY_DELTAS_C
    d = {str(r["fecha"]): r["delta_temp_f"] for r in daily_delta.filter("localidad = 'El Poblado'").collect()}
    assert d["2024-01-02"] == EXPECTED_DAILY_DELTA_F


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


def test_ticket_jobs(spark, tmp_path):
    paths = {
        "users": _write(tmp_path, "users.txt", [
            "1|u1|Ana|Ruiz|Bogota|DC|ana@x.co|555|true|false|true|true|false|true|true|false|false|true",
            "2|u2|Luis|Mora|Cali|VC|luis@x.co|556|false|false|false|false|false|true|true|false|false|false",
            "3|u3|Ana|Ruiz|Bogota|DC|ana@x.co|557|\\N|\\N|\\N|\\N|\\N|\\N|true|\\N|\\N|\\N"]),
        "venue": _write(tmp_path, "venue.txt", ["10|Arena|Bogota|DC|0", "11|Arena|Cali|VC|\\N"]),
        "category": _write(tmp_path, "category.txt", ["1|Shows|Musicals|Musical theatre"]),
        "date": _write(tmp_path, "date.txt", ["1827|2008-01-01|WE|1|JAN|1|2008|TRUE",
                                              "1828|2008-01-02|TH|1|JAN|1|2008|FALSE"]),
        "event": _write(tmp_path, "event.txt", ["100|10|1|1827|Show A|2008-01-01 20:00:00",
                                                "101|11|1|1828|Show B|1/2/2008 19:30:00"]),
        "listing": _write(tmp_path, "listing.txt", ["1|1|100|1827|4|50.00|200.00|2008-01-01 10:00:00"]),
        "sales": _write(tmp_path, "sales.txt", ["1\t1\t1\t1\t100\t1827\t2\t100.00\t15.00\t1/1/2008 2:00:00",
                                                "2\t1\t1\t3\t100\t1827\t1\t50.00\t7.50\t1/1/2008 3:00:00",
                                                "3\t1\t1\t2\t101\t1828\t3\t100.00\t15.00\t12/2/2008 11:05:00"]),
    }
    t = jobs.ticket_load(spark, paths)
    assert t["event"].filter("eventid = 101").first()["starttime"] == dt.datetime(2008, 1, 2, 19, 30)
    assert t["sales"].filter("salesid = 3").first()["saletime"] == dt.datetime(2008, 12, 2, 11, 5)
    rep = jobs.ticket_report(t)
    counts = {r["tabla"]: r["filas"] for r in rep["row_counts"].collect()}
    assert counts == {"users": 3, "venue": 2, "category": 1, "date": 2, "event": 2, "listing": 1, "sales": 3}
    assert rep["jazz"].first()[0] == 1 and rep["opera_and_rock"].first()[0] == 2
    mm = rep["median_mode"].first()
    assert (mm["mediana_ventas"], mm["moda_ventas"], mm["frecuencia"]) == (100.0, 100.0, 2)
    rnj = rep["rock_not_jazz"].first()  # user 2 only (user 3's jazz flag is null)
    assert (rnj["promedio_ventas"], rnj["total_ventas"], rnj["total_compradores"]) == (100.0, 1, 1)
    cons = jobs.ticket_consolidate(t)
    rows = {(r["nombre_usuario"], r["lugar_evento"], str(r["fecha_evento"])): (r["cantidad_vendida"], float(r["total_vendido"]))
            for r in cons.collect()}
    # users 1 and 3 share names and e-mail, so their sales merge
    assert rows == {("Ana", "Arena", "2008-01-01"): (3, 150.0), ("Luis", "Arena", "2008-01-02"): (3, 100.0)}
    out = str(tmp_path / "export")
    jobs.ticket_export(cons, out)
    files = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(files) == 1 and open(files[0], encoding="utf-8").readline().startswith("nombre_usuario,")


def test_fraud_job(spark, tmp_path):
    rnd = random.Random(8)
    header = "id,FRAUDE,VALOR,Dist_max,Canal1,FECHA,DIST_MAX,SEXO"
    train, test = [header], [header]
    for i in range(120):
        y = 1 if rnd.random() < 0.3 else 0
        valor = round(rnd.gauss(500 if y else 100, 50), 2)
        dist = "" if rnd.random() < 0.1 else str(round(rnd.random() * 10, 2))
        train.append(f"{i},{y},{valor},{dist},{rnd.choice(['POS', 'ATM', ''])},20150101,1,{rnd.choice('FM')}")
    for i in range(1000, 1030):
        test.append(f"{i},,{round(rnd.uniform(50, 600), 2)},1.5,{rnd.choice(['POS', 'WEB'])},20150102,2,F")
    tr, te = _write(tmp_path, "train.csv", train), _write(tmp_path, "test.csv", test)
    out = str(tmp_path / "scored")
    res = jobs.fraud_job(spark, tr, te, out, num_trees=10, max_depth=5)
    scored = res["scored"]
    assert len(scored.columns) == 8 and scored.columns[:3] == ["id", "FRAUDE", "VALOR"]
    first_line = open(glob.glob(os.path.join(out, "part-*.csv"))[0], encoding="utf-8").readline().strip()
    assert first_line == header  # the written file keeps the original header
    ps = [r["FRAUDE"] for r in scored.collect()]
    assert len(ps) == 30 and all(0.0 <= p <= 1.0 for p in ps)
    cv = {r["fold"]: r["auc"] for r in res["cv_auc"].collect()}
    assert set(cv) == {0, 1, 2, 3, 4, -1, -2} and cv[-1] > 0.8
    assert spark.read.option("header", True).csv(out).count() == 30
    assert res["summary"].first()["filas"] == 30


def test_consolidation_dates_by_sale_not_event(spark, tmp_path):
    paths = {
        "users": _write(tmp_path, "u.txt", ["1|u1|Ana|Ruiz|Bogota|DC|ana@x.co|555|" + "|".join(["false"] * 10)]),
        "venue": _write(tmp_path, "v.txt", ["10|Arena|Bogota|DC|100"]),
        "date": _write(tmp_path, "d.txt", ["1827|2008-01-01|WE|1|JAN|1|2008|TRUE",
                                           "1900|2008-03-14|FR|11|MAR|1|2008|FALSE"]),
        "event": _write(tmp_path, "e.txt", ["100|10|1|1900|Show A|2008-03-14 20:00:00"]),  # event on 14 March
        "sales": _write(tmp_path, "s.txt", ["1\t1\t1\t1\t100\t1827\t2\t80.00\t12.00\t1/1/2008 9:00:00"]),  # sold 1 Jan
    }
    cons = jobs.ticket_consolidate(jobs.ticket_load(spark, paths))
    assert [str(r["fecha_evento"]) for r in cons.collect()] == ["2008-01-01"]
