"""Column expressions: lists, calendar, classification and weight (golden values)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ratify.functions import (
    daily_target, duration_text, extra_public_market_minutes, extra_quote_minutes,
    extra_review_minutes, iso_year_week, item_band, maintenance_kind, order_weight,
    parse_list, vehicle_family, weekday_number,
)


def one(spark, expr, ddl, row):
    return spark.createDataFrame([row], ddl).select(expr.alias("x")).first()["x"]


def test_parse_list_strips_blanks_and_repeats(spark):
    ddl = "s string"
    assert one(spark, parse_list("s"), ddl, ("1; 2 ,3;;1",)) == ["1", "2", "3"]
    assert one(spark, parse_list("s"), ddl, ("",)) == []
    assert one(spark, parse_list("s"), ddl, (None,)) == []
    assert one(spark, parse_list("s"), ddl, (" ; , ",)) == []


def test_parse_list_view_variant_keeps_whitespace(spark):
    # the view's pattern never matched, so blanks stay inside the members
    assert one(spark, parse_list("s", strip_whitespace=False), "s string", ("1; 2 ,3",)) == \
        ["1", " 2 ", "3"]


def test_iso_year_week_and_weekday(spark):
    ddl = "d date"
    assert one(spark, iso_year_week("d"), ddl, (dt.date(2024, 12, 30),)) == 202501
    assert one(spark, iso_year_week("d"), ddl, (dt.date(2021, 1, 3),)) == 202053
    assert one(spark, weekday_number("d"), ddl, (dt.date(2024, 12, 30),)) == 0  # Monday
    assert one(spark, weekday_number("d"), ddl, (dt.date(2025, 1, 4),)) == 5   # Saturday


def test_duration_text(spark):
    ddl = "m long"
    assert one(spark, duration_text("m"), ddl, (125,)) == "02:05"
    assert one(spark, duration_text("m"), ddl, (60 * 37,)) == "37:00"
    assert one(spark, duration_text("m"), ddl, (-61,)) == "-01:01"
    assert one(spark, duration_text("m"), ddl, (None,)) is None


def test_item_band_edges(spark):
    expected = {0: "01-03", 3: "01-03", 4: "04-05", 5: "04-05", 6: "06-07", 7: "06-07",
                8: "08-10", 10: "08-10", 11: "11-20", 20: "11-20", 21: "21-30", 30: "21-30",
                31: "31-40", 40: "31-40", 41: "41-50", 50: "41-50", 51: "50 ou mais"}
    df = spark.createDataFrame([(n,) for n in expected], "n long")
    got = {r["n"]: r["b"] for r in df.select("n", item_band("n").alias("b")).collect()}
    assert got == expected


def test_vehicle_family_fallbacks(spark):
    rows = [("Cavalo", "x", "Cavalo"), ("Nao Identificado", "Pesado", "Pesado"),
            ("Nao Definido", None, "Leve"), (None, "Nao Identificado", "Leve"),
            (None, "Nao Definido", "Nao Definido")]
    df = spark.createDataFrame([r[:2] for r in rows], "fam string, cat string")
    got = [r["v"] for r in df.select(vehicle_family("fam", "cat").alias("v")).collect()]
    assert got == [r[2] for r in rows]


def test_maintenance_kind_claim_wins(spark):
    # a claim whose type is preventive stays a claim (severity still says Preventiva)
    df = spark.createDataFrame([("Sinistro", "Preventiva"), ("x", "Preventiva"),
                                ("x", "Preventiva Programada"), (None, None)],
                               "d string, t string")
    got = [r["k"] for r in df.select(maintenance_kind("d", "t").alias("k")).collect()]
    assert got == ["Sinistro", "Preventiva", "Corretiva", "Corretiva"]


def test_extra_minutes_rules(spark):
    df = spark.createDataFrame(
        [(None, None, "special", 4), (1, 3, "special", 4), (2, 2, "special", 2),
         (0, 5, None, 3), (3, 0, "public", 3)],
        "rev long, cot long, cls string, n long")
    got = df.select(extra_review_minutes("rev").alias("r"), extra_quote_minutes("cot", "cls").alias("q"),
                    extra_public_market_minutes("n", "cls").alias("p")).collect()
    assert [(r.r, r.q, float(r.p)) for r in got] == [
        (0, 0, 11.0), (5, 15, 11.0), (10, 10, 8.0), (0, 5, 0.0), (15, 0, 8.0)]


def test_order_weight_golden_vectors(spark):
    rows = [(Decimal("21"), Decimal("1.0"), True, Decimal("0.05")),
            (Decimal("161.5"), Decimal("1.3"), False, Decimal("0.47")),
            (Decimal("98"), Decimal("1.5"), True, Decimal("0.36")),
            # exact half-cent: 51 * 1.1 / 448.8 = 0.125 -> rounds half up
            (Decimal("51"), Decimal("1.0"), True, Decimal("0.13"))]
    df = spark.createDataFrame([r[:3] for r in rows], "t decimal(20,1), f decimal(2,1), p boolean")
    got = df.select(order_weight("t", "f", "p").alias("w"), daily_target("t", "f", "p").alias("m")).collect()
    assert [r.w for r in got] == [r[3] for r in rows]
    assert abs(float(got[0].m) - 448.8 / 21 / 1.1) < 1e-9


def test_no_python_udf_in_expressions(spark):
    df = spark.createDataFrame([("1;2", 3)], "s string, n long")
    plan = df.select(parse_list("s"), item_band("n"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


def test_duration_text_keeps_long_hours(spark):
    from ratify.functions.dates import duration_text
    rows = spark.createDataFrame([(6000,), (74130,), (-6061,), (59,), (None,)], "m long").select(duration_text("m")).collect()
    assert [r[0] for r in rows] == ["100:00", "1235:30", "-101:01", "00:59", None]
