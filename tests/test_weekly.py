"""Weekly totals as aggregate + join back equal the original window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratify.operators.weekly import attach_weekly, weekly_totals


def test_aggregate_join_equals_window(spark):
    # approver 'hot' holds most rows of one week; a NULL approver group; Saturday-only weeks
    base = spark.range(4000).select(
        F.col("id").alias("OrderServiceCode"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("cold"))
         .otherwise(F.lit("hot")).alias("_aprovador"),
        F.date_add(F.lit("2025-03-03").cast("date"), (F.col("id") % 13).cast("int")).alias("data_aprovacao"),
        ((F.col("id") % 7) / 100).cast("decimal(18,2)").alias("peso_os"))
    base = base.withColumns({
        "YearWeek": (F.year("data_aprovacao") * 100 + F.weekofyear("data_aprovacao")).cast("int"),
        "WeekDayNumber": F.weekday("data_aprovacao"),
        "HolidayOrBridge": F.when(F.col("data_aprovacao") == F.lit("2025-03-05").cast("date"),
                                  F.lit("Holiday")),
    })
    got = attach_weekly(base, weekly_totals(base)).select(
        "OrderServiceCode", "soma_peso_os_semana_aprovador", "total_os_semana_aprovador",
        "total_dias_uteis_semana")
    w = Window.partitionBy("YearWeek", "_aprovador")
    days = (base.filter((F.col("WeekDayNumber") <= 4)
                        & (F.col("HolidayOrBridge").isNull() | (F.col("HolidayOrBridge") == "Bridge")))
            .groupBy("YearWeek", "_aprovador")
            .agg(F.countDistinct("data_aprovacao").alias("total_dias_uteis_semana")))
    ref = (base.select("*", F.sum("peso_os").over(w).alias("soma_peso_os_semana_aprovador"),
                       F.count("OrderServiceCode").over(w).alias("total_os_semana_aprovador"))
           .join(days, ["YearWeek", "_aprovador"], "left")      # NULL approver never matches
           .select("OrderServiceCode", "soma_peso_os_semana_aprovador",
                   "total_os_semana_aprovador", "total_dias_uteis_semana"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
