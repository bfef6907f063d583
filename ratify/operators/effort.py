"""Order effort: item totals (G1/G2), interactions (G3, C11), classification
(C4, C5, C7-C10) and the weight (C12-C16).

Everything that is 1:N with the order is aggregated per order *before* it
meets the order row.  ``groupBy`` runs a partial aggregate in each map task,
so an order holding a large share of all items still leaves each task as a
single partial row: no shuffle partition receives a hot order's raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.functions.classify import (
    daily_target, extra_public_market_minutes, extra_quote_minutes,
    extra_review_minutes, item_band, maintenance_kind, order_weight, vehicle_family,
)
from ratify.functions.dates import minute_text
from ratify.sources import rules as R


def item_totals(items: DataFrame) -> DataFrame:
    """Per order: quoted sum, approved sum, count of non-cancelled items.

    Quoted/approved sums include cancelled items, the count does not.
    """
    live_item = F.when(F.col("CancellationTimestamp").isNull(), F.col("Sk_MaintenanceItem"))
    return items.groupBy(F.col("MaintenanceId").alias("_it_order")).agg(
        F.sum("QuotedPrice").alias("_it_quoted"),
        F.sum("PriceApproved").alias("_it_approved"),
        F.count(live_item).alias("_it_count"),
    )


def order_item_summary(items: DataFrame, labors: DataFrame, whitelist: DataFrame,
                       repeated_labors: bool = False) -> DataFrame:
    """Everything the fact needs from items, in one scan and one aggregate.

    Per order: quoted / approved sums and live-item count (G1, G2), plus the
    reference-price sums of the eligible items (C17; NULL when no item is
    eligible / adherent, like a SUM over no rows).  The labor whitelist is a
    broadcast semi-join flag, so the aggregate stays map-side combined.  With
    ``repeated_labors`` an item's reference sums count once for each listed row of its labor key.
    """
    from ratify.operators.adherence import item_adherence_columns
    el = eligible_labor_flag(items, labors, whitelist, repeated_labors)
    eligible, adherent = item_adherence_columns(F.col("_labor_ok"))
    live_item = F.when(F.col("CancellationTimestamp").isNull(), F.col("Sk_MaintenanceItem"))
    approved_part = F.col("PartPriceApproved") * F.col("_labor_rows") if repeated_labors else F.col("PartPriceApproved")
    return el.groupBy(F.col("MaintenanceId").alias("_it_order")).agg(
        F.sum("QuotedPrice").alias("_it_quoted"),
        F.sum("PriceApproved").alias("_it_approved"),
        F.count(live_item).alias("_it_count"),
        F.sum(F.when(eligible, approved_part)).alias("_ad_reference"),
        F.sum(F.when(eligible & adherent, approved_part)).alias("_ad_adherent"),
    )


def eligible_labor_flag(items: DataFrame, labors: DataFrame, whitelist: DataFrame, repeated: bool = False) -> DataFrame:
    """items + boolean _labor_ok (labor name in the whitelist); ``repeated``: + _labor_rows, how many rows say so."""
    w = whitelist.select(F.col("labor_name").alias("LaborName")).distinct()
    ok = (labors.join(F.broadcast(w), "LaborName", "left_semi")
          .select(F.col("Sk_MaintenanceLabor").alias("_ok_labor"), F.lit(True).alias("_labor_ok")))
    if repeated:
        ok = ok.groupBy("_ok_labor", "_labor_ok").agg(F.count(F.lit(1)).alias("_labor_rows"))
    # the labor dimension is not size-bounded by construction: Spark broadcasts
    # it only when its (estimated / runtime) size is under the threshold
    out = items.join(ok, items["Sk_MaintenanceLabor"] == ok["_ok_labor"], "left")
    return out.withColumn("_labor_ok", F.coalesce(F.col("_labor_ok"), F.lit(False)))


def fanout_multiplicity(protocols: DataFrame, attendances: DataFrame) -> DataFrame:
    """Per order: how many rows the protocol x attendance left joins produce.

    Each protocol of the order contributes max(1, its attendances); an order
    without protocols is absent here (multiplicity 1).  Item sums and counts
    of the original query are multiplied by this number.
    """
    att = attendances.groupBy("Sk_MaintenanceProtocol").agg(F.count(F.lit(1)).alias("_n_att"))
    per_protocol = protocols.join(att, "Sk_MaintenanceProtocol", "left").select(
        F.col("ProtocolSourceCode").alias("_fo_order"),
        F.coalesce(F.col("_n_att"), F.lit(1)).alias("_rows"))
    return (per_protocol.filter(F.col("_fo_order").isNotNull())
            .groupBy("_fo_order").agg(F.sum("_rows").cast("long").alias("_fo_mult")))


def interaction_counts(history: DataFrame) -> DataFrame:
    """Per order: distinct minutes with a review (11) and with a quote (14) event.

    Minutes are de-duplicated first ((order, code, minute) distinct, partially
    aggregated map-side), then counted with plain conditional sums, which
    avoids the row expansion of two COUNT(DISTINCT) in one aggregate.
    """
    h = history.filter(F.col("cd_evento_manutencao_oficina").isin(R.EVENT_REVIEW, R.EVENT_QUOTE))
    minutes = h.select(
        F.col("cd_manutencao_oficina").alias("order_code"),
        F.col("cd_evento_manutencao_oficina").alias("code"),
        minute_text("dt_modificacao").alias("minute"),
    ).distinct()
    has = F.col("minute").isNotNull()
    return minutes.groupBy("order_code").agg(
        F.count(F.when(has & (F.col("code") == R.EVENT_REVIEW), 1)).alias("total_revisao"),
        F.count(F.when(has & (F.col("code") == R.EVENT_QUOTE), 1)).alias("total_cotacao"),
    )


def severity_label(value, lo, hi, mtype) -> "Column":
    """'Preventiva' when the type contains it; else by the family's thresholds:
    value > hi -> alta, lo <= value <= hi -> media, value < lo -> baixa; an
    unlisted family (NULL bounds) or a NULL value -> alta."""
    return (F.when(mtype.like("%Preventiva%"), F.lit("Preventiva"))
            .when(value > hi, F.lit("alta_monta"))
            .when(value >= lo, F.lit("media_monta"))
            .when(value < lo, F.lit("baixa_monta"))
            .otherwise(F.lit("alta_monta")))


def severity(df: DataFrame, thresholds: DataFrame, family_col: str = "familia_do_modelo",
             value_col: str = "_valor_os", type_col: str = "MaintenanceType",
             out: str = "_monta") -> DataFrame:
    """Severity class per row; the threshold table (one row per family) is joined by family."""
    th = thresholds.select(F.col("family").alias("_th_family"), F.col("lo").alias("_th_lo"),
                           F.col("hi").alias("_th_hi"))
    keep = df.columns
    joined = df.join(F.broadcast(th), df[family_col] == th["_th_family"], "left")
    label = severity_label(F.col(value_col), F.col("_th_lo"), F.col("_th_hi"), F.col(type_col))
    return joined.select(*keep, label.alias(out))


def severity_factor(df: DataFrame, factors: DataFrame, severity_col: str = "_monta",
                    out: str = "fator_correcao_monta") -> DataFrame:
    f = factors.select(F.col("severity").alias("_sf_sev"), F.col("factor").alias(out))
    return df.join(F.broadcast(f), df[severity_col] == f["_sf_sev"], "left").drop("_sf_sev")


def standard_minutes(df: DataFrame, minutes: DataFrame, kind_col: str = "_tipo_manutencao",
                     band_col: str = "_faixa_qtde_itens", out: str = "tempo_padrao") -> DataFrame:
    m = minutes.select(F.col("kind").alias("_sm_kind"), F.col("band").alias("_sm_band"),
                       F.col("minutes").cast("int").alias(out))
    cond = (df[kind_col] == m["_sm_kind"]) & (df[band_col] == m["_sm_band"])
    return df.join(F.broadcast(m), cond, "left").drop("_sm_kind", "_sm_band")


def classify_order(df: DataFrame, thresholds: DataFrame, factors: DataFrame,
                   minutes: DataFrame) -> DataFrame:
    """Kind, item band, vehicle family, standard minutes, severity and its factor.

    Expects _valor_os, n_items, MaintenanceTypeDescription, MaintenanceType,
    maintenancemodelfamily, familycategory; kind and family are taken if they are there already.  The three rule tables are joined
    by equality on the derived keys (all broadcast: fixed row counts).
    """
    derived = {
        "_tipo_manutencao": lambda: maintenance_kind("MaintenanceTypeDescription", "MaintenanceType"),
        "_faixa_qtde_itens": lambda: item_band("n_items"),
        "familia_do_modelo": lambda: vehicle_family("maintenancemodelfamily", "familycategory"),
    }
    keep = [c for c in df.columns if c not in derived]
    out = df.withColumns({name: make() for name, make in derived.items() if name not in df.columns})
    m = minutes.select(F.col("kind").alias("_sm_kind"), F.col("band").alias("_sm_band"),
                       F.col("minutes").cast("int").alias("tempo_padrao"))
    th = thresholds.select(F.col("family").alias("_th_family"), F.col("lo").alias("_th_lo"),
                           F.col("hi").alias("_th_hi"))
    out = (out.join(F.broadcast(m), (F.col("_tipo_manutencao") == F.col("_sm_kind"))
                    & (F.col("_faixa_qtde_itens") == F.col("_sm_band")), "left")
           .join(F.broadcast(th), F.col("familia_do_modelo") == F.col("_th_family"), "left"))
    out = out.withColumn("_monta", severity_label(F.col("_valor_os"), F.col("_th_lo"),
                                                  F.col("_th_hi"), F.col("MaintenanceType")))
    f = factors.select(F.col("severity").alias("_sf_sev"), F.col("factor").alias("fator_correcao_monta"))
    out = out.join(F.broadcast(f), F.col("_monta") == F.col("_sf_sev"), "left")
    return out.select(*keep, "_tipo_manutencao", "_faixa_qtde_itens", "familia_do_modelo",
                      "tempo_padrao", "_monta", "fator_correcao_monta")


def customer_classes(df: DataFrame, customer_rules: DataFrame, customer_col: str = "CustomerId") -> DataFrame:
    """Add _cr_quote_class and _cr_market_class, the customer's class as the quote and the market rule ask for it."""
    # a customer may be in two classes: each rule asks for its own
    cr = customer_rules.groupBy(F.col("customer_id").alias("_cr_id")).agg(
        F.when(F.max((F.col("class") == "special").cast("int")) == 1, F.lit("special"))
        .otherwise(F.min("class")).alias("_cr_quote_class"),
        F.when(F.max((F.col("class") == "public").cast("int")) == 1, F.lit("public"))
        .otherwise(F.min("class")).alias("_cr_market_class"))
    # customer rules are a parameter table; no hint: broadcast is decided from its size
    return df.join(cr, df[customer_col] == cr["_cr_id"], "left").drop("_cr_id")


def extra_minutes(df: DataFrame, customer_rules: DataFrame, customer_col: str = "CustomerId"
                  ) -> DataFrame:
    """Interaction and public-market extra minutes.

    Expects total_int_rev, total_int_cot (NULL when the order has no
    history), n_items; the customer class comes from the customer rule table,
    unless ``customer_classes`` has added it already.
    """
    keep = [c for c in df.columns if c not in ("_cr_quote_class", "_cr_market_class")]
    out = df if "_cr_quote_class" in df.columns else customer_classes(df, customer_rules, customer_col)
    rev = extra_review_minutes("total_int_rev")
    quote = extra_quote_minutes("total_int_cot", "_cr_quote_class")
    return out.select(
        *keep,
        rev.alias("tempo_extra_revisao"),
        quote.alias("tempo_extra_cotacao"),
        extra_public_market_minutes("n_items", "_cr_market_class").alias("tempo_extra_mercadopublico"),
        (F.col("total_int_rev") + F.col("total_int_cot")).alias("total_interacoes"),
        (rev + quote).alias("tempo_extra_interacao"),
    )


def weigh(df: DataFrame) -> DataFrame:
    """Total minutes T, daily target and the order weight."""
    total = (F.col("tempo_padrao") + F.col("tempo_extra_interacao")
             + F.col("tempo_extra_mercadopublico")).cast("decimal(20,1)")
    return df.withColumns({
        "tempo_total": total,
        "fator_correcao_precoparceiro": F.when(F.col("preco_parceiro"), F.lit(R.PARTNER_PRICE_FACTOR))
                                         .otherwise(F.lit(1).cast("decimal(2,1)")),
        "meta_os_dia_corrigido": daily_target(total, "fator_correcao_monta", "preco_parceiro"),
        "peso_os": order_weight(total, "fator_correcao_monta", "preco_parceiro"),
    })
