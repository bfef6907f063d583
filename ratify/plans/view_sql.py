"""The approval fact as one SQL text over catalog names, for a view that is stored.

The text is made from the same rules (``sources.rules``, or governed rule
tables) and the same options as ``plans.fact.approval_fact``; only names of
catalog tables go into it, so a later session, or a client that knows no
Python, reads the fact by the view's name.  It has the shape of the DataFrame
plan: the 1:N sides are aggregated by order before they meet the order, and the weekly
totals are an aggregate joined back.  Two things differ: LEAD is a plain
window over (customer, member), and the partner price is a plain range join
on (customer, member), without buckets by year.

Keys of orders and dimensions are taken as unique, as by the fact's default.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ratify.plans.fact import OUTPUT_COLUMNS, FactOptions, RuleTables
from ratify.sources import rules as R
from ratify.sources.rules import sql_literal
from ratify.sources.schemas import SOURCE_SCHEMAS


def _listed(values) -> str:
    return ", ".join(sql_literal(v) for v in values)


def _rule_cte(name: str, table: DataFrame) -> str:
    """A rule table as literal rows; the rule tables are bounded by the bands, kinds and families they rate."""
    rows = [tuple(r) for r in table.collect()]
    casts = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS {f.name}" for i, f in enumerate(table.schema.fields))
    columns = ", ".join(f"c{i}" for i in range(len(table.columns)))
    values = ", ".join(f"({_listed(row)})" for row in rows)
    return f"{name} AS (SELECT {casts} FROM VALUES {values} AS t({columns}))"


def _parsed(column: str, strip: bool) -> str:
    text = f"coalesce({column}, '')"
    text = f"regexp_replace({text}, r'\\s+', '')" if strip else text
    return f"array_distinct(filter(split({text}, '[;,]+'), x -> x <> ''))"


def fact_view_sql(names: Mapping[str, str], rules: RuleTables, opts: FactOptions | None = None) -> str:
    """The SQL text.  ``names`` gives the catalog table of each of the thirteen sources, and of ``roster`` and
    ``customer_rules``; without a roster nobody works Saturdays."""
    opts = opts or FactOptions()
    lacking = [n for n in [*SOURCE_SCHEMAS, "customer_rules"] if n not in names]
    if lacking:
        raise ValueError(f"no catalog names for {lacking}")
    if opts.days or opts.approvers is not None or opts.extras or opts.duplicates != "unique":
        raise ValueError("a stored view has the whole fact; filter what is read from it")
    roster = (f"SELECT DISTINCT web_user_name AS member FROM {names['roster']} WHERE web_user_name IS NOT NULL"
              if "roster" in names else "SELECT CAST(NULL AS STRING) AS member WHERE FALSE")
    weekday = "TRUE" if opts.weekday_policy == "none" else (
        f"a._aprovador IS NOT NULL AND c.WeekDayNumber <= CASE WHEN r.member IS NOT NULL THEN {R.LAST_WEEKDAY_ROSTER} "
        f"ELSE {R.LAST_WEEKDAY} END")
    stage = (lambda c: f"CAST({c} AS DATE)") if opts.sla_grain == "date" else (lambda c: c)
    fan = "coalesce(fo.fan, 1)" if opts.item_fanout == "faithful" else "1"
    matches = "coalesce(m.n, 1)" if opts.price_match == "faithful" else "1"
    repeat = "LATERAL VIEW explode(sequence(1L, n_rows)) x AS copy" if opts.price_match == "faithful" else ""
    open_day = f"(HolidayOrBridge IS NULL OR HolidayOrBridge = {sql_literal(R.BRIDGE_LABEL)})"
    workday = R.WORKDAY_END_MINUTE - R.WORKDAY_START_MINUTE
    band = " ".join(f"WHEN n_items <= {upper} THEN {sql_literal(label)}" for upper, label in R.ITEM_BANDS if upper is not None)

    def place(tag: str, moment: str) -> str:
        inside = f"least(greatest(hour({moment}) * 60 + minute({moment}) - {R.WORKDAY_START_MINUTE}, 0), {workday})"
        return f"{tag}.before + CASE WHEN {tag}.open THEN {inside} ELSE 0 END"

    parts = [
        _rule_cte("r_minutes", rules.minutes), _rule_cte("r_thresholds", rules.thresholds),
        _rule_cte("r_factors", rules.factors), _rule_cte("r_labors", rules.labor_whitelist),
        f"""r_customers AS (
  SELECT customer_id, max(class = 'special') AS special, max(class = 'public') AS public
  FROM {names['customer_rules']} GROUP BY customer_id)""",
        f"""days AS (
  SELECT ReferenceDate, WeekDayNumber <= {R.LAST_WEEKDAY} AND {open_day} AS open,
         coalesce(sum(CASE WHEN WeekDayNumber <= {R.LAST_WEEKDAY} AND {open_day} THEN {workday} ELSE 0 END)
                  OVER (ORDER BY ReferenceDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM {names['dates']})""",
        f"""members AS (SELECT Sk_WebUser, coalesce(IsInternalUser, FALSE) AS internal, WebUserName FROM {names['users']})""",
        f"""roles AS (
  SELECT s.*, coalesce(u1.internal, FALSE) AS i1, coalesce(u2.internal, FALSE) AS i2, coalesce(u3.internal, FALSE) AS i3,
         coalesce(u4.internal, FALSE) AS i4, u1.WebUserName AS n1, u2.WebUserName AS n2, u3.WebUserName AS n3, u4.WebUserName AS n4
  FROM {names['services']} s
  LEFT JOIN members u1 ON u1.Sk_WebUser = s.Sk_FirstApprover LEFT JOIN members u2 ON u2.Sk_WebUser = s.Sk_SecondApprover
  LEFT JOIN members u3 ON u3.Sk_WebUser = s.Sk_ThirdApprover LEFT JOIN members u4 ON u4.Sk_WebUser = s.Sk_ServiceOrderApprover
  WHERE s.IsAutomaticApproval = FALSE)""",
        """attributed AS (
  SELECT *, i1 OR i2 OR i3 AS OS_Aprovada,
         CASE WHEN i1 THEN FistBudgetSentTimestamp WHEN i2 THEN FirstApprovalTimestamp WHEN i3 THEN SecondApprovalTimestamp END AS t1,
         CASE WHEN i1 THEN FirstApprovalTimestamp WHEN i2 THEN SecondApprovalTimestamp WHEN i3 THEN ThirdApprovalTimestamp END AS t2,
         CAST(CASE WHEN i1 THEN FirstApprovalTimestamp WHEN i2 THEN SecondApprovalTimestamp WHEN i3 THEN ThirdApprovalTimestamp
                   WHEN i4 THEN DisapprovalTimestamp END AS DATE) AS data_aprovacao,
         CASE WHEN i1 THEN n1 WHEN i2 THEN n2 WHEN i3 THEN n3 WHEN i4 THEN n4 END AS _aprovador
  FROM roles WHERE i1 OR i2 OR i3 OR i4)""",
        f"""roster AS ({roster})""",
        f"""kept AS (
  SELECT a.*, c.YearWeek, c.WeekDayNumber, c.HolidayOrBridge
  FROM attributed a JOIN {names['dates']} c ON c.ReferenceDate = a.data_aprovacao
  LEFT JOIN roster r ON r.member = a._aprovador
  WHERE c.ReferenceDate >= DATE {sql_literal(opts.start_date)} AND {open_day} AND {weekday})""",
        f"""priced_items AS (
  SELECT i.*, coalesce(PartPriceNegociatedCustomer, PartPriceNegociated, PartPriceReferenceCustomer, PartReferencePrice) AS reference,
         CancellationTimestamp IS NULL AND l.Sk_MaintenanceLabor IS NOT NULL AND PartQuantity >= {R.MIN_QUANTITY}
         AND PartUnitaryPrice > {R.MIN_UNIT_PRICE} AS counts
  FROM {names['items']} i
  LEFT JOIN (SELECT Sk_MaintenanceLabor FROM {names['labors']} WHERE LaborName IN (SELECT labor_name FROM r_labors)) l
    ON l.Sk_MaintenanceLabor = i.Sk_MaintenanceLabor)""",
        """item_sums AS (
  SELECT MaintenanceId, sum(QuotedPrice) AS quoted, sum(PriceApproved) AS approved,
         count(CASE WHEN CancellationTimestamp IS NULL THEN Sk_MaintenanceItem END) AS live,
         sum(CASE WHEN counts AND reference IS NOT NULL THEN PartPriceApproved END) AS referenced,
         sum(CASE WHEN counts AND reference >= PartUnitaryPrice THEN PartPriceApproved END) AS adherent
  FROM priced_items GROUP BY MaintenanceId)""",
        f"""fans AS (
  SELECT p.ProtocolSourceCode, sum(coalesce(a.n, 1)) AS fan
  FROM {names['protocols']} p
  LEFT JOIN (SELECT Sk_MaintenanceProtocol, count(*) AS n FROM {names['attendances']} GROUP BY Sk_MaintenanceProtocol) a
    ON a.Sk_MaintenanceProtocol = p.Sk_MaintenanceProtocol
  GROUP BY p.ProtocolSourceCode)""",
        f"""interactions AS (
  SELECT code, count(CASE WHEN event = {R.EVENT_REVIEW} THEN moment END) AS reviews,
         count(CASE WHEN event = {R.EVENT_QUOTE} THEN moment END) AS quotes
  FROM (SELECT DISTINCT cd_manutencao_oficina AS code, cd_evento_manutencao_oficina AS event,
               substring(CAST(dt_modificacao AS STRING), 1, 16) AS moment
        FROM {names['history']} WHERE cd_evento_manutencao_oficina IN ({R.EVENT_REVIEW}, {R.EVENT_QUOTE}))
  GROUP BY code)""",
        f"""measured AS (
  SELECT k.*, st.StatusTypeDescription, v.CustomerId, ty.MaintenanceType, me.NameMerchantsTypes,
         it.quoted * {fan} AS valor_orcado, it.approved * {fan} AS _valor_aprovado, coalesce(it.live, 0) * {fan} AS n_items,
         it.referenced, it.adherent, ix.reviews AS total_int_rev, ix.quotes AS total_int_cot,
         coalesce(rc.special, FALSE) AS special, coalesce(rc.public, FALSE) AS public,
         CASE WHEN k.MaintenanceTypeDescription = {sql_literal(R.KIND_CLAIM)} THEN {sql_literal(R.KIND_CLAIM)}
              WHEN ty.MaintenanceType = {sql_literal(R.KIND_PREVENTIVE)} THEN {sql_literal(R.KIND_PREVENTIVE)}
              ELSE {sql_literal(R.KIND_CORRECTIVE)} END AS _tipo_manutencao,
         CASE WHEN v.maintenancemodelfamily NOT IN ({_listed(R.FAMILY_UNKNOWN)}) THEN v.maintenancemodelfamily
              WHEN v.familycategory NOT IN ({_listed(R.CATEGORY_UNKNOWN)}) THEN v.familycategory
              ELSE {sql_literal(R.FAMILY_DEFAULT)} END AS familia_do_modelo,
         CAST(({place('d2', 'k.t2')}) - ({place('d1', 'k.t1')}) AS BIGINT) AS sla
  FROM kept k
  LEFT JOIN item_sums it ON it.MaintenanceId = k.OrderServiceCode
  LEFT JOIN fans fo ON fo.ProtocolSourceCode = k.OrderServiceCode
  LEFT JOIN interactions ix ON ix.code = k.OrderServiceCode
  LEFT JOIN {names['statuses']} st ON st.Sk_ServiceOrderStatusType = k.Sk_ServiceOrderStatusType
  LEFT JOIN {names['vehicles']} v ON v.Sk_MaintenanceVehicle = k.Sk_MaintenanceVehicle
  LEFT JOIN {names['types']} ty ON ty.Sk_MaintenanceType = k.Sk_MaintenanceType
  LEFT JOIN {names['merchants']} me ON me.Sk_MaintenanceMerchant = k.Sk_MaintenanceMerchant
  LEFT JOIN r_customers rc ON rc.customer_id = v.CustomerId
  LEFT JOIN days d1 ON d1.ReferenceDate = CAST(k.t1 AS DATE) LEFT JOIN days d2 ON d2.ReferenceDate = CAST(k.t2 AS DATE))""",
        f"""banded AS (SELECT *, CASE {band} ELSE {sql_literal(R.ITEM_BANDS[-1][1])} END AS _faixa_qtde_itens FROM measured)""",
        f"""graded AS (
  SELECT b.*, mi.minutes AS standard,
         CASE WHEN b.MaintenanceType LIKE '%Preventiva%' THEN 'Preventiva' WHEN b.valor_orcado > th.hi THEN 'alta_monta'
              WHEN b.valor_orcado >= th.lo THEN 'media_monta' WHEN b.valor_orcado < th.lo THEN 'baixa_monta'
              ELSE 'alta_monta' END AS _monta,
         CASE WHEN total_int_rev >= 1 THEN total_int_rev * {R.MINUTES_PER_REVIEW} ELSE 0 END
         + CASE WHEN special AND total_int_cot >= {R.SPECIAL_QUOTE_CAP_AT} THEN {R.SPECIAL_QUOTE_CAP}
                WHEN special AND total_int_cot >= 1 THEN total_int_cot * {R.MINUTES_PER_QUOTE}
                WHEN total_int_cot >= 1 THEN {R.MINUTES_PER_QUOTE} ELSE 0 END AS talking,
         CAST(CASE WHEN public THEN n_items + {R.PUBLIC_MARKET_BASE}
                   WHEN special THEN n_items * {R.SPECIAL_ITEM_MULTIPLIER}BD + {R.PUBLIC_MARKET_BASE} ELSE 0 END AS DECIMAL(20,1)) AS market
  FROM banded b
  LEFT JOIN r_minutes mi ON mi.kind = b._tipo_manutencao AND mi.band = b._faixa_qtde_itens
  LEFT JOIN r_thresholds th ON th.family = b.familia_do_modelo)""",
        f"""changes AS (
  SELECT ClientId AS customer, CAST(ParameterLogOrgValueModificationTimestamp AS TIMESTAMP_NTZ) AS ts,
         {_parsed('OldValueDescription', opts.strip_whitespace)} AS old_set,
         {_parsed('NewValueDescription', opts.strip_whitespace)} AS new_set
  FROM {names['param_log']} WHERE ParameterId = {R.PARTNER_PRICE_PARAMETER_ID})""",
        """events AS (
  SELECT customer, ts, explode(array_except(new_set, old_set)) AS member, 1 AS adds FROM changes
  UNION ALL
  SELECT customer, ts, explode(array_except(old_set, new_set)) AS member, 0 AS adds FROM changes)""",
        f"""intervals AS (
  SELECT e.customer, u.WebUserName AS name, CAST(e.ts AS DATE) AS first_day,
         coalesce(CAST(e.next_ts AS DATE), DATE {sql_literal(R.OPEN_END[:10])}) AS last_day
  FROM (SELECT *, lead(ts) OVER (PARTITION BY customer, member ORDER BY ts, adds) AS next_ts FROM events) e
  JOIN {names['users']} u ON trim(CAST(u.WebUserSourceCode AS STRING)) = e.member
  WHERE e.adds = 1)""",
        """matches AS (
  SELECT g.OrderServiceCode, count(*) AS n
  FROM graded g JOIN intervals i ON i.customer = g.CustomerId AND i.name = g._aprovador
                                AND g.data_aprovacao BETWEEN i.first_day AND i.last_day
  GROUP BY g.OrderServiceCode)""",
        f"""priced AS (
  SELECT g.*, m.n IS NOT NULL AS preco_parceiro, CAST({matches} AS BIGINT) AS n_rows,
         CAST(g.standard + g.talking + g.market AS DECIMAL(20,1)) AS minutes,
         CAST(fa.factor AS DECIMAL(2,1)) * CASE WHEN m.n IS NOT NULL THEN {R.PARTNER_PRICE_FACTOR}BD ELSE 1.0BD END AS correction
  FROM graded g LEFT JOIN matches m ON m.OrderServiceCode = g.OrderServiceCode
  LEFT JOIN r_factors fa ON fa.severity = g._monta)""",
        f"""weighted AS (
  SELECT *, CAST(round(minutes * correction / {R.DAILY_MINUTES}BD, 2) AS DECIMAL(18,2)) AS peso_os,
         CASE WHEN NameMerchantsTypes <> {sql_literal(R.DEALERSHIP_MERCHANT_TYPE)} THEN referenced * n_rows END AS total_aprovado_referencial,
         CASE WHEN NameMerchantsTypes <> {sql_literal(R.DEALERSHIP_MERCHANT_TYPE)} THEN adherent * n_rows END AS total_aprovado_aderente,
         {stage('t1')} AS _data_sla1, {stage('t2')} AS _data_sla2,
         CASE WHEN sla < 0 THEN '-' ELSE '' END || format_string('%02d', abs(sla) DIV 60) || ':'
           || lpad(CAST(abs(sla) % 60 AS STRING), 2, '0') AS sla_aprovocao
  FROM priced)""",
        f"""by_day AS (
  SELECT YearWeek, _aprovador, data_aprovacao, sum(peso_os * n_rows) AS weight,
         sum(CASE WHEN OrderServiceCode IS NOT NULL THEN n_rows ELSE 0 END) AS orders,
         max(CASE WHEN WeekDayNumber <= {R.LAST_WEEKDAY} AND {open_day} THEN 1 ELSE 0 END) AS workday
  FROM weighted GROUP BY YearWeek, _aprovador, data_aprovacao)""",
        """by_week AS (
  SELECT YearWeek, _aprovador, CAST(sum(weight) AS DECIMAL(38,2)) AS soma_peso_os_semana_aprovador,
         CAST(sum(orders) AS BIGINT) AS total_os_semana_aprovador,
         CASE WHEN YearWeek IS NOT NULL AND _aprovador IS NOT NULL THEN nullif(sum(workday), 0) END AS total_dias_uteis_semana
  FROM by_day GROUP BY YearWeek, _aprovador)""",
        """fact AS (
  SELECT w.*, k.soma_peso_os_semana_aprovador, k.total_os_semana_aprovador, k.total_dias_uteis_semana,
         CAST(k.total_os_semana_aprovador AS DOUBLE) / k.total_dias_uteis_semana AS media_diaria_os_aprovador,
         k.soma_peso_os_semana_aprovador / k.total_dias_uteis_semana AS produtividade_semana_aprovador
  FROM weighted w LEFT JOIN by_week k ON k.YearWeek <=> w.YearWeek AND k._aprovador <=> w._aprovador)""",
    ]
    order = ("\nORDER BY _aprovador, data_aprovacao, _tipo_manutencao, _faixa_qtde_itens" if opts.order_output else "")
    return "WITH " + ",\n".join(parts) + f"\nSELECT {', '.join(OUTPUT_COLUMNS)}\nFROM fact {repeat}{order}"


def store_fact_view(spark: SparkSession, view: str, names: Mapping[str, str], rules: RuleTables,
                    opts: FactOptions | None = None) -> str:
    """Keep the fact as a view of the catalog; any session of that catalog reads it by name."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {fact_view_sql(names, rules, opts)}")
    return view
