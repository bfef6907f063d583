"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark plans: the domain tables are derived from
the driver tables with SQL expressions, and the semantics are expressed the
plain relational way (join everything, then aggregate; window functions for
the weekly totals) rather than the pre-aggregated Spark plans.  The views
region, nation, customer, supplier, part, orders, lineitem and events are
registered by the caller.
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Analog source derivations (one CTE each)
# ---------------------------------------------------------------------------

SRC = {}

SRC["users"] = """
users AS (
  SELECT CAST(n_nationkey AS BIGINT) AS Sk_WebUser,
         CAST(n_nationkey AS VARCHAR) AS WebUserSourceCode,
         CASE WHEN n_nationkey = 12 THEN NULL ELSE n_name END AS WebUserName,
         CASE WHEN n_regionkey = 4 THEN NULL ELSE n_regionkey IN (0, 1, 2) END AS IsInternalUser
  FROM nation)"""

SRC["services"] = """
services AS (
  SELECT o_orderkey AS OrderServiceCode,
         o_orderstatus = 'O' AS IsExternalApproval,
         CASE WHEN o_totalprice < 20000 THEN TRUE
              WHEN o_totalprice < 40000 AND o_orderstatus = 'P' THEN NULL
              ELSE FALSE END AS IsAutomaticApproval,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 10 AS BIGINT)) AS FistBudgetSentTimestamp,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(10 + o_orderkey % 30 AS BIGINT)) AS FirstApprovalTimestamp,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(40 + o_orderkey % 40 AS BIGINT)) END AS SecondApprovalTimestamp,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(80 + o_orderkey % 50 AS BIGINT)) AS ThirdApprovalTimestamp,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(5 + o_orderkey % 20 AS BIGINT)) AS DisapprovalTimestamp,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'Sinistro'
              ELSE o_orderpriority END AS MaintenanceTypeDescription,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS Sk_ServiceOrderStatusType,
         o_custkey AS Sk_MaintenanceVehicle,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS Sk_MaintenanceType,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 25 END AS Sk_FirstApprover,
         o_orderkey % 25 AS Sk_SecondApprover,
         (o_orderkey // 25) % 25 AS Sk_ThirdApprover,
         (o_custkey + o_orderkey) % 25 AS Sk_ServiceOrderApprover,
         o_orderkey % 10 AS Sk_MaintenanceMerchant
  FROM orders)"""

SRC["items"] = """
items AS (
  SELECT l_orderkey * 100 + l_linenumber AS Sk_MaintenanceItem,
         l_orderkey AS MaintenanceId,
         l_partkey % 6 AS Sk_MaintenanceLabor,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS QuotedPrice,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS PriceApproved,
         CASE WHEN l_quantity > 10 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.97 AS DECIMAL(3,2)) END AS PartReferencePrice,
         CASE WHEN l_discount >= 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1.02 AS DECIMAL(3,2)) END AS PartPriceReferenceCustomer,
         CASE WHEN l_tax >= 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.98 AS DECIMAL(3,2)) END AS PartPriceNegociated,
         CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A'
              THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(3,2)) END AS PartPriceNegociatedCustomer,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS PartUnitaryPrice,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS PartPriceApproved,
         CAST(l_quantity AS DECIMAL(18,3)) - 1 AS PartQuantity,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS TIMESTAMP) END AS CancellationTimestamp
  FROM lineitem)"""

SRC["vehicles"] = """
vehicles AS (
  SELECT c_custkey AS Sk_MaintenanceVehicle, c_custkey AS CustomerId,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Leve' WHEN 'BUILDING' THEN 'Caminhao'
              WHEN 'MACHINERY' THEN 'Nao Identificado'
              WHEN 'HOUSEHOLD' THEN CASE WHEN c_acctbal < 0 THEN 'Trator Especial' ELSE 'Pickup Media' END
         END AS maintenancemodelfamily,
         CASE c_nationkey % 3 WHEN 0 THEN 'Pesado' WHEN 1 THEN 'Nao Identificado' END AS familycategory
  FROM customer)"""

SRC["customer_rules"] = """
customer_rules AS (
  SELECT customer_id, class FROM (
    SELECT c_custkey AS customer_id,
           CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 5000 THEN 'public'
                WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 8000 THEN 'special' END AS class
    FROM customer) WHERE class IS NOT NULL)"""

SRC["types"] = """
types(Sk_MaintenanceType, MaintenanceType) AS (
  VALUES (1::BIGINT, 'Corretiva'), (2, 'Preventiva'), (3, 'Preventiva Programada'),
         (4, 'Corretiva'), (5, NULL))"""

SRC["statuses"] = """
statuses(Sk_ServiceOrderStatusType, StatusTypeDescription) AS (
  VALUES (1::BIGINT, 'Finalizada'), (2, 'Em Aberto'), (3, 'Parcial'))"""

SRC["labors"] = """
labors(Sk_MaintenanceLabor, LaborName) AS (
  VALUES (0::BIGINT, 'SUBSTITUIR'), (1, 'SUBSTITUIR COM REVISAO CUBO'),
         (2, 'SUBSTITUIR SEM REVISAO CUBO'), (3, 'FORNECIMENTO DE PECAS'),
         (4, 'REPARAR'), (5, 'MAO DE OBRA'))"""

SRC["protocols"] = """
protocols AS (
  SELECT o_orderkey AS Sk_MaintenanceProtocol, o_orderkey AS ProtocolSourceCode
  FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F')"""

SRC["attendances"] = """
attendances AS (
  SELECT l_orderkey AS Sk_MaintenanceProtocol FROM lineitem
  WHERE l_returnflag = 'A' AND l_linestatus = 'O')"""

SRC["history"] = """
history AS (
  SELECT user_id * 31 + dayofmonth(ts) AS cd_manutencao_oficina,
         CAST(CASE event_type WHEN 'click' THEN 11 WHEN 'view' THEN 14 WHEN 'purchase' THEN 12
              ELSE 0 END AS INTEGER) AS cd_evento_manutencao_oficina,
         CAST(ts AS TIMESTAMP) AS dt_modificacao
  FROM events)"""

SRC["param_log"] = """
param_log AS (
  SELECT o_custkey AS ClientId,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 586 ELSE 590 END AS ParameterId,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_orderkey % 8 AS BIGINT)) AS ParameterLogOrgValueModificationTimestamp,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE CAST((o_custkey + o_orderkey) % 25 AS VARCHAR) || ',' || CAST(o_orderkey % 25 AS VARCHAR) || ';;'
         END AS OldValueDescription,
         COALESCE(CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey % 25 END AS VARCHAR), '')
           || ' ;' || CAST(o_orderkey % 25 AS VARCHAR) || ', ' || CAST((o_orderkey // 25) % 25 AS VARCHAR)
           AS NewValueDescription
  FROM orders)"""

SRC["merchants"] = """
merchants AS (
  SELECT s_suppkey AS Sk_MaintenanceMerchant,
         CASE WHEN s_acctbal < 0 THEN 'Concessionaria' WHEN s_nationkey % 4 = 0 THEN NULL
              ELSE 'Oficina' END AS NameMerchantsTypes
  FROM supplier)"""

SRC["roster"] = """
roster AS (SELECT n_name AS web_user_name FROM nation WHERE n_regionkey = 1)"""

SRC["hierarchy"] = """
hierarchy AS (
  SELECT lower(n_name) || '@ops.example' AS consultant_email,
         CASE WHEN n_nationkey = 12 THEN NULL ELSE n_name END AS consultant_name,
         lower(r_name) || '@ops.example' AS supervisor_email,
         r_name AS supervisor_name, r_name AS portfolio
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SRC["reporting"] = """
reporting AS (
  SELECT consultant_email, consultant_name, supervisor_email FROM hierarchy
  UNION ALL
  SELECT lower(l.r_name) || '@ops.example', l.r_name, lower(h.r_name) || '@ops.example'
  FROM region l LEFT JOIN region h
    ON h.r_regionkey = CASE l.r_regionkey WHEN 4 THEN 2 WHEN 2 THEN 1 WHEN 1 THEN 4 WHEN 3 THEN 0 END)"""

SRC["audit"] = """
audit AS (
  SELECT l_orderkey AS OrderServiceCode, CAST(l_extendedprice AS DECIMAL(18,2)) AS disallowed_amount
  FROM lineitem WHERE l_returnflag = 'R')"""

SRC["sla_target"] = """
sla_target AS (
  SELECT c_custkey AS customer_id,
         CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 24 WHEN 'BUILDING' THEN 48
              WHEN 'MACHINERY' THEN 36 ELSE 72 END AS DECIMAL(9,2)) AS target_hours
  FROM customer)"""

# Calendar: every day from the first order date to the last + 14 days.
SRC["calendar"] = """
calendar AS (
  SELECT d AS ReferenceDate,
         isoyear(d) * 100 + week(d) AS YearWeek,
         isodow(d) - 1 AS WeekDayNumber,
         CASE WHEN strftime(d, '%m-%d') IN ('12-24', '12-31') THEN 'Bridge'
              WHEN strftime(d, '%m-%d') IN ('01-01', '04-21', '05-01', '09-07', '10-12', '11-02',
                                            '11-15', '12-25') THEN 'Holiday' END AS HolidayOrBridge
  FROM (SELECT CAST(g AS DATE) AS d
        FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo,
                     max(CAST(o_orderdate AS DATE)) + 14 AS hi FROM orders) b,
             generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) t(g)))"""

# Rule tables
SRC["bands"] = """
bands(lo, hi, label) AS (
  VALUES (NULL::BIGINT, 3::BIGINT, '01-03'), (4, 5, '04-05'), (6, 7, '06-07'), (8, 10, '08-10'),
         (11, 20, '11-20'), (21, 30, '21-30'), (31, 40, '31-40'), (41, 50, '41-50'),
         (51, NULL, '50 ou mais'))"""

SRC["std_minutes"] = """
std_minutes(kind, band, minutes) AS (
  VALUES ('Corretiva', '01-03', 8), ('Corretiva', '04-05', 12), ('Corretiva', '06-07', 14),
         ('Corretiva', '08-10', 20), ('Corretiva', '11-20', 25), ('Corretiva', '21-30', 35),
         ('Corretiva', '31-40', 45), ('Corretiva', '41-50', 55), ('Corretiva', '50 ou mais', 65),
         ('Preventiva', '01-03', 6), ('Preventiva', '04-05', 8), ('Preventiva', '06-07', 10),
         ('Preventiva', '08-10', 14), ('Preventiva', '11-20', 18), ('Preventiva', '21-30', 25),
         ('Preventiva', '31-40', 45), ('Preventiva', '41-50', 55), ('Preventiva', '50 ou mais', 65),
         ('Sinistro', '01-03', 12), ('Sinistro', '04-05', 18), ('Sinistro', '06-07', 21),
         ('Sinistro', '08-10', 30), ('Sinistro', '11-20', 38), ('Sinistro', '21-30', 53),
         ('Sinistro', '31-40', 68), ('Sinistro', '41-50', 83), ('Sinistro', '50 ou mais', 98))"""

# thresholds scaled by the analog factor (20)
SRC["thresholds"] = """
thresholds(family, lo, hi) AS (
  SELECT family, CAST(lo * 20 AS DECIMAL(18,2)), CAST(hi * 20 AS DECIMAL(18,2)) FROM (VALUES
    ('Caminhao Pesado', 15000, 35000), ('Pesado', 15000, 35000), ('Cavalo', 15000, 35000),
    ('Trator Agricola', 15000, 35000), ('Caminhao', 5000, 15000), ('Implemento', 5000, 15000),
    ('Onibus', 5000, 15000), ('Micro Onibus', 5000, 15000), ('Reboque', 5000, 15000),
    ('Pickup Pesada', 5000, 15000), ('Equipamento', 5000, 15000), ('Suv', 5000, 15000),
    ('Pickup Media', 3000, 10000), ('Pickup Leve', 2000, 7000), ('Van', 5000, 15000),
    ('Utilitario', 5000, 15000), ('Leve', 1500, 6000), ('Moto', 600, 2000),
    ('Quadricilo', 600, 2000)) v(family, lo, hi))"""

SRC["factors"] = """
factors(severity, factor) AS (
  VALUES ('baixa_monta', CAST(1.0 AS DECIMAL(2,1))), ('media_monta', CAST(1.3 AS DECIMAL(2,1))),
         ('alta_monta', CAST(1.5 AS DECIMAL(2,1))), ('Preventiva', CAST(1.0 AS DECIMAL(2,1))))"""

SRC["labor_whitelist"] = """
labor_whitelist(labor_name) AS (
  VALUES ('SUBSTITUIR'), ('SUBSTITUIR COM REVISAO CUBO'), ('SUBSTITUIR SEM REVISAO CUBO'),
         ('FORNECIMENTO DE PECAS'))"""

# ---------------------------------------------------------------------------
# Composite steps
# ---------------------------------------------------------------------------

STEP = {}

STEP["attributed"] = """
roles AS (
  SELECT s.*,
         u1.IsInternalUser IS TRUE AS i1, u2.IsInternalUser IS TRUE AS i2,
         u3.IsInternalUser IS TRUE AS i3, ud.IsInternalUser IS TRUE AS idec,
         u1.IsInternalUser AS f1, u2.IsInternalUser AS f2, u3.IsInternalUser AS f3,
         u1.WebUserName AS n1, u2.WebUserName AS n2, u3.WebUserName AS n3, ud.WebUserName AS nd
  FROM services s
  LEFT JOIN users u1 ON u1.Sk_WebUser = s.Sk_FirstApprover
  LEFT JOIN users u2 ON u2.Sk_WebUser = s.Sk_SecondApprover
  LEFT JOIN users u3 ON u3.Sk_WebUser = s.Sk_ThirdApprover
  LEFT JOIN users ud ON ud.Sk_WebUser = s.Sk_ServiceOrderApprover),
attributed AS (
  SELECT r.*,
         (i1 OR i2 OR i3) AS OS_Aprovada,
         (i1 OR i2 OR i3 OR idec) AS any_internal,
         CASE WHEN i1 THEN CAST(FirstApprovalTimestamp AS DATE)
              WHEN i2 THEN CAST(SecondApprovalTimestamp AS DATE)
              WHEN i3 THEN CAST(ThirdApprovalTimestamp AS DATE)
              WHEN idec THEN CAST(DisapprovalTimestamp AS DATE) END AS data_aprovacao,
         CASE WHEN i1 THEN n1 WHEN i2 THEN n2 WHEN i3 THEN n3 WHEN idec THEN nd END AS _aprovador,
         CASE WHEN i1 THEN FistBudgetSentTimestamp WHEN i2 THEN FirstApprovalTimestamp
              WHEN i3 THEN SecondApprovalTimestamp END AS _data_sla1,
         CASE WHEN i1 THEN FirstApprovalTimestamp WHEN i2 THEN SecondApprovalTimestamp
              WHEN i3 THEN ThirdApprovalTimestamp END AS _data_sla2
  FROM roles r)"""

STEP["kept"] = """
kept AS (
  SELECT a.*, c.YearWeek, c.WeekDayNumber, c.HolidayOrBridge
  FROM attributed a JOIN calendar c ON c.ReferenceDate = a.data_aprovacao
  WHERE a.IsAutomaticApproval = FALSE AND a.any_internal
    AND c.ReferenceDate >= DATE '1996-01-01'
    AND (c.HolidayOrBridge IS NULL OR c.HolidayOrBridge = 'Bridge')
    AND ((a._aprovador IN (SELECT web_user_name FROM roster) AND c.WeekDayNumber <= 5)
         OR (a._aprovador NOT IN (SELECT web_user_name FROM roster) AND c.WeekDayNumber <= 4)))"""

STEP["interactions"] = """
interactions AS (
  SELECT cd_manutencao_oficina AS order_code,
         COUNT(DISTINCT CASE WHEN cd_evento_manutencao_oficina = 11
                             THEN strftime(dt_modificacao, '%Y-%m-%d %H:%M') END) AS total_revisao,
         COUNT(DISTINCT CASE WHEN cd_evento_manutencao_oficina = 14
                             THEN strftime(dt_modificacao, '%Y-%m-%d %H:%M') END) AS total_cotacao
  FROM history WHERE cd_evento_manutencao_oficina IN (11, 14)
  GROUP BY cd_manutencao_oficina)"""

# naive fan-out: every protocol x attendance row repeats every item row
STEP["item_sums"] = """
item_sums AS (
  SELECT k.OrderServiceCode,
         SUM(i.QuotedPrice) AS valor_os, SUM(i.PriceApproved) AS valor_aprovado,
         COUNT(CASE WHEN i.CancellationTimestamp IS NULL THEN i.Sk_MaintenanceItem END) AS n_items
  FROM kept k
  LEFT JOIN protocols p ON p.ProtocolSourceCode = k.OrderServiceCode
  LEFT JOIN attendances att ON att.Sk_MaintenanceProtocol = p.Sk_MaintenanceProtocol
  LEFT JOIN items i ON i.MaintenanceId = k.OrderServiceCode
  GROUP BY k.OrderServiceCode)"""

STEP["business_minutes"] = """
bm AS (
  SELECT ReferenceDate, is_b,
         COALESCE(SUM(CASE WHEN is_b THEN 600 ELSE 0 END)
                  OVER (ORDER BY ReferenceDate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS before_min
  FROM (SELECT ReferenceDate,
               (WeekDayNumber <= 4 AND (HolidayOrBridge IS NULL OR HolidayOrBridge = 'Bridge')) AS is_b
        FROM calendar))"""

STEP["classified"] = """
classified AS (
  SELECT k.*, st.StatusTypeDescription, v.CustomerId, ty.MaintenanceType,
         s.valor_os, s.valor_aprovado, s.n_items,
         ix.total_revisao AS total_int_rev, ix.total_cotacao AS total_int_cot,
         cr.class AS customer_class,
         CASE WHEN k.MaintenanceTypeDescription = 'Sinistro' THEN 'Sinistro'
              WHEN ty.MaintenanceType = 'Preventiva' THEN 'Preventiva'
              ELSE 'Corretiva' END AS _tipo_manutencao,
         b.label AS _faixa_qtde_itens,
         CASE WHEN v.maintenancemodelfamily IS NOT NULL
                   AND v.maintenancemodelfamily NOT IN ('Nao Identificado', 'Nao Definido')
              THEN v.maintenancemodelfamily
              WHEN v.familycategory IS NOT NULL AND v.familycategory <> 'Nao Identificado'
              THEN v.familycategory
              ELSE 'Leve' END AS familia_do_modelo,
         (b1.before_min + CASE WHEN b1.is_b THEN LEAST(GREATEST(hour(k._data_sla1) * 60 + minute(k._data_sla1) - 480, 0), 600) ELSE 0 END) AS pos1,
         (b2.before_min + CASE WHEN b2.is_b THEN LEAST(GREATEST(hour(k._data_sla2) * 60 + minute(k._data_sla2) - 480, 0), 600) ELSE 0 END) AS pos2
  FROM kept k
  JOIN item_sums s ON s.OrderServiceCode = k.OrderServiceCode
  LEFT JOIN statuses st ON st.Sk_ServiceOrderStatusType = k.Sk_ServiceOrderStatusType
  LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = k.Sk_MaintenanceVehicle
  LEFT JOIN types ty ON ty.Sk_MaintenanceType = k.Sk_MaintenanceType
  LEFT JOIN interactions ix ON ix.order_code = k.OrderServiceCode
  LEFT JOIN customer_rules cr ON cr.customer_id = v.CustomerId
  LEFT JOIN bands b ON (b.lo IS NULL OR s.n_items >= b.lo) AND (b.hi IS NULL OR s.n_items <= b.hi)
  LEFT JOIN bm b1 ON b1.ReferenceDate = CAST(k._data_sla1 AS DATE)
  LEFT JOIN bm b2 ON b2.ReferenceDate = CAST(k._data_sla2 AS DATE))"""

STEP["graded"] = """
graded AS (
  SELECT c.*, m.minutes AS tempo_padrao,
         CASE WHEN c.MaintenanceType LIKE '%Preventiva%' THEN 'Preventiva'
              WHEN th.family IS NULL OR c.valor_os IS NULL THEN 'alta_monta'
              WHEN c.valor_os > th.hi THEN 'alta_monta'
              WHEN c.valor_os >= th.lo THEN 'media_monta'
              ELSE 'baixa_monta' END AS _monta,
         CASE WHEN c.total_int_rev >= 1 THEN c.total_int_rev * 5 ELSE 0 END
         + CASE WHEN c.customer_class = 'special' AND c.total_int_cot >= 3 THEN 15
                WHEN c.customer_class = 'special' AND c.total_int_cot >= 1 THEN c.total_int_cot * 5
                WHEN c.total_int_cot >= 1 THEN 5 ELSE 0 END AS extra_interacao,
         CASE WHEN c.customer_class = 'public' THEN CAST(c.n_items + 5 AS DECIMAL(20,1))
              WHEN c.customer_class = 'special' THEN CAST(c.n_items * CAST(1.5 AS DECIMAL(2,1)) + 5 AS DECIMAL(20,1))
              ELSE CAST(0 AS DECIMAL(20,1)) END AS extra_mercado,
         CASE WHEN c.pos1 IS NULL OR c.pos2 IS NULL THEN NULL ELSE c.pos2 - c.pos1 END AS sla_min
  FROM classified c
  LEFT JOIN std_minutes m ON m.kind = c._tipo_manutencao AND m.band = c._faixa_qtde_itens
  LEFT JOIN thresholds th ON th.family = c.familia_do_modelo)"""

STEP["intervals"] = """
pl AS (
  SELECT ClientId AS client, CAST(ParameterLogOrgValueModificationTimestamp AS TIMESTAMP) AS ts,
         list_distinct(list_filter(regexp_split_to_array(
             regexp_replace(COALESCE(OldValueDescription, ''), '\\s+', '', 'g'), '[;,]+'), lambda x: x <> '')) AS old_set,
         list_distinct(list_filter(regexp_split_to_array(
             regexp_replace(COALESCE(NewValueDescription, ''), '\\s+', '', 'g'), '[;,]+'), lambda x: x <> '')) AS new_set
  FROM param_log WHERE ParameterId = 586),
pev AS (
  SELECT client, ts, unnest(list_filter(new_set, lambda x: NOT list_contains(old_set, x))) AS approver,
         'ADD' AS event_type FROM pl
  UNION ALL
  SELECT client, ts, unnest(list_filter(old_set, lambda x: NOT list_contains(new_set, x))) AS approver,
         'REMOVE' AS event_type FROM pl),
pord AS (
  SELECT client, approver, event_type, ts,
         LEAD(ts) OVER (PARTITION BY client, approver
                        ORDER BY ts, CASE WHEN event_type = 'ADD' THEN 1 ELSE 0 END) AS next_ts,
         LEAD(event_type) OVER (PARTITION BY client, approver
                        ORDER BY ts, CASE WHEN event_type = 'ADD' THEN 1 ELSE 0 END) AS next_event_type
  FROM pev),
ivals AS (
  SELECT p.client AS CodigoCliente, p.approver AS Aprovador, u.WebUserName AS nome_aprovador,
         strftime(p.ts, '%Y-%m-%d %H:%M') AS DataInicio,
         strftime(p.next_ts, '%Y-%m-%d %H:%M') AS DataFim,
         CAST(p.ts AS DATE) AS DataInicioDate,
         CAST(COALESCE(p.next_ts, TIMESTAMP '9999-12-31 23:59:59') AS DATE) AS DataFimDate
  FROM pord p LEFT JOIN users u ON trim(u.WebUserSourceCode) = p.approver
  WHERE p.event_type = 'ADD')"""

STEP["calc"] = """
flagged AS (
  SELECT g.*, (iv.CodigoCliente IS NOT NULL) AS preco_parceiro
  FROM graded g
  LEFT JOIN ivals iv ON iv.CodigoCliente = g.CustomerId AND iv.nome_aprovador = g._aprovador
                    AND g.data_aprovacao BETWEEN iv.DataInicioDate AND iv.DataFimDate),
weighted AS (
  SELECT f.*, f.tempo_padrao + f.extra_interacao + f.extra_mercado AS tempo_total,
         fa.factor AS f_sev,
         CASE WHEN f.preco_parceiro THEN CAST(1.1 AS DECIMAL(2,1)) ELSE CAST(1.0 AS DECIMAL(2,1)) END AS f_price
  FROM flagged f LEFT JOIN factors fa ON fa.severity = f._monta),
calc AS (
  SELECT w.*,
         CAST((2 * 100 * CAST(w.tempo_total * w.f_sev * w.f_price * 1000 AS BIGINT) + 448800)
              // (2 * 448800) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS peso_os
  FROM weighted w)"""

STEP["fact"] = """
weekdays AS (
  SELECT YearWeek, _aprovador, COUNT(DISTINCT data_aprovacao) AS total_dias_uteis_semana
  FROM calc
  WHERE WeekDayNumber <= 4 AND (HolidayOrBridge IS NULL OR HolidayOrBridge = 'Bridge')
  GROUP BY YearWeek, _aprovador),
adh_rows AS (
  SELECT i.MaintenanceId, i.PartPriceApproved,
         CASE WHEN COALESCE(i.PartPriceNegociatedCustomer, i.PartPriceNegociated,
                            i.PartPriceReferenceCustomer, i.PartReferencePrice) >= i.PartUnitaryPrice
              THEN i.PartPriceApproved END AS aderente
  FROM items i
  JOIN calc c ON c.OrderServiceCode = i.MaintenanceId
  LEFT JOIN labors l ON l.Sk_MaintenanceLabor = i.Sk_MaintenanceLabor
  LEFT JOIN services s ON s.OrderServiceCode = i.MaintenanceId
  LEFT JOIN merchants m ON m.Sk_MaintenanceMerchant = s.Sk_MaintenanceMerchant
  WHERE s.IsAutomaticApproval = FALSE AND i.CancellationTimestamp IS NULL
    AND l.LaborName IN (SELECT labor_name FROM labor_whitelist)
    AND i.PartQuantity >= 1 AND i.PartUnitaryPrice > 0.1
    AND m.NameMerchantsTypes <> 'Concessionaria'
    AND COALESCE(i.PartPriceNegociatedCustomer, i.PartPriceNegociated,
                 i.PartPriceReferenceCustomer, i.PartReferencePrice) IS NOT NULL),
adh AS (
  SELECT MaintenanceId, SUM(PartPriceApproved) AS total_aprovado_referencial,
         SUM(aderente) AS total_aprovado_aderente
  FROM adh_rows GROUP BY MaintenanceId),
fact AS (
  SELECT c._aprovador, c.OrderServiceCode, c.OS_Aprovada, c.CustomerId, c.IsExternalApproval,
         c.valor_os AS valor_orcado, c.valor_aprovado AS _valor_aprovado,
         a.total_aprovado_referencial, a.total_aprovado_aderente,
         c.data_aprovacao, c.YearWeek,
         CASE WHEN c.sla_min IS NULL THEN NULL
              ELSE (CASE WHEN c.sla_min < 0 THEN '-' ELSE '' END)
                   || printf('%02d', CAST(abs(c.sla_min) // 60 AS BIGINT)) || ':'
                   || lpad(CAST(abs(c.sla_min) % 60 AS VARCHAR), 2, '0') END AS sla_aprovocao,
         c._data_sla1, c._data_sla2, c._tipo_manutencao, c._faixa_qtde_itens,
         c.familia_do_modelo, c._monta, c.total_int_rev, c.total_int_cot, c.peso_os,
         c.StatusTypeDescription, c.preco_parceiro, c.sla_min AS sla_minutos,
         c.WeekDayNumber, c.HolidayOrBridge,
         SUM(c.peso_os) OVER (PARTITION BY c.YearWeek, c._aprovador) AS soma_peso_os_semana_aprovador,
         COUNT(c.OrderServiceCode) OVER (PARTITION BY c.YearWeek, c._aprovador) AS total_os_semana_aprovador,
         wd.total_dias_uteis_semana
  FROM calc c
  LEFT JOIN weekdays wd ON wd.YearWeek = c.YearWeek AND wd._aprovador = c._aprovador
  LEFT JOIN adh a ON a.MaintenanceId = c.OrderServiceCode)"""


def with_ctes(*names: str) -> str:
    """WITH clause holding the named source and step CTEs, in order."""
    parts = []
    for n in names:
        parts.append(SRC[n] if n in SRC else STEP[n])
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


FACT_DEPS = ["users", "services", "items", "vehicles", "customer_rules", "types", "statuses",
             "labors", "protocols", "attendances", "history", "param_log", "merchants", "roster",
             "calendar", "bands", "std_minutes", "thresholds", "factors", "labor_whitelist",
             "attributed", "kept", "interactions", "item_sums", "business_minutes",
             "classified", "graded", "intervals", "calc", "fact"]

# each person's days one by one, with the class of each day and running minutes
STEP["person_days"] = """
assignments AS (
  SELECT n_name AS person, DATE '0001-01-01' AS lo, DATE '1997-06-30' AS hi, 5 AS last, 480 AS s, 1080 AS e
  FROM nation WHERE n_regionkey = 1 AND n_nationkey <> 12
  UNION ALL SELECT n_name, DATE '1998-01-01', DATE '9999-12-31', 4, 600, 1200
  FROM nation WHERE n_regionkey = 1 AND n_nationkey <> 12
  UNION ALL SELECT n_name, DATE '1996-07-03', DATE '9999-12-31', 5, 480, 1080
  FROM nation WHERE n_regionkey = 2 AND n_nationkey <> 12),
person_days AS (
  SELECT x.*, COALESCE(SUM(CASE WHEN works THEN e - s ELSE 0 END)
                       OVER (PARTITION BY person ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_min
  FROM (SELECT p.n_name AS person, c.ReferenceDate AS day, c.YearWeek, COALESCE(a.s, 480) AS s, COALESCE(a.e, 1080) AS e,
               (c.HolidayOrBridge IS NULL OR c.HolidayOrBridge = 'Bridge') AND c.WeekDayNumber <= COALESCE(a.last, 4) AS works
        FROM nation p JOIN calendar c ON TRUE
        LEFT JOIN assignments a ON a.person = p.n_name AND c.ReferenceDate BETWEEN a.lo AND a.hi) x)"""

# ---------------------------------------------------------------------------
# Repeated keys: the original's joins, GROUP BY and DISTINCT over tables with second rows
# ---------------------------------------------------------------------------

def _again(name: str, selects: list[str]) -> str:
    """The CTE of a source under ``<name>_once``, and with more rows under its own name."""
    once = SRC[name].replace(f"\n{name}", f"\n{name}_once", 1)
    more = "".join(f"\n  UNION ALL {select.format(f'{name}_once')}" for select in selects)
    return f"{once},\n{name} AS (\n  SELECT * FROM {name}_once{more})"


REPEATS = {
    "services": ["SELECT * FROM {} WHERE OrderServiceCode % 16 = 5",
                 "SELECT * REPLACE (NOT IsExternalApproval AS IsExternalApproval) FROM {} WHERE OrderServiceCode % 16 = 9",
                 "SELECT * REPLACE ((Sk_MaintenanceMerchant + 1) % 10 AS Sk_MaintenanceMerchant) FROM {} "
                 "WHERE OrderServiceCode % 16 = 11"],
    "users": ["SELECT * FROM {} WHERE Sk_WebUser % 6 = 1",
              "SELECT * REPLACE (WebUserName || ' II' AS WebUserName) FROM {} WHERE Sk_WebUser % 8 = 3",
              "SELECT * REPLACE (NULL AS IsInternalUser) FROM {} WHERE Sk_WebUser % 9 = 4"],
    "vehicles": ["SELECT * FROM {} WHERE Sk_MaintenanceVehicle % 10 = 3",
                 "SELECT * REPLACE ('Leve' AS maintenancemodelfamily) FROM {} WHERE Sk_MaintenanceVehicle % 10 = 7"],
    "types": ["SELECT Sk_MaintenanceType, 'Preventiva Programada' FROM {} WHERE Sk_MaintenanceType = 2",
              "SELECT * FROM {} WHERE Sk_MaintenanceType = 4"],
    "statuses": ["SELECT * FROM {} WHERE Sk_ServiceOrderStatusType = 2"],
    "labors": ["SELECT * FROM {} WHERE Sk_MaintenanceLabor = 1"],
    "merchants": ["SELECT * FROM {} WHERE Sk_MaintenanceMerchant % 3 = 0"],
}

STEP["joined"] = """
joined AS (
  SELECT k.*, st.StatusTypeDescription, v.CustomerId, ty.MaintenanceType,
         ix.total_revisao AS total_int_rev, ix.total_cotacao AS total_int_cot,
         i.QuotedPrice, i.PriceApproved,
         CASE WHEN i.CancellationTimestamp IS NULL THEN i.Sk_MaintenanceItem END AS live_item,
         CASE WHEN k.MaintenanceTypeDescription = 'Sinistro' THEN 'Sinistro'
              WHEN ty.MaintenanceType = 'Preventiva' THEN 'Preventiva' ELSE 'Corretiva' END AS _tipo_manutencao,
         CASE WHEN v.maintenancemodelfamily IS NOT NULL
                   AND v.maintenancemodelfamily NOT IN ('Nao Identificado', 'Nao Definido')
              THEN v.maintenancemodelfamily
              WHEN v.familycategory IS NOT NULL AND v.familycategory <> 'Nao Identificado'
              THEN v.familycategory ELSE 'Leve' END AS familia_do_modelo
  FROM kept k
  LEFT JOIN statuses st ON st.Sk_ServiceOrderStatusType = k.Sk_ServiceOrderStatusType
  LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = k.Sk_MaintenanceVehicle
  LEFT JOIN types ty ON ty.Sk_MaintenanceType = k.Sk_MaintenanceType
  LEFT JOIN protocols p ON p.ProtocolSourceCode = k.OrderServiceCode
  LEFT JOIN attendances att ON att.Sk_MaintenanceProtocol = p.Sk_MaintenanceProtocol
  LEFT JOIN items i ON i.MaintenanceId = k.OrderServiceCode
  LEFT JOIN interactions ix ON ix.order_code = k.OrderServiceCode),
grouped AS (
  SELECT OrderServiceCode, f1, f2, f3, IsExternalApproval, OS_Aprovada, _aprovador, _tipo_manutencao, familia_do_modelo,
         MaintenanceType, data_aprovacao, YearWeek, WeekDayNumber, HolidayOrBridge, total_int_rev, total_int_cot,
         _data_sla1, _data_sla2, StatusTypeDescription, CustomerId,
         SUM(QuotedPrice) AS valor_os, SUM(PriceApproved) AS valor_aprovado, COUNT(live_item) AS n_items
  FROM joined
  GROUP BY ALL),
classified AS (
  SELECT g.*, cr.class AS customer_class, b.label AS _faixa_qtde_itens,
         (b1.before_min + CASE WHEN b1.is_b THEN LEAST(GREATEST(hour(g._data_sla1) * 60 + minute(g._data_sla1) - 480, 0), 600) ELSE 0 END) AS pos1,
         (b2.before_min + CASE WHEN b2.is_b THEN LEAST(GREATEST(hour(g._data_sla2) * 60 + minute(g._data_sla2) - 480, 0), 600) ELSE 0 END) AS pos2
  FROM grouped g
  LEFT JOIN customer_rules cr ON cr.customer_id = g.CustomerId
  LEFT JOIN bands b ON (b.lo IS NULL OR g.n_items >= b.lo) AND (b.hi IS NULL OR g.n_items <= b.hi)
  LEFT JOIN bm b1 ON b1.ReferenceDate = CAST(g._data_sla1 AS DATE)
  LEFT JOIN bm b2 ON b2.ReferenceDate = CAST(g._data_sla2 AS DATE))"""

STEP["distinct_rows"] = STEP["graded"].replace("graded AS (", "every AS (", 1) + """,
graded AS (
  SELECT DISTINCT OrderServiceCode, OS_Aprovada, IsExternalApproval, CustomerId, _data_sla1, _data_sla2, sla_min,
         data_aprovacao, _aprovador, YearWeek, WeekDayNumber, HolidayOrBridge, familia_do_modelo, valor_os, valor_aprovado,
         _tipo_manutencao, _faixa_qtde_itens, tempo_padrao, _monta, total_int_rev, total_int_cot, extra_interacao,
         extra_mercado, StatusTypeDescription
  FROM every)"""


def repeated_keys_sql() -> str:
    steps = ["attributed", "kept", "interactions", "business_minutes", "joined", "distinct_rows", "intervals", "calc", "fact"]
    sources = [n for n in FACT_DEPS if n in SRC]
    parts = [_again(n, REPEATS[n]) if n in REPEATS else SRC[n] for n in sources] + [STEP[n] for n in steps]
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + FACT_SELECT


# ---------------------------------------------------------------------------
# The view form: no weekday rule, stage days, a price flag by existence, blanks in the lists kept
# ---------------------------------------------------------------------------

def view_form_sql() -> str:
    changed = {
        "kept": STEP["kept"].split("\n    AND ((a._aprovador IN")[0] + ")",
        "intervals": re.sub(r"regexp_replace\((COALESCE\(\w+, ''\)), '\\s\+', '', 'g'\)", r"\1", STEP["intervals"]),
        "calc": STEP["calc"].replace("""(iv.CodigoCliente IS NOT NULL) AS preco_parceiro
  FROM graded g
  LEFT JOIN ivals iv ON""", """EXISTS (SELECT 1 FROM ivals iv WHERE""").replace(
            "iv.DataInicioDate AND iv.DataFimDate),\nweighted", "iv.DataInicioDate AND iv.DataFimDate) AS preco_parceiro\n"
            "  FROM graded g),\nweighted"),
    }
    parts = [changed.get(n) or SRC.get(n) or STEP[n] for n in FACT_DEPS]
    select = FACT_SELECT.replace("CAST(_data_sla1 AS VARCHAR)", "CAST(CAST(_data_sla1 AS DATE) AS VARCHAR)").replace(
        "CAST(_data_sla2 AS VARCHAR)", "CAST(CAST(_data_sla2 AS DATE) AS VARCHAR)")
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + select


FACT_SELECT = """
SELECT _aprovador, OrderServiceCode, OS_Aprovada, CustomerId, IsExternalApproval,
       CAST(valor_orcado AS DOUBLE) AS valor_orcado,
       CAST(_valor_aprovado AS DOUBLE) AS _valor_aprovado,
       CAST(total_aprovado_referencial AS DOUBLE) AS total_aprovado_referencial,
       CAST(total_aprovado_aderente AS DOUBLE) AS total_aprovado_aderente,
       CAST(data_aprovacao AS VARCHAR) AS data_aprovacao, CAST(YearWeek AS BIGINT) AS YearWeek,
       sla_aprovocao, CAST(_data_sla1 AS VARCHAR) AS _data_sla1,
       CAST(_data_sla2 AS VARCHAR) AS _data_sla2,
       _tipo_manutencao, _faixa_qtde_itens, familia_do_modelo, _monta,
       CAST(total_int_rev AS BIGINT) AS total_int_rev, CAST(total_int_cot AS BIGINT) AS total_int_cot,
       CAST(peso_os AS DOUBLE) AS peso_os, StatusTypeDescription, preco_parceiro,
       CAST(soma_peso_os_semana_aprovador AS DOUBLE) AS soma_peso_os_semana_aprovador,
       CAST(total_os_semana_aprovador AS BIGINT) AS total_os_semana_aprovador,
       CAST(total_dias_uteis_semana AS BIGINT) AS total_dias_uteis_semana,
       round(CAST(total_os_semana_aprovador AS DOUBLE) / total_dias_uteis_semana, 6) AS media_diaria_os_aprovador,
       round(CAST(soma_peso_os_semana_aprovador AS DOUBLE) / total_dias_uteis_semana, 6) AS produtividade_semana_aprovador
FROM fact"""


def approval_fact_sql() -> str:
    return with_ctes(*FACT_DEPS) + FACT_SELECT


WEEKLY_SELECT = """
SELECT _aprovador, CAST(YearWeek AS BIGINT) AS YearWeek,
       CAST(COUNT(*) AS BIGINT) AS fact_rows,
       CAST(COUNT(DISTINCT OrderServiceCode) AS BIGINT) AS orders,
       CAST(SUM(peso_os) AS DOUBLE) AS soma_peso_os,
       CAST(max(total_dias_uteis_semana) AS BIGINT) AS total_dias_uteis_semana,
       round(CAST(SUM(peso_os) AS DOUBLE) / max(total_dias_uteis_semana), 6) AS produtividade_semana_aprovador
FROM fact GROUP BY _aprovador, YearWeek"""


def weekly_productivity_sql() -> str:
    return with_ctes(*FACT_DEPS) + WEEKLY_SELECT



# shared: every order with its item totals (no fan-out; items only)
STEP["order_items"] = """
order_items AS (
  SELECT s.*, COUNT(CASE WHEN i.CancellationTimestamp IS NULL THEN i.Sk_MaintenanceItem END) AS n_items,
         SUM(i.QuotedPrice) AS valor_os
  FROM services s LEFT JOIN items i ON i.MaintenanceId = s.OrderServiceCode
  GROUP BY ALL)"""

STEP["loose"] = """
loose AS (
  SELECT a.*, c.YearWeek, c.WeekDayNumber, c.HolidayOrBridge
  FROM attributed a JOIN calendar c ON c.ReferenceDate = a.data_aprovacao
  WHERE a.IsAutomaticApproval = FALSE AND a.any_internal
    AND c.ReferenceDate >= DATE '1996-01-01'
    AND (c.HolidayOrBridge IS NULL OR c.HolidayOrBridge = 'Bridge'))"""

BASE_SRC = ["users", "services", "calendar", "roster", "attributed"]


def _sql(deps, select):
    return with_ctes(*deps) + select


def ORACLE_SQL() -> dict[str, str]:
    """Query key -> DuckDB SQL."""
    fact = FACT_DEPS
    q = {}
    q["weekly_productivity"] = weekly_productivity_sql()
    q["approval_fact"] = approval_fact_sql()
    q["approver_attribution"] = _sql(["users", "services", "attributed"], """
SELECT OrderServiceCode, OS_Aprovada, any_internal, _aprovador,
       CAST(data_aprovacao AS VARCHAR) AS data_aprovacao,
       CAST(_data_sla1 AS VARCHAR) AS _data_sla1, CAST(_data_sla2 AS VARCHAR) AS _data_sla2
FROM attributed""")
    q["business_day_filter"] = _sql(BASE_SRC + ["kept"], """
SELECT OrderServiceCode, _aprovador, CAST(data_aprovacao AS VARCHAR) AS data_aprovacao,
       CAST(YearWeek AS BIGINT) AS YearWeek, CAST(WeekDayNumber AS BIGINT) AS WeekDayNumber,
       HolidayOrBridge
FROM kept""")
    q["not_in_null_roster"] = _sql(BASE_SRC + ["kept", "loose"], """
SELECT l._aprovador, CAST(l.WeekDayNumber AS BIGINT) AS WeekDayNumber,
       COUNT(*) AS approvals_no_rule, COUNT(k.OrderServiceCode) AS approvals_roster_rule
FROM loose l LEFT JOIN kept k ON k.OrderServiceCode = l.OrderServiceCode
GROUP BY l._aprovador, l.WeekDayNumber""")
    q["item_bands"] = _sql(["services", "items", "bands", "order_items"], """
SELECT o.OrderServiceCode, CAST(o.n_items AS BIGINT) AS n_items, b.label AS _faixa_qtde_itens,
       CAST(o.valor_os AS DOUBLE) AS valor_os
FROM order_items o
LEFT JOIN bands b ON (b.lo IS NULL OR o.n_items >= b.lo) AND (b.hi IS NULL OR o.n_items <= b.hi)""")
    q["standard_minutes"] = _sql(["services", "items", "types", "bands", "std_minutes", "order_items"], """
SELECT x.OrderServiceCode, x.kind AS _tipo_manutencao, x.band AS _faixa_qtde_itens,
       CAST(m.minutes AS BIGINT) AS tempo_padrao
FROM (SELECT o.OrderServiceCode, b.label AS band,
             CASE WHEN o.MaintenanceTypeDescription = 'Sinistro' THEN 'Sinistro'
                  WHEN t.MaintenanceType = 'Preventiva' THEN 'Preventiva' ELSE 'Corretiva' END AS kind
      FROM order_items o
      LEFT JOIN types t ON t.Sk_MaintenanceType = o.Sk_MaintenanceType
      LEFT JOIN bands b ON (b.lo IS NULL OR o.n_items >= b.lo) AND (b.hi IS NULL OR o.n_items <= b.hi)) x
LEFT JOIN std_minutes m ON m.kind = x.kind AND m.band = x.band""")
    q["severity"] = _sql(["services", "items", "types", "vehicles", "thresholds", "factors",
                          "order_items"], """
SELECT y.OrderServiceCode, y.familia_do_modelo, CAST(y.valor_os AS DOUBLE) AS _valor_os, y._monta,
       CAST(f.factor AS DOUBLE) AS fator_correcao_monta
FROM (SELECT x.*,
             CASE WHEN x.MaintenanceType LIKE '%Preventiva%' THEN 'Preventiva'
                  WHEN th.family IS NULL OR x.valor_os IS NULL THEN 'alta_monta'
                  WHEN x.valor_os > th.hi THEN 'alta_monta'
                  WHEN x.valor_os >= th.lo THEN 'media_monta'
                  ELSE 'baixa_monta' END AS _monta
      FROM (SELECT o.OrderServiceCode, o.valor_os, t.MaintenanceType,
                   CASE WHEN v.maintenancemodelfamily IS NOT NULL
                             AND v.maintenancemodelfamily NOT IN ('Nao Identificado', 'Nao Definido')
                        THEN v.maintenancemodelfamily
                        WHEN v.familycategory IS NOT NULL AND v.familycategory <> 'Nao Identificado'
                        THEN v.familycategory ELSE 'Leve' END AS familia_do_modelo
            FROM order_items o
            LEFT JOIN types t ON t.Sk_MaintenanceType = o.Sk_MaintenanceType
            LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = o.Sk_MaintenanceVehicle) x
      LEFT JOIN thresholds th ON th.family = x.familia_do_modelo) y
LEFT JOIN factors f ON f.severity = y._monta""")
    q["interaction_counts"] = _sql(["history", "interactions"], """
SELECT order_code, total_revisao, total_cotacao FROM interactions""")
    q["extra_minutes"] = _sql(["services", "items", "vehicles", "customer_rules", "history",
                               "interactions", "order_items"], """
SELECT o.OrderServiceCode, ix.total_revisao AS total_int_rev, ix.total_cotacao AS total_int_cot,
       CAST(CASE WHEN ix.total_revisao >= 1 THEN ix.total_revisao * 5 ELSE 0 END AS BIGINT) AS tempo_extra_revisao,
       CAST(CASE WHEN cr.class = 'special' AND ix.total_cotacao >= 3 THEN 15
                 WHEN cr.class = 'special' AND ix.total_cotacao >= 1 THEN ix.total_cotacao * 5
                 WHEN ix.total_cotacao >= 1 THEN 5 ELSE 0 END AS BIGINT) AS tempo_extra_cotacao,
       CAST(CASE WHEN cr.class = 'public' THEN o.n_items + 5
                 WHEN cr.class = 'special' THEN o.n_items * 1.5 + 5 ELSE 0 END AS DOUBLE)
         AS tempo_extra_mercadopublico
FROM order_items o
LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = o.Sk_MaintenanceVehicle
LEFT JOIN customer_rules cr ON cr.customer_id = v.CustomerId
LEFT JOIN interactions ix ON ix.order_code = o.OrderServiceCode""")
    q["list_set_diff"] = _sql(["users", "param_log", "intervals"], """
SELECT client AS CodigoCliente, approver, CAST(ts AS VARCHAR) AS ts, event_type FROM pev""")
    q["membership_events"] = _sql(["users", "param_log", "intervals"], """
SELECT client AS CodigoCliente, approver, event_type, CAST(ts AS VARCHAR) AS ts,
       CAST(next_ts AS VARCHAR) AS next_ts, next_event_type FROM pord""")
    q["membership_intervals"] = _sql(["users", "param_log", "intervals"], """
SELECT CodigoCliente, Aprovador, nome_aprovador, DataInicio, DataFim,
       CAST(DataInicioDate AS VARCHAR) AS DataInicioDate, CAST(DataFimDate AS VARCHAR) AS DataFimDate
FROM ivals""")
    q["membership_intervals_by_slices"] = q["membership_intervals"]  # the same rows, arrived at otherwise
    q["approval_fact_refreshed"] = q["approval_fact"]
    q["approval_fact_repeated_keys"] = repeated_keys_sql()
    q["approval_fact_view_form"] = view_form_sql()
    join_base = BASE_SRC + ["kept", "vehicles", "param_log", "intervals"]
    q["interval_join_faithful"] = _sql(join_base, """
SELECT k.OrderServiceCode, v.CustomerId, k._aprovador, CAST(k.data_aprovacao AS VARCHAR) AS data_aprovacao,
       (iv.CodigoCliente IS NOT NULL) AS preco_parceiro
FROM kept k
LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = k.Sk_MaintenanceVehicle
LEFT JOIN ivals iv ON iv.CodigoCliente = v.CustomerId AND iv.nome_aprovador = k._aprovador
                  AND k.data_aprovacao BETWEEN iv.DataInicioDate AND iv.DataFimDate""")
    q["interval_join_exists"] = _sql(join_base, """
SELECT k.OrderServiceCode, v.CustomerId, k._aprovador, CAST(k.data_aprovacao AS VARCHAR) AS data_aprovacao,
       EXISTS (SELECT 1 FROM ivals iv
               WHERE iv.CodigoCliente = v.CustomerId AND iv.nome_aprovador = k._aprovador
                 AND k.data_aprovacao BETWEEN iv.DataInicioDate AND iv.DataFimDate) AS preco_parceiro
FROM kept k
LEFT JOIN vehicles v ON v.Sk_MaintenanceVehicle = k.Sk_MaintenanceVehicle""")
    q["order_weight"] = _sql(fact[:-1], """
SELECT OrderServiceCode, preco_parceiro, CAST(tempo_padrao AS BIGINT) AS tempo_padrao,
       CAST(extra_interacao AS BIGINT) AS tempo_extra_interacao,
       CAST(extra_mercado AS DOUBLE) AS tempo_extra_mercadopublico,
       CAST(tempo_total AS DOUBLE) AS tempo_total, CAST(f_sev AS DOUBLE) AS fator_correcao_monta,
       CAST(f_price AS DOUBLE) AS fator_correcao_precoparceiro,
       round(448.8 / CAST(tempo_total AS DOUBLE) / CAST(f_sev * f_price AS DOUBLE), 6) AS meta_os_dia_corrigido,
       CAST(peso_os AS DOUBLE) AS peso_os
FROM calc""")
    q["order_weight_by_bucket"] = q["order_weight"]
    q["weekly_distinct_days"] = _sql(fact, """
SELECT DISTINCT CAST(YearWeek AS BIGINT) AS YearWeek, _aprovador,
       CAST(total_dias_uteis_semana AS BIGINT) AS total_dias_uteis_semana FROM fact""")
    q["window_totals"] = _sql(fact, """
SELECT OrderServiceCode, CAST(YearWeek AS BIGINT) AS YearWeek, _aprovador, preco_parceiro,
       CAST(soma_peso_os_semana_aprovador AS DOUBLE) AS soma_peso_os_semana_aprovador,
       CAST(total_os_semana_aprovador AS BIGINT) AS total_os_semana_aprovador,
       CAST(total_os_semana_aprovador AS DOUBLE) / total_dias_uteis_semana AS media_diaria_os_aprovador,
       round(CAST(soma_peso_os_semana_aprovador AS DOUBLE) / total_dias_uteis_semana, 6)
         AS produtividade_semana_aprovador
FROM fact""")
    q["price_adherence"] = _sql(["services", "items", "labors", "merchants", "labor_whitelist"], """
SELECT i.MaintenanceId,
       CAST(SUM(i.PartPriceApproved) AS DOUBLE) AS total_aprovado_referencial,
       CAST(SUM(CASE WHEN COALESCE(i.PartPriceNegociatedCustomer, i.PartPriceNegociated,
                                   i.PartPriceReferenceCustomer, i.PartReferencePrice) >= i.PartUnitaryPrice
                     THEN i.PartPriceApproved END) AS DOUBLE) AS total_aprovado_aderente
FROM items i
JOIN labors l ON l.Sk_MaintenanceLabor = i.Sk_MaintenanceLabor
JOIN services s ON s.OrderServiceCode = i.MaintenanceId
JOIN merchants m ON m.Sk_MaintenanceMerchant = s.Sk_MaintenanceMerchant
WHERE s.IsAutomaticApproval = FALSE AND i.CancellationTimestamp IS NULL
  AND l.LaborName IN (SELECT labor_name FROM labor_whitelist)
  AND i.PartQuantity >= 1 AND i.PartUnitaryPrice > 0.1
  AND m.NameMerchantsTypes <> 'Concessionaria'
  AND COALESCE(i.PartPriceNegociatedCustomer, i.PartPriceNegociated,
               i.PartPriceReferenceCustomer, i.PartReferencePrice) IS NOT NULL
GROUP BY i.MaintenanceId""")
    q["business_time"] = _sql(["services", "calendar", "business_minutes"], """
SELECT x.OrderServiceCode, x.m AS business_minutes,
       CASE WHEN x.m IS NULL THEN NULL
            ELSE (CASE WHEN x.m < 0 THEN '-' ELSE '' END)
                 || printf('%02d', CAST(abs(x.m) // 60 AS BIGINT)) || ':'
                 || lpad(CAST(abs(x.m) % 60 AS VARCHAR), 2, '0') END AS business_text
FROM (SELECT s.OrderServiceCode,
             CAST((b2.before_min + CASE WHEN b2.is_b THEN LEAST(GREATEST(hour(s.ThirdApprovalTimestamp) * 60
                      + minute(s.ThirdApprovalTimestamp) - 480, 0), 600) ELSE 0 END)
                - (b1.before_min + CASE WHEN b1.is_b THEN LEAST(GREATEST(hour(s.FistBudgetSentTimestamp) * 60
                      + minute(s.FistBudgetSentTimestamp) - 480, 0), 600) ELSE 0 END) AS BIGINT) AS m
      FROM services s
      LEFT JOIN bm b1 ON b1.ReferenceDate = CAST(s.FistBudgetSentTimestamp AS DATE)
      LEFT JOIN bm b2 ON b2.ReferenceDate = CAST(s.ThirdApprovalTimestamp AS DATE)) x""")
    q["sla_attainment"] = _sql(fact + ["sla_target"], """
SELECT o._aprovador, COUNT(*) AS orders_with_sla,
       CAST(SUM(CASE WHEN o.sla_minutos <= t.target_hours * 60 THEN 1 ELSE 0 END) AS BIGINT) AS orders_on_time,
       CAST(SUM(CASE WHEN o.sla_minutos <= t.target_hours * 60 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS on_time_share
FROM (SELECT DISTINCT OrderServiceCode, CustomerId, sla_minutos, _aprovador FROM fact) o
JOIN sla_target t ON t.customer_id = o.CustomerId
WHERE o.sla_minutos IS NOT NULL
GROUP BY o._aprovador""")
    q["approver_summary"] = _sql(fact + ["hierarchy"], """
SELECT period, supervisor_name, _aprovador,
       COUNT(DISTINCT OrderServiceCode) AS orders, CAST(SUM(peso_os) AS DOUBLE) AS soma_peso_os,
       COUNT(DISTINCT data_aprovacao) AS approval_days,
       CAST(GROUPING(period, supervisor_name, _aprovador) AS BIGINT) AS level,
       CAST(COUNT(DISTINCT OrderServiceCode) AS DOUBLE) / COUNT(DISTINCT data_aprovacao) AS daily_avg_orders
FROM (SELECT f.*, CAST(year(f.data_aprovacao) * 100 + month(f.data_aprovacao) AS BIGINT) AS period,
             h.supervisor_name
      FROM fact f LEFT JOIN hierarchy h ON h.consultant_name = f._aprovador) x
GROUP BY ROLLUP (period, supervisor_name, _aprovador)""")
    q["average_ticket"] = _sql(fact, """
SELECT _aprovador, month, COUNT(*) AS orders,
       CAST(SUM(valor_orcado) AS DOUBLE) AS total_orcado,
       CAST(SUM(_valor_aprovado) AS DOUBLE) AS total_aprovado,
       CAST(SUM(_valor_aprovado) AS DOUBLE) / COUNT(*) AS ticket_medio
FROM (SELECT DISTINCT OrderServiceCode, _aprovador, valor_orcado, _valor_aprovado,
             CAST(year(data_aprovacao) * 100 + month(data_aprovacao) AS BIGINT) AS month
      FROM fact) o
GROUP BY _aprovador, month""")
    q["adherence_matrix"] = _sql(fact, """
SELECT sla_range,
       COUNT(CASE WHEN band = 'lt50' THEN 1 END) AS lt50,
       COUNT(CASE WHEN band = 'p50_80' THEN 1 END) AS p50_80,
       COUNT(CASE WHEN band = 'ge80' THEN 1 END) AS ge80,
       COUNT(CASE WHEN band = 'none' THEN 1 END) AS none
FROM (SELECT CASE WHEN sla_minutos IS NULL THEN 'sem_sla' WHEN sla_minutos <= 480 THEN 'ate_8h'
                  WHEN sla_minutos <= 1440 THEN 'de_8h_a_24h' ELSE 'acima_24h' END AS sla_range,
             CASE WHEN total_aprovado_referencial IS NULL OR total_aprovado_referencial = 0 THEN 'none'
                  WHEN CAST(COALESCE(total_aprovado_aderente, 0) AS DOUBLE)
                       / CAST(total_aprovado_referencial AS DOUBLE) < 0.5 THEN 'lt50'
                  WHEN CAST(COALESCE(total_aprovado_aderente, 0) AS DOUBLE)
                       / CAST(total_aprovado_referencial AS DOUBLE) < 0.8 THEN 'p50_80'
                  ELSE 'ge80' END AS band
      FROM (SELECT DISTINCT OrderServiceCode, sla_minutos, total_aprovado_referencial,
                   total_aprovado_aderente FROM fact) d) x
GROUP BY sla_range""")
    q["row_security"] = _sql(fact + ["hierarchy"], """
SELECT OrderServiceCode, _aprovador, CAST(data_aprovacao AS VARCHAR) AS data_aprovacao,
       CAST(peso_os AS DOUBLE) AS peso_os
FROM fact
WHERE _aprovador IN (SELECT consultant_name FROM hierarchy
                     WHERE supervisor_email = 'america@ops.example'
                        OR consultant_email = 'america@ops.example')""")
    q["row_security_cascade"] = _sql(fact + ["hierarchy", "reporting"], """
SELECT OrderServiceCode, _aprovador, CAST(data_aprovacao AS VARCHAR) AS data_aprovacao,
       CAST(peso_os AS DOUBLE) AS peso_os
FROM fact
WHERE _aprovador IN (
  WITH RECURSIVE team(email) AS (
    SELECT 'america@ops.example'
    UNION
    SELECT r.consultant_email FROM team JOIN reporting r ON r.supervisor_email = team.email)
  SELECT consultant_name FROM reporting WHERE consultant_email IN (SELECT email FROM team))""")
    q["reporting_closure"] = """
WITH RECURSIVE links AS (
  SELECT s_suppkey AS person, CASE WHEN s_suppkey < 4 THEN s_suppkey % 3 + 1 ELSE s_suppkey // 4 END AS manager
  FROM supplier),
lines(manager, person, path) AS (
  SELECT person, person, [person] FROM links
  UNION ALL
  SELECT l.manager, x.person, list_append(x.path, l.manager)
  FROM lines x JOIN links l ON l.person = x.manager
  WHERE NOT list_contains(x.path, l.manager))
SELECT 's' || manager || '@ops.example' AS manager, 's' || person || '@ops.example' AS person,
       CAST(MIN(len(path)) - 1 AS BIGINT) AS level
FROM lines GROUP BY manager, person"""
    q["audit_cross"] = _sql(fact + ["audit"], """
SELECT o.OrderServiceCode, o._aprovador, CAST(o._valor_aprovado AS DOUBLE) AS _valor_aprovado,
       CAST(COALESCE(a.valor_glosado, 0) AS DOUBLE) AS valor_glosado,
       COALESCE(a.itens_glosados, 0) AS itens_glosados,
       CAST(COALESCE(a.valor_glosado, 0) AS DOUBLE) / CAST(o._valor_aprovado AS DOUBLE) AS share_glosado
FROM (SELECT DISTINCT OrderServiceCode, _aprovador, _valor_aprovado FROM fact) o
LEFT JOIN (SELECT OrderServiceCode, SUM(disallowed_amount) AS valor_glosado, COUNT(*) AS itens_glosados
           FROM audit GROUP BY OrderServiceCode) a ON a.OrderServiceCode = o.OrderServiceCode""")
    q["period_slice"] = _sql(fact + ["hierarchy"], """
SELECT OrderServiceCode, _aprovador, CAST(data_aprovacao AS VARCHAR) AS data_aprovacao,
       CAST(peso_os AS DOUBLE) AS peso_os, CAST(YearWeek AS BIGINT) AS YearWeek
FROM fact
WHERE data_aprovacao BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
  AND _aprovador IN (SELECT consultant_name FROM hierarchy WHERE portfolio = 'ASIA')""")
    q["approver_summary_from_cube"] = q["approver_summary"]
    q["weekly_summary_from_cube"] = _sql(fact + ["hierarchy"], """
SELECT period, supervisor_name, _aprovador,
       COUNT(DISTINCT OrderServiceCode) AS orders, CAST(SUM(peso_os) AS DOUBLE) AS soma_peso_os,
       COUNT(DISTINCT data_aprovacao) AS approval_days,
       CAST(GROUPING(period, supervisor_name, _aprovador) AS BIGINT) AS level,
       CAST(COUNT(DISTINCT OrderServiceCode) AS DOUBLE) / COUNT(DISTINCT data_aprovacao) AS daily_avg_orders
FROM (SELECT f.*, CAST(f.YearWeek AS BIGINT) AS period, h.supervisor_name
      FROM fact f LEFT JOIN hierarchy h ON h.consultant_name = f._aprovador) x
GROUP BY ROLLUP (period, supervisor_name, _aprovador)""")
    q["period_totals_from_cube"] = _sql(fact + ["hierarchy"], """
SELECT _aprovador, COUNT(DISTINCT OrderServiceCode) AS orders, COUNT(*) AS fact_rows,
       CAST(SUM(peso_os) AS DOUBLE) AS soma_peso_os, COUNT(DISTINCT data_aprovacao) AS approval_days
FROM fact
WHERE data_aprovacao BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
  AND _aprovador IN (SELECT consultant_name FROM hierarchy WHERE portfolio = 'ASIA')
GROUP BY _aprovador""")
    q["worked_days"] = _sql(fact, """
SELECT CAST(p.YearWeek AS BIGINT) AS YearWeek, p._aprovador,
       EXISTS (SELECT 1 FROM roster r WHERE r.web_user_name = p._aprovador) AS works_saturday,
       CAST(COALESCE(w.weekdays, 0)
            + CASE WHEN EXISTS (SELECT 1 FROM roster r WHERE r.web_user_name = p._aprovador)
                   THEN COALESCE(w.saturdays, 0) ELSE 0 END AS BIGINT) AS worked_days
FROM (SELECT DISTINCT YearWeek, _aprovador FROM fact) p
LEFT JOIN (SELECT YearWeek, SUM(CASE WHEN WeekDayNumber <= 4 THEN 1 ELSE 0 END) AS weekdays,
                  SUM(CASE WHEN WeekDayNumber = 5 THEN 1 ELSE 0 END) AS saturdays
           FROM calendar WHERE HolidayOrBridge IS NULL OR HolidayOrBridge = 'Bridge'
           GROUP BY YearWeek) w ON w.YearWeek = p.YearWeek""")
    q["governed_sheets"] = """
WITH audit AS (
  SELECT CASE WHEN l_orderkey % 50 = 7 THEN 'type' WHEN l_orderkey % 50 = 9 THEN 'refers' END AS code,
         l_linenumber = 2 AS blank, CAST(l_extendedprice AS DECIMAL(18,2)) < 5000 AS below
  FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <= 2),
targets AS (
  SELECT c_custkey AS id, c_custkey % 20 AS hours FROM customer
  UNION ALL SELECT c_custkey, NULL FROM customer WHERE c_custkey % 30 = 4),
classes AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 1 THEN 'private' WHEN c_custkey % 2 = 0 THEN 'public'
                               ELSE 'special' END AS class FROM customer
  UNION ALL SELECT c_custkey, 'public' FROM customer WHERE c_custkey % 25 = 6),
found AS (
  SELECT 'audit' AS kind, concat_ws(',',
           CASE WHEN blank THEN 'missing:disallowed_amount' END, CASE WHEN code = 'type' THEN 'missing:OrderServiceCode' END,
           CASE WHEN NOT blank AND below THEN 'range:disallowed_amount' END, CASE WHEN code = 'refers' THEN 'refers:OrderServiceCode' END,
           CASE WHEN code = 'type' THEN 'type:OrderServiceCode' END) AS faults FROM audit
  UNION ALL
  SELECT 'sla_target', concat_ws(',', CASE WHEN COUNT(*) OVER (PARTITION BY id) > 1 THEN 'key' END,
           CASE WHEN hours IS NULL THEN 'missing:target_hours' END, CASE WHEN hours = 0 THEN 'range:target_hours' END,
           CASE WHEN hours IS NULL THEN 'type:target_hours' END) FROM targets
  UNION ALL
  SELECT 'customer_rules', concat_ws(',', CASE WHEN class = 'private' THEN 'domain:class' END,
           CASE WHEN COUNT(*) OVER (PARTITION BY id, class) > 1 THEN 'key' END) FROM classes
  UNION ALL
  SELECT 'roster', CASE WHEN x.name NOT IN (SELECT n_name FROM nation WHERE n_nationkey <> 12) THEN 'refers:web_user_name' ELSE '' END
  FROM (SELECT upper(n_name) AS name FROM nation WHERE n_regionkey = 1
        UNION ALL SELECT n_name || ' X' FROM nation WHERE n_regionkey = 1) x)
SELECT kind, array_to_string(list_sort(string_split(faults, ',')), ',') AS faults, COUNT(*) AS n_rows FROM found GROUP BY ALL"""
    by_person = BASE_SRC + ["kept", "person_days"]
    q["business_time_by_person"] = _sql(by_person, """
SELECT OrderServiceCode, _aprovador, m AS business_minutes,
       CASE WHEN m IS NULL THEN NULL
            ELSE (CASE WHEN m < 0 THEN '-' ELSE '' END) || printf('%02d', CAST(abs(m) // 60 AS BIGINT)) || ':'
                 || lpad(CAST(abs(m) % 60 AS VARCHAR), 2, '0') END AS business_text
FROM (SELECT k.OrderServiceCode, k._aprovador,
             CAST((d2.before_min + CASE WHEN d2.works THEN LEAST(GREATEST(hour(k._data_sla2) * 60 + minute(k._data_sla2), d2.s), d2.e) - d2.s ELSE 0 END)
                - (d1.before_min + CASE WHEN d1.works THEN LEAST(GREATEST(hour(k._data_sla1) * 60 + minute(k._data_sla1), d1.s), d1.e) - d1.s ELSE 0 END)
                AS BIGINT) AS m
      FROM kept k
      LEFT JOIN person_days d1 ON d1.person = k._aprovador AND d1.day = CAST(k._data_sla1 AS DATE)
      LEFT JOIN person_days d2 ON d2.person = k._aprovador AND d2.day = CAST(k._data_sla2 AS DATE))""")
    q["worked_days_by_person"] = _sql(by_person, """
SELECT CAST(d.YearWeek AS BIGINT) AS YearWeek, d.person AS _aprovador,
       CAST(SUM(CASE WHEN d.works THEN 1 ELSE 0 END) AS BIGINT) AS worked_days
FROM person_days d
JOIN (SELECT _aprovador, min(data_aprovacao) AS lo, max(data_aprovacao) AS hi FROM kept GROUP BY _aprovador) p
  ON p._aprovador = d.person AND d.day >= date_trunc('week', p.lo) AND d.day < date_trunc('week', p.hi) + INTERVAL 7 DAY
GROUP BY d.YearWeek, d.person""")
    return q
