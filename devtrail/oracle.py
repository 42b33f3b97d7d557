"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the DataFrame code, the way a SQL analyst would:
``row_number``/``QUALIFY`` for dedup, window ``min`` per model, ``lead``
over the sorted observations.  Each text is one self-contained statement
over the pre-registered test tables (``lineitem orders part events``): the
stand-in feeds and every intermediate table are CTEs, pulled in by name.
"""

from __future__ import annotations

from .sources.fixtures import SPOILED_SQL, VIEW_SQL

LO = "DATE '2000-01-01'"
HI = "DATE '2020-01-01'"
LO_LATE = "DATE '2001-06-01'"
HI_EARLY = "DATE '1996-01-01'"
AS_OF = "DATE '2001-10-01'"
DOMESTIC = "('SRC_0', 'SRC_1')"
OVERSEAS = "('SRC_2', 'SRC_3', 'SRC_4', 'SRC_5', 'SRC_6')"


def guard(c: str) -> str:
    return f"CASE WHEN length({c}) = 10 THEN TRY_CAST({c} AS DATE) END"


def day(c: str) -> str:
    return f"CASE WHEN length({c}) > 10 THEN TRY_CAST(substr({c}, 1, 10) AS DATE) END"


def within(s: str, e: str, m: str) -> str:
    return (
        f"CASE WHEN {s} IS NOT NULL AND {e} IS NOT NULL AND {m} > 0 THEN "
        f"CASE WHEN date_diff('day', {s}, {e}) <= ({m}) * 30 THEN '1' ELSE '2' END ELSE '4' END"
    )


NS_COLS = [
    "imei", "model", "mfg_date", "shipment_date", "order_id", "plant_id", "channel",
    "first_mfg_date", "first_shipment_date",
    "sdac_imei", "sdac_event_id", "sdac_create_date", "sdac_first_sdac_date",
    "act_imei", "act_activation_date", "act_first_checkin_date", "act_checkin_count",
    "first_launch_date",
]
NS_TYPES = [
    "BIGINT", "VARCHAR", "DATE", "DATE", "BIGINT", "BIGINT", "VARCHAR", "DATE", "DATE",
    "BIGINT", "BIGINT", "DATE", "DATE", "BIGINT", "DATE", "DATE", "BIGINT", "DATE",
]
X_COLS = ["uid", "uidtype", "imei", "toimei", "eventtype", "eventdate"]
X_TYPES = ["BIGINT", "VARCHAR", "BIGINT", "BIGINT", "VARCHAR", "DATE"]
R_COLS = [
    "data_source", "imei", "claim_date", "purchase_date", "warranty_period", "claim_id",
    "failure_count", "is_real_in_warranty",
]
R_TYPES = ["VARCHAR", "BIGINT", "DATE", "DATE", "INTEGER", "BIGINT", "VARCHAR", "VARCHAR"]


def _sel(alias: str, cols: list[str], prefix: str = "") -> str:
    return ", ".join(f"{alias}.{c} AS {prefix}{c}" for c in cols)


# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {name: ([], sql) for name, sql in VIEW_SQL.items()}

CTES.update({name: ([name.removesuffix("_spoiled")], sql) for name, sql in SPOILED_SQL.items()})
CTES.update({
    "st": (["shipment_orig"], f"""
SELECT imei, model, {guard('mfg_date')} AS mfg_date, {guard('shipment_date')} AS shipment_date,
       order_id, plant_id, channel FROM shipment_orig"""),
    "ship_latest": (["st"], f"""
SELECT * FROM st WHERE shipment_date >= {LO}
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY shipment_date DESC, model ASC NULLS FIRST,
  mfg_date ASC NULLS FIRST, order_id ASC NULLS FIRST, plant_id ASC NULLS FIRST, channel ASC NULLS FIRST) = 1"""),
    "model_dates": (["st"], f"""
SELECT model,
  CASE WHEN min(mfg_date) IS NOT NULL THEN least({HI}, min(mfg_date)) END AS first_mfg_date,
  CASE WHEN min(shipment_date) IS NOT NULL THEN least({HI}, min(shipment_date)) END AS first_shipment_date
FROM st GROUP BY model"""),
    "shipment": (["ship_latest", "model_dates"], """
SELECT s.*, m.first_mfg_date, m.first_shipment_date
FROM ship_latest s LEFT JOIN model_dates m ON s.model = m.model"""),
    "shipment_model": (["ship_latest"], "SELECT imei, model FROM ship_latest"),
    "sdt": (["sdac_orig"], f"SELECT imei, event_id, {guard('create_date')} AS create_date FROM sdac_orig"),
    "sdac_first": (["sdt"], f"""
SELECT * FROM sdt WHERE create_date < {HI}
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY create_date, event_id ASC NULLS FIRST) = 1"""),
    "sdac": (["sdac_first", "shipment_model"], f"""
SELECT f.imei, f.event_id, f.create_date,
       least({HI}, min(f.create_date) OVER (PARTITION BY m.model)) AS first_sdac_date
FROM sdac_first f JOIN shipment_model m ON f.imei = m.imei"""),
    "chk": (["uss_device"], f"""
SELECT imei, imsi, {day('last_ts')} AS activation_date FROM uss_device WHERE {day('last_ts')} IS NOT NULL"""),
    "act_latest": (["chk"], f"""
SELECT * FROM chk WHERE activation_date >= {LO}
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY activation_date DESC, imsi ASC NULLS FIRST) = 1"""),
    "activation": (["act_latest", "shipment_model"], f"""
SELECT a.imei, a.activation_date,
       least({HI}, min(a.activation_date) OVER (PARTITION BY m.model)) AS first_checkin_date,
       c.checkin_count
FROM act_latest a JOIN shipment_model m ON a.imei = m.imei
JOIN (SELECT imei, least(count(DISTINCT imsi), 2) AS checkin_count FROM act_latest GROUP BY imei) c
  ON a.imei = c.imei"""),
    "rt": (["repair_orig"], f"""
SELECT data_source, imei, {guard('claim_date')} AS claim_date, {guard('purchase_date')} AS purchase_date,
       TRY_CAST(warranty_period AS INTEGER) AS warranty_period, claim_id FROM repair_orig"""),
    "rep_dedup": (["rt"], f"""
SELECT * FROM rt WHERE claim_date < {HI}
QUALIFY row_number() OVER (PARTITION BY imei, claim_date ORDER BY data_source ASC NULLS FIRST,
  purchase_date ASC NULLS FIRST, warranty_period ASC NULLS FIRST, claim_id ASC NULLS FIRST) = 1"""),
    "rep_read": (["repair_orig"], f"""
SELECT * FROM (SELECT data_source, imei, {guard('claim_date')} AS claim_date, purchase_date, warranty_period, claim_id,
  {guard('purchase_date')} AS p, TRY_CAST(warranty_period AS INTEGER) AS w FROM repair_orig) WHERE claim_date < {HI}
QUALIFY row_number() OVER (PARTITION BY imei, claim_date ORDER BY data_source ASC NULLS FIRST,
  p ASC NULLS FIRST, w ASC NULLS FIRST, claim_id ASC NULLS FIRST) = 1"""),
    "rep_tagged": (["rep_dedup"], """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY imei ORDER BY claim_date) = 1 THEN '1' ELSE '2' END AS failure_count
FROM rep_dedup"""),
    "last_ship": (["st"], f"""
SELECT imei, greatest({LO}, max(shipment_date)) AS shipment_date FROM st
WHERE shipment_date IS NOT NULL GROUP BY imei"""),
    "rep_joined": (["rep_tagged", "last_ship"], """
SELECT t.*, l.shipment_date FROM rep_tagged t JOIN last_ship l ON t.imei = l.imei"""),
    "repair": (["rep_joined"], f"""
SELECT data_source, imei, claim_date, purchase_date, warranty_period, claim_id, failure_count,
  CASE WHEN warranty_period < 0 THEN '3'
       WHEN data_source IN {DOMESTIC} THEN
         CASE WHEN purchase_date IS NOT NULL THEN {within('purchase_date', 'claim_date', 'warranty_period')}
              ELSE {within('shipment_date', 'claim_date', 'warranty_period + 3')} END
       WHEN data_source IN {OVERSEAS} THEN {within('shipment_date', 'claim_date', 'warranty_period + 3')}
       ELSE '0' END AS is_real_in_warranty
FROM rep_joined WHERE warranty_period IS NOT NULL"""),
    "ns_joined": (["shipment", "sdac", "activation"], f"""
SELECT s.*, {_sel('d', ['imei', 'event_id', 'create_date', 'first_sdac_date'], 'sdac_')},
       {_sel('a', ['imei', 'activation_date', 'first_checkin_date', 'checkin_count'], 'act_')}
FROM shipment s LEFT JOIN sdac d ON s.imei = d.imei LEFT JOIN activation a ON s.imei = a.imei"""),
    "new_shipment": (["ns_joined"], f"""
SELECT *, least({HI}, min(sdac_first_sdac_date) OVER (PARTITION BY model),
                min(act_first_checkin_date) OVER (PARTITION BY model)) AS first_launch_date
FROM ns_joined"""),
    "ns_events": (["new_shipment"], "SELECT 'shipment' AS eventtype, shipment_date AS eventdate, * FROM new_shipment"),
    "seen": (["uss_device"], f"""
SELECT imsi, imei, {day('last_ts')} AS day FROM uss_device WHERE {day('last_ts')} IS NOT NULL"""),
    "cabandon": (["seen"], f"""
SELECT imsi AS uid, 'imsi' AS uidtype, imei, CAST(NULL AS BIGINT) AS toimei, 'cabandon' AS eventtype, day AS eventdate
FROM (SELECT * FROM seen WHERE day >= {LO}
      QUALIFY row_number() OVER (PARTITION BY imsi ORDER BY day DESC, imei ASC NULLS FIRST) = 1)
WHERE date_diff('day', day, {AS_OF}) > 28"""),
    "dabandon": (["seen"], f"""
SELECT CAST(NULL AS BIGINT) AS uid, CAST(NULL AS VARCHAR) AS uidtype, imei, CAST(NULL AS BIGINT) AS toimei,
       'dabandon' AS eventtype, last_day AS eventdate
FROM (SELECT imei, greatest({LO}, max(day)) AS last_day FROM seen GROUP BY imei)
WHERE date_diff('day', last_day, {AS_OF}) > 28"""),
    "obs": (["uss_device"], f"""
SELECT imsi, imei, model, {day('first_ts')} AS obs_date FROM uss_device
WHERE {day('first_ts')} IS NOT NULL AND {day('last_ts')} IS NOT NULL
UNION ALL
SELECT imsi, imei, model, {day('last_ts')} AS obs_date FROM uss_device
WHERE {day('first_ts')} IS NOT NULL AND {day('last_ts')} IS NOT NULL"""),
    "obs_pairs": (["obs"], """
SELECT imsi, imei AS l_imei, model AS l_model, obs_date AS l_date,
       lead(imei) OVER w AS r_imei, lead(model) OVER w AS r_model, lead(obs_date) OVER w AS r_date
FROM (SELECT DISTINCT * FROM obs)
WINDOW w AS (PARTITION BY imsi ORDER BY obs_date, imei ASC NULLS FIRST, model ASC NULLS FIRST)"""),
    "move": (["obs_pairs"], """
SELECT imsi AS uid, 'imsi' AS uidtype, l_imei AS imei, r_imei AS toimei, 'move' AS eventtype, r_date AS eventdate
FROM obs_pairs WHERE r_date IS NOT NULL AND l_imei <> r_imei AND l_model <> r_model AND l_date <> r_date"""),
    "swap": (["obs_pairs"], """
SELECT imsi AS uid, 'imsi' AS uidtype, l_imei AS imei, r_imei AS toimei, 'swap' AS eventtype, r_date AS eventdate
FROM obs_pairs WHERE r_date IS NOT NULL AND l_imei <> r_imei AND l_model = r_model AND l_date <> r_date"""),
    "exchange": (["cabandon", "dabandon", "swap"], """
SELECT * FROM cabandon UNION ALL SELECT * FROM dabandon UNION ALL SELECT * FROM swap"""),
    "new_complex": (["exchange", "new_shipment"], f"""
SELECT x.eventtype, x.eventdate, {_sel('n', NS_COLS)}, {_sel('x', X_COLS, 'xchg_')}
FROM exchange x JOIN new_shipment n ON x.imei = n.imei"""),
    "new_move": (["move", "new_shipment"], f"""
SELECT m.eventtype, m.eventdate, {_sel('f', NS_COLS)}, {_sel('m', X_COLS, 'xchg_')}, {_sel('t', NS_COLS, 'to_')}
FROM move m JOIN new_shipment f ON m.imei = f.imei JOIN new_shipment t ON m.toimei = t.imei"""),
    "new_repair": (["repair", "new_shipment"], f"""
SELECT 'repair' AS eventtype, r.claim_date AS eventdate, {_sel('n', NS_COLS)}, {_sel('r', R_COLS, 'rep_')}
FROM repair r JOIN new_shipment n ON r.imei = n.imei"""),
    "new_repair_exception": (["repair", "new_shipment"], f"""
SELECT {_sel('n', NS_COLS)}, {_sel('r', R_COLS, 'rep_')}
FROM repair r JOIN new_shipment n ON r.imei = n.imei
WHERE least(n.sdac_create_date, n.act_activation_date) > r.claim_date"""),
})


def _timeline_sql() -> str:
    full = (
        [("eventtype", "VARCHAR"), ("eventdate", "DATE")]
        + list(zip(NS_COLS, NS_TYPES))
        + [("xchg_" + c, t) for c, t in zip(X_COLS, X_TYPES)]
        + [("rep_" + c, t) for c, t in zip(R_COLS, R_TYPES)]
        + [("to_" + c, t) for c, t in zip(NS_COLS, NS_TYPES)]
    )

    def branch(src: str, has: set[str]) -> str:
        cols = ", ".join(c if c in has else f"CAST(NULL AS {t}) AS {c}" for c, t in full)
        return f"SELECT {cols} FROM {src}"

    base = {"eventtype", "eventdate", *NS_COLS}
    xs = {"xchg_" + c for c in X_COLS}
    rs = {"rep_" + c for c in R_COLS}
    ts = {"to_" + c for c in NS_COLS}
    return "\nUNION ALL\n".join([
        branch("ns_events", base),
        branch("new_complex", base | xs),
        branch("new_move", base | xs | ts),
        branch("new_repair", base | rs),
    ])


CTES["timeline"] = (["ns_events", "new_complex", "new_move", "new_repair"], _timeline_sql())


def with_ctes(body: str, needs: list[str]) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}


def q(name: str, needs: list[str], body: str) -> None:
    ORACLE[name] = with_ctes(body, needs)


# B: guards
q("b1_width_guard", ["shipment_orig", "sdac_orig"], """
SELECT 29 AS n_fields, true AS accepted, count(*) AS n FROM shipment_orig
UNION ALL SELECT 7 AS n_fields, false AS accepted, count(*) AS n FROM sdac_orig""")
q("b2_valid_date", ["shipment_orig"], f"""
SELECT mfg_date AS mfg_text, shipment_date AS ship_text, {guard('mfg_date')} AS mfg_day,
       {guard('shipment_date')} AS ship_day FROM shipment_orig""")
q("b3_day_of_timestamp", ["uss_device"], f"""
SELECT first_ts, last_ts, {day('first_ts')} AS first_day, {day('last_ts')} AS last_day FROM uss_device""")
q("b4_stale_filter", ["sdt"], f"SELECT * FROM sdt WHERE date_diff('day', create_date, {AS_OF}) > 28")
q("b5_in_order", ["st"], """
SELECT imei, order_id, mfg_date, shipment_date, coalesce(mfg_date <= shipment_date, true) AS in_order FROM st""")
q("b6_ship_before_mfg", ["st"], "SELECT * FROM st WHERE mfg_date > shipment_date")
# D: functions
q("d1_min_date", ["rt"], "SELECT imei, claim_id, purchase_date, claim_date, least(purchase_date, claim_date) AS first_date FROM rt")
q("d4_within_period", ["rt"], f"""
SELECT imei, claim_id, purchase_date, claim_date, warranty_period,
       {within('purchase_date', 'claim_date', 'warranty_period')} AS within FROM rt""")
q("d5_warranty_tag", ["repair"], "SELECT data_source, is_real_in_warranty, count(*) AS n FROM repair GROUP BY ALL")
q("d6_source_bucket_counts", ["repair_orig"], f"""
SELECT CASE WHEN data_source IN {DOMESTIC} THEN 'domestic' WHEN data_source IN {OVERSEAS} THEN 'overseas'
            ELSE 'unknown' END AS bucket, count(*) AS n FROM repair_orig GROUP BY ALL""")
q("d8_event_header", ["ns_events"], "SELECT * FROM ns_events")
q("d11_observations", ["obs"], "SELECT * FROM obs")
q("d12_shipment_model", ["shipment_model"], "SELECT * FROM shipment_model")
q("f2_distinct_observations", ["obs"], "SELECT DISTINCT * FROM obs")
# C: aggregation
q("c1_latest_shipment", ["ship_latest"], "SELECT * FROM ship_latest")
q("c1_shipment_rejects_lo2001", ["st"], f"""
SELECT * FROM st WHERE shipment_date IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY shipment_date DESC, model ASC NULLS FIRST,
  mfg_date ASC NULLS FIRST, order_id ASC NULLS FIRST, plant_id ASC NULLS FIRST, channel ASC NULLS FIRST) = 1
  AND shipment_date < {LO_LATE}""")
q("c1_latest_device_per_sim", ["seen"], f"""
SELECT imsi, imei, day FROM seen WHERE day >= {LO}
QUALIFY row_number() OVER (PARTITION BY imsi ORDER BY day DESC, imei ASC NULLS FIRST) = 1""")
q("c1_latest_sim_per_device", ["act_latest"], "SELECT * FROM act_latest")
q("c2_earliest_sdac", ["sdac_first"], "SELECT * FROM sdac_first")
q("c2b_repair_dedupe", ["rep_dedup"], "SELECT * FROM rep_dedup")
_REP_ORDER = """ORDER BY data_source ASC NULLS FIRST,
  purchase_date ASC NULLS FIRST, warranty_period ASC NULLS FIRST, claim_id ASC NULLS FIRST"""
q("c2b_repair_rejects_hi1996", ["rt"], f"""
SELECT * FROM rt WHERE claim_date >= {HI_EARLY}
QUALIFY row_number() OVER (PARTITION BY imei, claim_date {_REP_ORDER}) = 1""")
q("c2b_repair_dedupe_hi1996", ["rt"], f"""
SELECT * FROM rt WHERE claim_date < {HI_EARLY}
QUALIFY row_number() OVER (PARTITION BY imei, claim_date {_REP_ORDER}) = 1""")
q("c3_first_mfg_date", ["model_dates"], "SELECT model, first_mfg_date FROM model_dates")
q("c3_first_ship_date", ["st"], f"""
SELECT model, least({HI}, min(shipment_date)) AS first_shipment_date FROM st
WHERE shipment_date IS NOT NULL GROUP BY model""")
q("c3_first_ship_date_hi1996", ["st"], f"""
SELECT model, least({HI_EARLY}, min(shipment_date)) AS first_shipment_date FROM st
WHERE shipment_date IS NOT NULL GROUP BY model""")
q("c3_first_checkin_date", ["act_latest", "shipment_model"], f"""
SELECT m.model, least({HI}, min(a.activation_date)) AS first_checkin_date
FROM act_latest a JOIN shipment_model m ON a.imei = m.imei GROUP BY m.model""")
q("c3_first_sdac_date", ["sdac_first", "shipment_model"], f"""
SELECT m.model, least({HI}, min(f.create_date)) AS first_sdac_date
FROM sdac_first f JOIN shipment_model m ON f.imei = m.imei GROUP BY m.model""")
q("c4_last_seen_per_device", ["chk"], f"""
SELECT imei, greatest({LO}, max(activation_date)) AS last_seen FROM chk GROUP BY imei""")
q("c4_last_seen_per_device_lo2001", ["chk"], f"""
SELECT imei, greatest({LO_LATE}, max(activation_date)) AS last_seen FROM chk GROUP BY imei""")
q("c4_last_ship_date", ["last_ship"], "SELECT * FROM last_ship")
q("c5_first_launch_date", ["new_shipment"], "SELECT DISTINCT model, first_launch_date FROM new_shipment")
q("c6_checkin_count", ["act_latest"], """
SELECT imei, least(count(DISTINCT imsi), 2) AS checkin_count FROM act_latest GROUP BY imei""")
q("c6_checkin_count_raw", ["chk"], """
SELECT imei, least(count(DISTINCT imsi), 2) AS checkin_count FROM chk GROUP BY imei""")
# W: sequences
q("w1_failure_count", ["rep_tagged"], "SELECT * FROM rep_tagged")
q("w2_move", ["move"], "SELECT * FROM move")
q("w2_swap", ["swap"], "SELECT * FROM swap")
q("w2_transition_counts", ["move", "swap"], """
SELECT eventtype, count(*) AS n FROM (SELECT eventtype FROM move UNION ALL SELECT eventtype FROM swap) GROUP BY ALL""")
# E: joins
q("e1_repair_x_shipment", ["rep_tagged", "last_ship"], """
SELECT t.*, l.shipment_date FROM rep_tagged t JOIN last_ship l ON t.imei = l.imei""")
q("e1_activation_x_model", ["act_latest", "shipment_model"], """
SELECT a.*, m.model FROM act_latest a JOIN shipment_model m ON a.imei = m.imei""")
q("e2_left_enrich", ["shipment", "sdac"], f"""
SELECT s.*, {_sel('d', ['imei', 'event_id', 'create_date', 'first_sdac_date'], 'sdac_')}
FROM shipment s LEFT JOIN sdac d ON s.imei = d.imei""")
q("e3_full_outer_model_dates", ["sdac", "activation", "shipment_model"], """
SELECT coalesce(a.model, b.model) AS model, a.first_sdac_date, b.first_checkin_date
FROM (SELECT DISTINCT m.model, d.first_sdac_date FROM sdac d JOIN shipment_model m ON d.imei = m.imei) a
FULL OUTER JOIN
     (SELECT DISTINCT m.model, c.first_checkin_date FROM activation c JOIN shipment_model m ON c.imei = m.imei) b
ON a.model = b.model""")
q("e4_sdac_not_shipped", ["sdac_first", "shipment"], """
SELECT * FROM sdac_first WHERE imei NOT IN (SELECT imei FROM shipment)""")
q("e4_activation_not_shipped", ["uss_device", "shipment"], f"""
SELECT imei, imsi, model, first_ts, last_ts FROM uss_device
WHERE {day('last_ts')} >= {LO}
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY {day('last_ts')} DESC, imsi ASC NULLS FIRST,
  model ASC NULLS FIRST, first_ts ASC NULLS FIRST, last_ts ASC NULLS FIRST) = 1
  AND imei NOT IN (SELECT imei FROM shipment)""")
q("e4_repair_not_shipped", ["rep_read", "shipment"], """
SELECT * EXCLUDE (p, w) FROM rep_read WHERE imei NOT IN (SELECT imei FROM shipment)""")
q("e4_cabandon_not_shipped", ["cabandon", "shipment"], """
SELECT * FROM cabandon WHERE imei NOT IN (SELECT imei FROM shipment)""")
q("e4_dabandon_not_shipped", ["dabandon", "shipment"], """
SELECT * FROM dabandon WHERE imei NOT IN (SELECT imei FROM shipment)""")
q("e5_broadcast_model_dates", ["shipment_model", "model_dates"], """
SELECT s.model, s.imei, m.first_mfg_date, m.first_shipment_date
FROM shipment_model s LEFT JOIN model_dates m ON s.model = m.model""")
q("e6_move_both_ends", ["move", "shipment"], """
SELECT m.uid AS xchg_uid, f.imei, f.model, t.imei AS to_imei, t.model AS to_model, m.eventdate AS xchg_eventdate
FROM move m JOIN shipment f ON m.imei = f.imei JOIN shipment t ON m.toimei = t.imei""")
# F: timeline
q("f1_union_all", ["timeline"], "SELECT * FROM timeline")
q("f1_event_counts", ["timeline"], "SELECT eventtype, count(*) AS n FROM timeline GROUP BY ALL")
# P: jobs
q("p2_shipment", ["shipment"], "SELECT * FROM shipment")
q("p3_sdac", ["sdac"], "SELECT * FROM sdac")
q("p4_activation", ["activation"], "SELECT * FROM activation")
q("p5_repair", ["repair"], "SELECT * FROM repair")
q("p6_new_shipment", ["new_shipment"], "SELECT * FROM new_shipment")
q("p6_new_shipment_exception", ["new_shipment"], """
SELECT * FROM new_shipment WHERE shipment_date > least(sdac_create_date, act_activation_date)""")
q("p7_new_complex", ["new_complex"], "SELECT * FROM new_complex")
q("p8_new_move", ["new_move"], "SELECT * FROM new_move")
q("p9_new_repair", ["new_repair"], "SELECT * FROM new_repair")
q("p9_new_repair_exception", ["new_repair_exception"], "SELECT * FROM new_repair_exception")
q("p11_cabandon", ["cabandon"], "SELECT * FROM cabandon")
q("p12_dabandon", ["dabandon"], "SELECT * FROM dabandon")
# A: text edges (the oracle sees the typed tables the text must reproduce)
q("a1_text_roundtrip", ["shipment_orig"], "SELECT * FROM shipment_orig")
q("a2_multi_path_scan", ["exchange"], "SELECT * FROM exchange")
q("a4_shipment_text_roundtrip", ["shipment"], "SELECT * FROM shipment")
q("a5_ragged_render", ["timeline"], """
SELECT eventtype, CASE eventtype WHEN 'shipment' THEN 46 WHEN 'repair' THEN 91 WHEN 'move' THEN 135 ELSE 52 END
       AS n_fields, count(*) AS n FROM timeline GROUP BY ALL""")

q("a5_timeline_roundtrip", ["timeline"], "SELECT * FROM timeline")


def _t(c: str, absent: str = "\\N") -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '{absent}')"


# Text outputs by position: number of fields, then the text of some of them.
q("e4_sdac_text", ["sdac_first", "shipment"], f"""
SELECT 7 AS n_fields, {_t('imei')} AS f1, {_t('create_date')} AS f4 FROM sdac_first WHERE imei NOT IN (SELECT imei FROM shipment)""")
q("e4_activation_text", ["uss_device", "shipment"], f"""
SELECT 13 AS n_fields, {_t('imei')} AS f3, {_t('imsi')} AS f4, {_t('last_ts')} AS f10 FROM uss_device
WHERE {day('last_ts')} >= {LO}
QUALIFY row_number() OVER (PARTITION BY imei ORDER BY {day('last_ts')} DESC, imsi ASC NULLS FIRST,
  model ASC NULLS FIRST, first_ts ASC NULLS FIRST, last_ts ASC NULLS FIRST) = 1
  AND imei NOT IN (SELECT imei FROM shipment)""")
q("e4_repair_text", ["rep_read", "shipment"], f"""
SELECT 37 AS n_fields, {_t('imei')} AS f4, {_t('claim_date')} AS f13, {_t('purchase_date')} AS f14, {_t('warranty_period')} AS f27
FROM rep_read WHERE imei NOT IN (SELECT imei FROM shipment)""")
for _table in ("cabandon", "dabandon"):
    q(f"e4_{_table}_text", [_table, "shipment"], f"""
SELECT 6 AS n_fields, {_t('uid', 'NA')} AS f0, {_t('uidtype', 'NA')} AS f1, {_t('imei')} AS f2, {_t('toimei', 'NA')} AS f3, eventtype AS f4,
  {_t('eventdate')} AS f5 FROM {_table} WHERE imei NOT IN (SELECT imei FROM shipment)""")
_SHIP_TEXT = f"""eventtype AS f0, {_t('eventdate')} AS f1, {_t('imei')} AS f11, {_t('first_mfg_date', 'NA')} AS f31, {_t('sdac_imei')} AS f34,
  {_t('first_launch_date', 'NA')} AS f45"""
_XCHG_TEXT = f"{_t('xchg_uid', 'NA')} AS f46, {_t('xchg_uidtype', 'NA')} AS f47, {_t('xchg_toimei', 'NA')} AS f49"
q("a5_complex_text", ["new_complex"], f"""
SELECT 52 AS n_fields, {_SHIP_TEXT}, {_XCHG_TEXT}, NULL AS f56, NULL AS f90, NULL AS f100, NULL AS f134 FROM new_complex""")
q("a5_move_text", ["new_move"], f"""
SELECT 135 AS n_fields, {_SHIP_TEXT}, {_XCHG_TEXT}, '\\N' AS f56, '\\N' AS f90, {_t('to_imei')} AS f100, {_t('to_first_launch_date', 'NA')} AS f134
FROM new_move""")
q("a5_repair_text", ["new_repair"], f"""
SELECT 91 AS n_fields, {_SHIP_TEXT}, '\\N' AS f46, '\\N' AS f47, '\\N' AS f49, {_t('rep_imei')} AS f56, {_t('rep_is_real_in_warranty')} AS f90,
  NULL AS f100, NULL AS f134 FROM new_repair""")
q("p10_union_text", ["ns_events", "new_complex", "new_move", "new_repair"], f"""
SELECT 46 AS n_fields, {_SHIP_TEXT}, {', '.join(f'NULL AS f{i}' for i in (46, 47, 49, 56, 90, 100, 134))} FROM ns_events
UNION ALL SELECT 52, {_SHIP_TEXT}, {_XCHG_TEXT}, NULL, NULL, NULL, NULL FROM new_complex
UNION ALL SELECT 135, {_SHIP_TEXT}, {_XCHG_TEXT}, '\\N', '\\N', {_t('to_imei')}, {_t('to_first_launch_date', 'NA')} FROM new_move
UNION ALL SELECT 91, {_SHIP_TEXT}, '\\N', '\\N', '\\N', {_t('rep_imei')}, {_t('rep_is_real_in_warranty')}, NULL, NULL FROM new_repair""")
q("g1_file_rows", ["uss_device"], "SELECT count(*) AS n_rows, true AS within_limit, true AS even FROM uss_device")
q("a6_overwrite", ["sdac_orig"], "SELECT CAST(imei AS VARCHAR) AS imei, CAST(event_id AS VARCHAR) AS event_id, create_date, 'written' AS second "
  "FROM sdac_orig WHERE create_date = ''")
q("a7_error_if_exists", ["sdac_orig"], "SELECT CAST(imei AS VARCHAR) AS imei, CAST(event_id AS VARCHAR) AS event_id, create_date, 'PATH_ALREADY_EXISTS' AS second "
  "FROM sdac_orig")
_GUARDS = {"shipment_orig": guard("shipment_date"), "sdac_orig": guard("create_date"), "uss_device": day("last_ts"), "repair_orig": guard("claim_date")}
q("b2_date_rejects", list(_GUARDS), " UNION ALL ".join(
    f"SELECT '{f}' AS feed, count(*) AS records, count(*) FILTER (({g}) IS NULL) AS rejects, count({g}) AS good FROM {f}" for f, g in _GUARDS.items()))
q("d5_warranty_tag_any_period", ["rt"], f"""
SELECT period, CASE WHEN period < 0 THEN '3'
       WHEN data_source IN {DOMESTIC} THEN
         CASE WHEN purchase_date IS NOT NULL THEN {within('purchase_date', 'claim_date', 'CAST(period AS BIGINT)')} ELSE '4' END
       WHEN data_source IN {OVERSEAS} THEN {within('purchase_date', 'claim_date', 'CAST(period AS BIGINT) + 3')}
       ELSE '0' END AS tag, count(*) AS n
FROM rt, (SELECT unnest([99999999, 2147483647, -2147483648]) AS period) GROUP BY ALL""")

# Guards of feeds with impossible dates: the conditions that each row fails.
_SPOILED = {
    "shipment_orig": ("order_id", {"mfg_date": f"mfg_date <> '' AND ({guard('mfg_date')}) IS NULL", "shipment_date": f"({guard('shipment_date')}) IS NULL"}),
    "sdac_orig": ("event_id", {"create_date": f"({guard('create_date')}) IS NULL"}),
    "uss_device": ("imsi", {"first_ts": f"({day('first_ts')}) IS NULL", "last_ts": f"({day('last_ts')}) IS NULL"}),
    "repair_orig": ("claim_id", {"claim_date": f"({guard('claim_date')}) IS NULL", "purchase_date": f"purchase_date <> '' AND ({guard('purchase_date')}) IS NULL",
                                 "warranty_period": "TRY_CAST(warranty_period AS INTEGER) IS NULL"}),
}


def _any(feed: str) -> str:
    return "(" + " OR ".join(f"({g})" for g in _SPOILED[feed][1].values()) + ")"


def _failed(feed: str) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {g} THEN '{f}' END" for f, g in _SPOILED[feed][1].items()) + ")"


_ALL_SPOILED = [f"{f}_spoiled" for f in _SPOILED]
q("b2_guard_outcomes", _ALL_SPOILED, " UNION ALL ".join(
    f"SELECT '{f}' AS feed, count(*) AS records, count(*) FILTER ({key} % 31 <> 0 AND NOT {_any(f)}) AS good, "
    f"count(*) FILTER ({key} % 31 <> 0 AND {_any(f)}) AS rejects, count(*) FILTER ({key} % 31 = 0) AS bad_lines FROM {f}_spoiled" for f, (key, _) in _SPOILED.items()))
q("b2_guard_rejects", ["shipment_orig_spoiled", "repair_orig_spoiled"], f"""
SELECT 'shipment_orig' AS feed, imei, order_id AS record, mfg_date AS first, shipment_date AS second, {_failed('shipment_orig')} AS failed
FROM shipment_orig_spoiled WHERE {_any('shipment_orig')}
UNION ALL SELECT 'repair_orig', imei, claim_id, claim_date, purchase_date, {_failed('repair_orig')} FROM repair_orig_spoiled WHERE {_any('repair_orig')}""")
q("b2_guard_counts", _ALL_SPOILED, " UNION ALL ".join(
    f"SELECT '{f}' AS feed, '{field}' AS guard, count(*) FILTER ({g}) AS n FROM {f}_spoiled" for f, (_, gs) in _SPOILED.items() for field, g in gs.items()))
q("b3_timestamp_rejects", ["uss_device_spoiled"], f"""
SELECT imei, imsi, model, first_ts, last_ts, {_failed('uss_device')} AS failed_guards FROM uss_device_spoiled WHERE {_any('uss_device')}""")
q("b3_checkins_used", ["uss_device_spoiled"], f"""
SELECT count(*) AS records, count(*) FILTER (({day('first_ts')}) IS NOT NULL AND ({day('last_ts')}) IS NOT NULL) AS used,
  count(*) FILTER ({_any('uss_device')}) AS rejects FROM uss_device_spoiled""")
q("p13_spoiled_transitions", ["uss_device_spoiled"], f"""
SELECT imsi AS uid, 'imsi' AS uidtype, l_imei AS imei, imei AS toimei, CASE WHEN l_model = model THEN 'swap' ELSE 'move' END AS eventtype, d AS eventdate
FROM (SELECT *, lag(imei) OVER w AS l_imei, lag(model) OVER w AS l_model, lag(d) OVER w AS l_d FROM (
  SELECT DISTINCT imsi, imei, model, unnest([f, l]) AS d FROM (
    SELECT imsi, imei, model, {day('first_ts')} AS f, {day('last_ts')} AS l FROM uss_device_spoiled) WHERE f IS NOT NULL AND l IS NOT NULL)
  WINDOW w AS (PARTITION BY imsi ORDER BY d, imei, model))
WHERE l_imei <> imei AND l_d <> d""")
