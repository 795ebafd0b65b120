"""SQL giving the answers of ``event_queries`` from the plain columns."""

from __future__ import annotations

from claimgauge.plans.claim_oracles import CLAIMS
from claimgauge.sources.standin_events import SHIFT_DAYS

# handler, pipeline number, metric, approved, tables, whether one noisy event in
# thirteen lacks a table, whether the time is checked before the partner, whether a
# null payload fails the match
HANDLERS = """handlers(handler, which, metric, approved, tables, lacks, time_first, fails) AS (VALUES
  ('filtered_pre/approval', 0, 'filtered_pre', 'true', 2, TRUE, FALSE, TRUE),
  ('processable/approval', 0, 'processable', 'true', 2, TRUE, FALSE, TRUE),
  ('filtered_post/approval', 0, 'filtered_post', 'true', 2, TRUE, FALSE, TRUE),
  ('selected_savings/approval', 0, 'selected_savings', NULL, 1, FALSE, FALSE, TRUE),
  ('savings/approval', 0, 'savings', 'true', 1, TRUE, FALSE, TRUE),
  ('new_providers/approval', 0, 'new_providers', 'true', 4, TRUE, TRUE, TRUE),
  ('new_members/approval', 0, 'new_members', 'true', 4, TRUE, TRUE, TRUE),
  ('provider_ratio/approval', 0, 'provider_ratio', 'true', 4, TRUE, TRUE, TRUE),
  ('member_ratio/approval', 0, 'member_ratio', 'true', 4, TRUE, TRUE, TRUE),
  ('filtered_pre/wrangling', 1, 'filtered_pre', 'false', 2, TRUE, FALSE, FALSE),
  ('processable/wrangling', 1, 'processable', 'false', 2, TRUE, FALSE, FALSE),
  ('new_providers/wrangling', 1, 'new_providers', 'false', 4, TRUE, TRUE, FALSE),
  ('new_members/wrangling', 1, 'new_members', 'false', 4, TRUE, TRUE, FALSE),
  ('provider_ratio/wrangling', 1, 'provider_ratio', 'false', 4, TRUE, TRUE, FALSE),
  ('member_ratio/wrangling', 1, 'member_ratio', 'false', 4, TRUE, TRUE, FALSE),
  ('filtered_post/selection', 2, 'filtered_post', 'false', 2, TRUE, FALSE, FALSE),
  ('savings/evaluation', 3, 'savings', 'false', 1, FALSE, FALSE, TRUE),
  ('sent_over_received', 4, 'sent_over_received', NULL, 5, TRUE, FALSE, FALSE),
  ('sent_over_validation', 4, 'sent_over_validation', NULL, 3, TRUE, FALSE, FALSE),
  ('shared_invoice', 4, 'shared_invoice', NULL, 3, TRUE, FALSE, FALSE),
  ('sent_over_accepted', 4, 'sent_over_accepted', NULL, 4, TRUE, FALSE, FALSE),
  ('expired', 5, 'expired', NULL, 2, TRUE, FALSE, FALSE))"""

EVENTS = """e AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 7 AS which,
    CASE event_id % 7 WHEN 0 THEN 'pipesv2_approval' WHEN 1 THEN 'pipesv2_wrangling'
      WHEN 2 THEN 'pipesv2_selection' WHEN 3 THEN 'pipesv2_evaluation'
      WHEN 4 THEN 'pipesv2_submission' WHEN 5 THEN 'pipesv2_release'
      ELSE 'other_pipeline' END AS pipeline_uuid,
    CASE WHEN event_type IN ('purchase', 'view') THEN 'COMPLETED' WHEN event_type = 'click'
      THEN 'RUNNING' WHEN event_type = 'signup' THEN 'INITIAL' ELSE 'FAILED' END AS status,
    CASE WHEN event_id % 11 <> 0 AND event_id % 17 <> 0
      THEN 'p' || CAST(user_id % 10 AS VARCHAR) END AS partner,
    CASE WHEN event_id % 23 <> 0 AND event_id % 29 <> 0 THEN ts END AS as_of,
    event_id % 11 = 0 AS no_partner, event_id % 13 = 0 AS lacks_table,
    event_id % 17 = 0 AS no_variables, event_id % 19 = 0 AS no_payload,
    event_id % 29 <> 0 AS has_time,
    CASE WHEN event_id % 37 = 0 THEN 'broken' WHEN event_id % 31 = 0 THEN 'undecodable'
      WHEN event_id % 2 = 1 AND event_id % 29 = 0 THEN 'undecodable'
      ELSE 'decoded' END AS decoding
  FROM events)"""

MATCHED = """matched AS (
  SELECT e.*, h.* EXCLUDE (which), CASE WHEN no_variables THEN 'internal_error'
      WHEN h.lacks AND lacks_table THEN 'bad_request'
      WHEN h.time_first AND as_of IS NULL THEN 'internal_error'
      WHEN no_partner THEN 'bad_request'
      WHEN as_of IS NULL THEN 'internal_error' END AS error
  FROM e JOIN handlers h ON h.which = e.which
  WHERE decoding = 'decoded' AND NOT no_payload AND status = 'COMPLETED'
  UNION ALL
  SELECT e.*, 'run_count', 'run_count', NULL, 0, FALSE, TRUE, FALSE,
    CASE WHEN no_variables OR as_of IS NULL THEN 'internal_error' END
  FROM e WHERE decoding = 'decoded' AND NOT no_payload AND has_time)"""

FAILED = """failed AS (
  SELECT event_id, 'match' AS stage, handler, 'match_error' AS error FROM e, handlers
  WHERE decoding = 'decoded' AND no_payload AND fails
  UNION ALL SELECT event_id, 'match', 'run_count', 'match_error' FROM e
  WHERE decoding = 'decoded' AND no_payload AND has_time
  UNION ALL SELECT event_id, 'handle', handler, error FROM matched WHERE error IS NOT NULL)"""


def _with(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([HANDLERS, EVENTS, MATCHED, FAILED, *more]) + "\n" + select


_COUNTED = "FROM matched WHERE handler = 'run_count' AND error IS NULL"


def _counts(*columns: str) -> str:
    listed = ", ".join(["pipeline_uuid", "pipeline_status", *columns])
    return _with(f"""SELECT {listed}, CAST(COUNT(*) AS DOUBLE) AS runs FROM (
      SELECT *, status AS pipeline_status {_COUNTED}) GROUP BY {listed}""")


# the first table that the first refusing handler of a pipeline misses in one event of thirteen
_LACKING = """CASE e.which WHEN 0 THEN 'unprocessable_claims_input_table'
  WHEN 1 THEN 'refined_unprocessable_claims_output_table' WHEN 2 THEN 'savings_input_table'
  WHEN 4 THEN 'manual_validation_output_table'
  WHEN 5 THEN 'manual_validation.manual_validation_claims_input_table' END"""

_VISIBLE = "decoding = 'decoded' AND NOT no_payload"

# ---- whole evaluations -------------------------------------------------------------

# every event is a run; those of one pipeline, partner and day ask the same and are worked
# out once, under the least of their ids
RUNS = f"""runs AS (
  SELECT *, MIN(event_id) OVER (PARTITION BY which, partner, as_of) AS rep,
    -- the day in the offset of the event
    CAST(as_of - CASE partner WHEN 'AMERICA' THEN INTERVAL 5 HOUR ELSE INTERVAL 0 HOUR END AS DATE) AS as_day
  FROM (
    SELECT event_id, event_id % 7 AS which, r_name AS partner,
      CAST(ts AS DATE) - INTERVAL {SHIFT_DAYS} DAY + INTERVAL 10 MINUTE AS as_of
    FROM events JOIN region ON r_regionkey = user_id % 5))"""


def _runs(*which: int) -> str:
    listed = ", ".join(map(str, which))
    return f"""r AS (SELECT rep AS event_id, which, partner, as_of, as_day, day(as_of) AS dd, day(as_of) % 7 AS m
  FROM runs WHERE which IN ({listed}) AND event_id = rep)"""


def _point(metric: str, value: str, rows: str, **labels: str) -> str:
    shown = {"partner": "r.partner", "approved": "NULL", "agent_id": "NULL", "status": "NULL",
             "source": "NULL", **labels}
    listed = ", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in shown.items())
    return f"""SELECT r.event_id AS rep, '{metric}' AS metric_name,
  CAST({value} AS DOUBLE) AS value, {listed} FROM {rows}"""


def _all(which: int | tuple[int, ...], ctes: list[str], points: list[str]) -> str:
    which = which if isinstance(which, tuple) else (which,)
    head = "WITH " + ",\n".join([CLAIMS, RUNS, _runs(*which), *ctes])
    asked = "\nUNION ALL\n".join(points)
    return f"""{head},
asked AS ({asked})
SELECT CAST(runs.event_id AS VARCHAR) AS event_id, asked.* EXCLUDE (rep)
FROM asked JOIN runs ON runs.rep = asked.rep"""


_BATCH = "claims c ON c.partner = r.partner AND day(c.ts) = r.dd"

PAID = f"""paid AS (SELECT r.event_id, r.partner,
  CAST(COALESCE(SUM(CASE WHEN c.processable THEN c.paid_value END), 0) AS DOUBLE) AS done,
  CAST(COALESCE(SUM(CASE WHEN NOT c.processable THEN c.paid_value END), 0) AS DOUBLE) AS held,
  COUNT(CASE WHEN c.processable THEN 1 END) > 0 AS some_done
  FROM r LEFT JOIN {_BATCH} GROUP BY r.event_id, r.partner)"""


def _paid_points(approved: str) -> list[str]:
    a = {"approved": f"'{approved}'"}
    both = "r.done + r.held > 0"
    pre, ok = "claims/pipeline/filtered_pre/paid_value", "claims/pipeline/processable/paid_value"
    return [
        _point(f"{pre}/total", "held", "paid r", **a),
        _point(f"{pre}/relative", f"CASE WHEN {both} THEN held / (done + held) ELSE 0 END",
               "paid r WHERE some_done", **a),
        _point(f"{ok}/total", "done", "paid r", **a),
        _point(f"{ok}/relative", "done / (done + held)", f"paid r WHERE {both}", **a),
    ]


def _entity_ctes(entity: str, batch: str = f"r JOIN {_BATCH}", known: str = "TRUE") -> list[str]:
    """``known`` says whose history has rows."""
    day = "r.as_day"
    past = f"r JOIN claims h ON h.partner = r.partner AND {known}"
    name = entity.split("_")[0]
    return [
        f"""{name}_batch AS (SELECT DISTINCT r.event_id, c.{entity} AS entity
  FROM {batch})""",
        f"""{name}_known AS (SELECT DISTINCT r.event_id, h.{entity} AS entity FROM {past}
  WHERE h.ts >= {day} - INTERVAL 90 DAY AND NOT EXISTS (SELECT 1 FROM items i
    WHERE i.event_id = r.event_id AND i.item_id = h.item_id))""",
        f"""{name}_new AS (SELECT r.event_id, r.partner, r.approved, r.has_history, COUNT(b.entity) AS n,
  COUNT(CASE WHEN k.entity IS NULL THEN b.entity END) AS fresh
  FROM whole r LEFT JOIN {name}_batch b ON b.event_id = r.event_id
  LEFT JOIN {name}_known k ON k.event_id = r.event_id AND k.entity = b.entity
  GROUP BY r.event_id, r.partner, r.approved, r.has_history)""",
        f"""{name}_latest AS (SELECT event_id, COUNT(*) AS n FROM (
  SELECT event_id, entity FROM {name}_batch UNION
  SELECT r.event_id, h.{entity} FROM {past} WHERE h.ts >= {day} - INTERVAL 30 DAY)
  WHERE entity IS NOT NULL GROUP BY event_id)""",
        f"""{name}_before AS (SELECT r.event_id, COUNT(DISTINCT h.{entity}) AS n FROM {past}
  WHERE h.ts >= {day} - INTERVAL 60 DAY AND h.ts < {day} - INTERVAL 30 DAY
  GROUP BY r.event_id)""",
    ]


# a run's batch tables exist if they have rows; without both, the run is refused
_APPROVED = "CASE r.which WHEN 0 THEN 'true' ELSE 'false' END"
WHOLE = f"""whole AS (SELECT r.event_id, r.partner, {_APPROVED} AS approved, TRUE AS has_history
  FROM r JOIN {_BATCH} GROUP BY r.event_id, r.partner, r.which
  HAVING COUNT(CASE WHEN c.processable THEN 1 END) > 0
    AND COUNT(CASE WHEN NOT c.processable THEN 1 END) > 0)"""
ITEMS = f"items AS (SELECT DISTINCT r.event_id, c.item_id FROM r JOIN {_BATCH})"


def _entity_points(name: str, label: str) -> list[str]:
    a = {"approved": "r.approved"}
    return [
        _point(f"claims/pipeline/{label}/new_pct_last_3_mo", "CASE WHEN NOT has_history THEN 1 "
               "WHEN n > 0 THEN CAST(fresh AS DOUBLE) / n ELSE 0 END", f"{name}_new r", **a),
        _point(f"claims/pipeline/{label}/volume_ratio_last_1_mo",
               "CASE WHEN NOT has_history OR COALESCE(b.n, 0) = 0 THEN 1 ELSE CAST(COALESCE(l.n, 0) AS DOUBLE) / b.n "
               "END", f"whole r LEFT JOIN {name}_latest l ON l.event_id = r.event_id "
               f"LEFT JOIN {name}_before b ON b.event_id = r.event_id", **a),
    ]


SAVED = f"""saved AS (SELECT r.event_id, r.partner,
  CAST(COALESCE(SUM(c.saving_value), 0) AS DOUBLE) AS total,
  CAST(COALESCE(SUM(CASE WHEN c.l_returnflag = 'R' THEN c.saving_value END), 0) AS DOUBLE) AS cut
  FROM r JOIN {_BATCH} GROUP BY r.event_id, r.partner)"""


def _post_points(approved: str) -> list[str]:
    a, post = {"approved": f"'{approved}'"}, "claims/pipeline/filtered_post/saving_value"
    return [_point(f"{post}/total", "cut", "saved r", **a),
            _point(f"{post}/relative", "CASE WHEN total > 0 THEN cut / total ELSE 0 END",
                   "saved r", **a)]


def _agent_cte(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (SELECT r.event_id, r.partner, c.agent_id,
  CAST(COALESCE(SUM(c.saving_value), 0) AS DOUBLE) AS total, COUNT(*) AS n
  FROM r JOIN {_BATCH} WHERE {where} GROUP BY r.event_id, r.partner, c.agent_id)"""


_AGENT = "COALESCE(agent_id, 'None')"


def _agent_points(approved: str) -> list[str]:
    a = {"approved": f"'{approved}'", "agent_id": _AGENT}
    return [_point("claims/pipeline/savings/saving_value", "total", "agents r", **a),
            _point("claims/pipeline/savings/count", "n", "agents r", **a)]


_SELECTED_POINT = _point("claims/savings/approved/saving_value", "total", "chosen r",
                         agent_id=_AGENT, source="'selected_savings'")

# ---- submission --------------------------------------------------------------------

_SUBMISSION_CTES = [
    """submitted AS (SELECT item_id, partner, saving_value, ingested,
    CAST(year(ts) * 10 + quarter(ts) AS VARCHAR) AS run_id, sent_status
  FROM claims WHERE l_tax >= 0.04)""",
    """w AS (SELECT r.event_id, r.partner,
  COALESCE(MAX(s.ingested), MAX(r.as_of) - INTERVAL 20 MINUTE) AS hi,
  COALESCE(MAX(s.ingested), MAX(r.as_of) - INTERVAL 20 MINUTE) - INTERVAL 2 DAY AS lo
  FROM r LEFT JOIN submitted s ON s.partner = r.partner AND s.run_id =
    CAST((1995 + (r.dd % 26) // 4) * 10 + (r.dd % 26) % 4 + 1 AS VARCHAR)
  GROUP BY r.event_id, r.partner)""",
    """near AS (SELECT w.event_id, c.* FROM w JOIN claims c ON c.partner = w.partner
  AND c.ingested BETWEEN w.lo AND w.hi)""",
    """pending AS (SELECT DISTINCT event_id, invoice_id FROM near
  WHERE status = 'SENT_FOR_VALIDATION')""",
    """held AS (SELECT DISTINCT n.event_id, n.item_id FROM near n
  JOIN pending p ON p.event_id = n.event_id AND p.invoice_id = n.invoice_id)""",
    """sendable AS (SELECT i.* FROM (SELECT DISTINCT event_id, item_id, paid_value,
    reported_value, partner FROM near) i
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.event_id = i.event_id
    AND h.item_id = i.item_id))""",
    """received AS (SELECT event_id, SUM(paid_value) AS paid, SUM(reported_value) AS reported
  FROM sendable GROUP BY event_id)""",
    """sent AS (SELECT i.event_id, s.sent_status, SUM(paid_value) AS paid,
  SUM(reported_value) AS reported FROM sendable i
  JOIN submitted s ON s.item_id = i.item_id AND s.partner = i.partner
  GROUP BY i.event_id, s.sent_status)""",
    """received_rows AS (SELECT w.event_id, w.partner, a.sent_status, t.paid, t.reported,
  s.paid AS sent_paid, s.reported AS sent_reported
  FROM w JOIN (SELECT event_id, sent_status FROM sent UNION
    SELECT event_id, 'SUBMITTED_SUCCESS' FROM w) a ON a.event_id = w.event_id
  LEFT JOIN received t ON t.event_id = w.event_id
  LEFT JOIN sent s ON s.event_id = w.event_id AND s.sent_status = a.sent_status)""",
]
_KEPT = {
    "accepted": """SELECT event_id, item_id, partner, saving_value FROM near
    WHERE l_suppkey % 3 = 0
  UNION ALL SELECT n.event_id, n.item_id, n.partner, n.saving_value FROM near n
    WHERE n.status IN ('SUBMITTED_SUCCESS', 'APPROVED') AND NOT EXISTS (SELECT 1 FROM pending p
      WHERE p.event_id = n.event_id AND p.invoice_id = n.invoice_id)""",
    "analysed": """SELECT event_id, item_id, partner, saving_value FROM near
  WHERE status NOT IN ('SENT_FOR_VALIDATION', 'NOT_SENT_FOR_VALIDATION')
    AND (reason IS NULL OR reason <> 'SHARED_ID_FATURA')""",
    "shared": """SELECT event_id, item_id, partner, saving_value FROM near
  WHERE reason = 'SHARED_ID_FATURA' AND status <> 'SENT_FOR_VALIDATION'""",
}


def _kept_ctes(name: str) -> list[str]:
    return [
        f"{name} AS ({_KEPT[name]})",
        f"""{name}_sent AS (SELECT i.event_id, s.sent_status, SUM(s.saving_value) AS sent
  FROM (SELECT DISTINCT event_id, item_id, partner FROM {name}) i
  JOIN submitted s ON s.item_id = i.item_id AND s.partner = i.partner
  GROUP BY i.event_id, s.sent_status)""",
        f"""{name}_rows AS (SELECT w.event_id, w.partner, a.sent_status,
  CAST(COALESCE(t.total, 0) AS DOUBLE) AS total, CAST(COALESCE(s.sent, 0) AS DOUBLE) AS sent,
  MAX(COALESCE(s.sent, 0)) OVER (PARTITION BY w.event_id) AS peak,
  CAST((SELECT SUM(x.sent) FROM {name}_sent x WHERE x.event_id = w.event_id) AS DOUBLE) AS all_sent
  FROM w JOIN (SELECT event_id, sent_status FROM {name}_sent UNION
    SELECT event_id, 'SUBMITTED_SUCCESS' FROM w) a ON a.event_id = w.event_id
  LEFT JOIN (SELECT event_id, SUM(saving_value) AS total FROM {name} GROUP BY event_id) t
    ON t.event_id = w.event_id
  LEFT JOIN {name}_sent s ON s.event_id = w.event_id AND s.sent_status = a.sent_status)""",
    ]


_STATUS = "COALESCE(sent_status, 'None')"


def _kept_point(name: str, metric: str) -> str:
    idle = "total = 0 AND peak <= 0"
    return _point(
        f"claims/pipeline/savings/saving_value/{metric}_last_2_days",
        f"CASE WHEN {idle} THEN 1 WHEN total > 0 THEN sent / total ELSE 0 END",
        f"{name}_rows r WHERE NOT ({idle}) OR sent_status = 'SUBMITTED_SUCCESS'",
        status=_STATUS)


def _received_point(value: str, column: str) -> str:
    return _point(
        f"claims/pipeline/claims/{value}/sent_over_recv_last_2_days",
        f"CASE WHEN COALESCE({column}, 0) = 0 THEN 1 ELSE "
        f"COALESCE(CAST(sent_{column} AS DOUBLE) / CAST({column} AS DOUBLE), 0) END",
        "received_rows r", status=_STATUS)


_EXPIRED = """lost AS (SELECT r.event_id, r.partner, COALESCE(SUM(c.saving_value), 0) AS total
  FROM r LEFT JOIN claims c ON c.partner = r.partner AND c.status = 'EXPIRED'
    AND c.ingested BETWEEN r.as_of - INTERVAL 2 DAY AND r.as_of
    AND c.updated BETWEEN r.as_of - INTERVAL 30 MINUTE AND r.as_of
  GROUP BY r.event_id, r.partner)"""


def _claims_pipeline(which: int, approved: str) -> tuple[list[str], list[str]]:
    ctes = [PAID, ITEMS, WHOLE, *_entity_ctes("provider_id"), *_entity_ctes("member_id")]
    points = [*_paid_points(approved), *_entity_points("provider", "providers"),
              *_entity_points("member", "beneficiaries")]
    return ctes, points


# ---- missing and empty tables --------------------------------------------------------

# tables of a batch by day of the month modulo seven: first missing, then empty
_GAP = {"unprocessable": (0, 4), "processable": (1, 5), "excluded": (2, 6), "savings": (3, 0),
        "selected": (4, 1)}


def _filled(role: str) -> str:
    return "m NOT IN ({}, {})".format(*_GAP[role])


def _there(role: str) -> str:
    return f"m <> {_GAP[role][0]}"


_GAP_ROWS = f"""gap_rows AS (SELECT r.event_id, c.item_id, c.provider_id, c.member_id, c.paid_value,
    c.processable
  FROM r JOIN {_BATCH} WHERE r.which IN (0, 1)
    AND CASE WHEN c.processable THEN {_filled("processable")} ELSE {_filled("unprocessable")} END)"""
_GAP_PAID = f"""gap_paid AS (SELECT r.event_id, r.partner, r.m, {_APPROVED} AS approved,
  CAST(COALESCE(SUM(CASE WHEN c.processable THEN c.paid_value END), 0) AS DOUBLE) AS done,
  CAST(COALESCE(SUM(CASE WHEN NOT c.processable THEN c.paid_value END), 0) AS DOUBLE) AS held
  FROM r LEFT JOIN gap_rows c ON c.event_id = r.event_id WHERE r.which IN (0, 1)
  GROUP BY r.event_id, r.partner, r.m, r.which)"""
_GAP_WHOLE = f"""whole AS (SELECT event_id, partner, {_APPROVED} AS approved,
    partner NOT IN ('AFRICA', 'ASIA') AS has_history
  FROM r WHERE which IN (0, 1) AND {_there("processable")} AND {_there("unprocessable")})"""
_GAP_ITEMS = "items AS (SELECT DISTINCT event_id, item_id FROM gap_rows)"
_GAP_SAVED = f"""gap_saved AS (SELECT r.event_id, r.partner, {_APPROVED} AS approved,
  CAST(COALESCE(SUM(CASE WHEN {_filled("savings")} THEN c.saving_value END), 0) AS DOUBLE) AS total,
  CAST(COALESCE(SUM(CASE WHEN {_filled("excluded")} AND c.l_returnflag = 'R'
    THEN c.saving_value END), 0) AS DOUBLE) AS cut
  FROM r LEFT JOIN {_BATCH} WHERE r.which IN (0, 2) AND {_there("savings")}
  GROUP BY r.event_id, r.partner, r.which)"""


def _gap_agents(name: str, where: str) -> str:
    return f"""{name} AS (SELECT r.event_id, r.partner, {_APPROVED} AS approved, c.agent_id,
  CAST(COALESCE(SUM(c.saving_value), 0) AS DOUBLE) AS total, COUNT(*) AS n
  FROM r JOIN {_BATCH} WHERE {where} GROUP BY r.event_id, r.partner, r.which, c.agent_id)"""


_GAP_LOST = """gap_lost AS (SELECT r.event_id, r.partner, COALESCE(SUM(c.saving_value), 0) AS total
  FROM r LEFT JOIN claims c ON c.partner = r.partner AND c.status = 'EXPIRED'
    AND (c.processable OR c.partner <> 'EUROPE')
    AND c.ingested BETWEEN r.as_of - INTERVAL 2 DAY AND r.as_of
    AND c.updated BETWEEN r.as_of - INTERVAL 30 MINUTE AND r.as_of
  WHERE r.which = 5 AND r.partner <> 'ASIA' GROUP BY r.event_id, r.partner)"""


def _gap_points() -> str:
    a, both = {"approved": "r.approved"}, "r.done + r.held > 0"
    pre, ok = "claims/pipeline/filtered_pre/paid_value", "claims/pipeline/processable/paid_value"
    post = "claims/pipeline/filtered_post/saving_value"
    agent = {**a, "agent_id": _AGENT}
    known = "r.partner NOT IN ('AFRICA', 'ASIA', 'EUROPE')"
    batch = "r JOIN gap_rows c ON c.event_id = r.event_id"
    return _all((0, 1, 2, 3, 5), [
        _GAP_ROWS, _GAP_PAID, _GAP_WHOLE, _GAP_ITEMS, *_entity_ctes("provider_id", batch, known),
        *_entity_ctes("member_id", batch, known), _GAP_SAVED, _GAP_LOST,
        _gap_agents("gap_agents", f"r.which IN (0, 3) AND {_filled('savings')}"),
        _gap_agents("chosen", f"r.which = 0 AND {_filled('selected')} AND c.l_suppkey % 3 = 0"),
    ], [
        _point(f"{pre}/total", "held", "gap_paid r", **a),
        _point(f"{pre}/relative", f"CASE WHEN {both} THEN held / (done + held) ELSE 0 END",
               f"gap_paid r WHERE {_there('processable')}", **a),
        _point(f"{ok}/total", "done", "gap_paid r", **a),
        _point(f"{ok}/relative", "done / (done + held)", f"gap_paid r WHERE {both}", **a),
        *_entity_points("provider", "providers"), *_entity_points("member", "beneficiaries"),
        _point(f"{post}/total", "cut", "gap_saved r", **a),
        _point(f"{post}/relative", "CASE WHEN total > 0 THEN cut / total ELSE 0 END", "gap_saved r", **a),
        _point("claims/pipeline/savings/saving_value", "total", "gap_agents r", **agent),
        _point("claims/pipeline/savings/count", "n", "gap_agents r", **agent),
        _SELECTED_POINT,
        _point("claims/pipeline/validation/saving_value/expired/total", "total", "gap_lost r"),
    ])


_GAP_OUTCOMES = "WITH " + RUNS + """,
judged AS (SELECT *, day(as_of) AS dd, CASE
    WHEN which IN (0, 1) AND day(as_of) % 7 = 1 THEN 'processable'
    WHEN which IN (0, 1) AND day(as_of) % 7 = 0 THEN 'unprocessable' END AS lost,
  which IN (0, 2) AND day(as_of) % 7 = 3 OR which = 4 AND partner <> 'EUROPE'
    OR which = 5 AND partner = 'ASIA' AS failed FROM runs)
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN lost IS NOT NULL THEN 'bad_request'
    WHEN failed THEN 'internal_error' ELSE 'ok' END AS outcome,
  CASE WHEN lost IS NOT NULL THEN 400 WHEN failed THEN 500 ELSE 204 END AS code,
  'table not found: ' || CASE WHEN dd % 2 = 0 THEN 'default.' ELSE 'tmp.' END || lost || '_' || partner
    || '_' || CAST(dd AS VARCHAR) AS reason
FROM judged"""


def _failed_family() -> str:
    """The approval points without those of members, and a failure for each of these."""
    ctes = [PAID, ITEMS, WHOLE, *_entity_ctes("provider_id"), SAVED, _agent_cte("agents"),
            _agent_cte("chosen", "c.l_suppkey % 3 = 0")]
    points = [*_paid_points("true"), *_entity_points("provider", "providers"), *_post_points("true"),
              *_agent_points("true"), _SELECTED_POINT]
    failed = [f"""SELECT event_id AS rep, 'handler_execution_failure' AS metric_name, CAST(1 AS DOUBLE)
  AS value, NULL AS partner, NULL AS approved, NULL AS agent_id, NULL AS status, NULL AS source,
  '{handler}/approval' AS handler_class FROM whole""" for handler in ("new_members", "member_ratio")]
    return _all(0, ctes, [f"SELECT *, NULL AS handler_class FROM ({p})" for p in points] + failed)


_approval_ctes, _approval_points = _claims_pipeline(0, "true")

ORACLES = {
    "decode_events": _with(f"""SELECT event_id, decoding,
      CASE WHEN {_VISIBLE} THEN pipeline_uuid END AS pipeline_uuid,
      CASE WHEN {_VISIBLE} THEN status END AS status,
      CASE WHEN {_VISIBLE} THEN partner END AS partner,
      CASE WHEN decoding = 'decoded' THEN as_of END AS as_of FROM e"""),
    "decode_quarantine": _with("SELECT event_id, decoding FROM e WHERE decoding <> 'decoded'"),
    "route_events": _with(
        "SELECT event_id, handler, metric, approved, error, tables FROM matched"),
    "event_outcomes": _with(f"""SELECT event_id, outcome, CASE
        WHEN outcome IN ('undecodable', 'bad_request') THEN 400
        WHEN outcome IN ('ok', 'unmatched') THEN 204 ELSE 500 END AS code,
        CASE WHEN outcome = 'bad_request' THEN 'missing or malformed: ' || CASE
          WHEN lacks_table AND lacking IS NOT NULL AND NOT (which = 5 AND no_partner)
          THEN lacking ELSE 'partner' END END AS reason
      FROM (SELECT e.*, {_LACKING} AS lacking, CASE WHEN decoding = 'undecodable' THEN 'undecodable'
        WHEN decoding = 'broken' THEN 'internal_error'
        WHEN no_payload THEN 'match_error'
        WHEN COALESCE(m.bad, 0) > 0 THEN 'bad_request'
        WHEN COALESCE(m.internal, 0) > 0 THEN 'internal_error'
        WHEN m.event_id IS NULL THEN 'unmatched' ELSE 'ok' END AS outcome
      FROM e LEFT JOIN (SELECT event_id,
          COUNT(CASE WHEN error = 'bad_request' THEN 1 END) AS bad,
          COUNT(CASE WHEN error = 'internal_error' THEN 1 END) AS internal
        FROM matched GROUP BY event_id) m ON m.event_id = e.event_id)"""),
    "failure_counts": _with("""SELECT stage, handler, error, COUNT(*) AS failures FROM failed
      GROUP BY stage, handler, error"""),
    "run_points": _with(f"""SELECT event_id, as_of, CAST(1 AS DOUBLE) AS value, pipeline_uuid,
      status AS pipeline_status, partner {_COUNTED}"""),
    "run_counts": _counts(),
    "run_counts_by_partner": _counts("partner"),
    "metric_log_json": _with(f"""SELECT event_id,
      '{{"metric_type":"gauge","project_id":"test","name":"pipeline_run/count","value":1.0,'
      || '"labels":{{"pipeline_uuid":"' || pipeline_uuid || '","pipeline_status":"' || status
      || '"' || COALESCE(',"partner":"' || partner || '"', '') || '}},"timestamp":"'
      || strftime(as_of, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(as_of) % 1000000 = 0
        THEN '' ELSE '.' || lpad(CAST(microsecond(as_of) % 1000000 AS VARCHAR), 6, '0') END
      || '+00:00"}}' AS line {_COUNTED}"""),
    "approval_points": _all(
        0, [*_approval_ctes, SAVED, _agent_cte("agents"),
            _agent_cte("chosen", "c.l_suppkey % 3 = 0")],
        [*_approval_points, *_post_points("true"), *_agent_points("true"), _SELECTED_POINT]),
    "wrangling_points": _all(1, *_claims_pipeline(1, "false")),
    "selection_points": _all(2, [SAVED], _post_points("false")),
    "evaluation_points": _all(3, [_agent_cte("agents")], _agent_points("false")),
    "submission_points": _all(
        4, [*_SUBMISSION_CTES, *[cte for name in _KEPT for cte in _kept_ctes(name)]],
        [_received_point("paid_value", "paid"), _received_point("reported_value", "reported"),
         _kept_point("accepted", "sent_over_accepted"),
         _kept_point("analysed", "sent_over_validation"),
         _point("claims/pipeline/savings/saving_value/shared_invoice_sent_over_validation",
                "CASE WHEN total > 0 THEN COALESCE(all_sent, 0) / total ELSE 1 END",
                "shared_rows r WHERE sent_status = 'SUBMITTED_SUCCESS'")]),
    "release_points": _all(5, [_EXPIRED], [
        _point("claims/pipeline/validation/saving_value/expired/total", "total", "lost r")]),
    "table_policy_points": _gap_points(),
    "table_policy_outcomes": _GAP_OUTCOMES,
    "failed_family_points": _failed_family(),
    "failure_points": _with("""SELECT event_id, CASE stage WHEN 'match' THEN 'handler_matcher_failure'
        ELSE 'handler_execution_failure' END AS metric_name, CAST(1 AS DOUBLE) AS value,
      handler AS handler_class FROM failed"""),
    "stream_run_counts": _counts(),
    "stream_dedup": """SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT event_id) AS ids,
        COUNT(DISTINCT event_id % 3) AS batches
      FROM events GROUP BY event_type""",
}
ORACLES["stream_savings"] = ORACLES["evaluation_points"]
_PIPELINES = ("approval", "wrangling", "selection", "evaluation", "submission", "release")
ORACLES["event_mix_points"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({ORACLES[f'{name}_points']})" for name in _PIPELINES)
