"""ANSI SQL giving the answers of ``claim_queries`` on the same tables.

Written for reading, not speed: runs meet rows by plain joins and every count is a
``COUNT(DISTINCT ...)``.
"""

from __future__ import annotations

from claimgauge.sources.standin import AS_OF, BATCH_DAYS, LOOKBACK_DAYS, RUN_ID

_T = f"TIMESTAMP '{AS_OF}'"
_DAYS = f"INTERVAL {LOOKBACK_DAYS} DAY"

CLAIMS = """claims AS (
  SELECT CASE WHEN (l_orderkey * 10 + l_linenumber) % 97 <> 0 THEN l_orderkey * 10 + l_linenumber END
      AS item_id,
    CASE WHEN l_orderkey % 89 <> 0 THEN l_orderkey END AS invoice_id,
    CASE WHEN l_partkey % 83 <> 0 THEN l_partkey END AS provider_id,
    CASE WHEN o_custkey % 79 <> 0 THEN o_custkey END AS member_id, r_name AS partner,
    CASE WHEN l_partkey % 71 <> 0 THEN p_brand END AS agent_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS paid_value,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))
      AS DECIMAL(18,4)) AS reported_value,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))
      AS DECIMAL(18,4)) AS saving_value,
    l_shipdate AS ts, l_shipdate + ((l_orderkey % 5 - 3) * 6) * INTERVAL 1 HOUR AS ingested,
    l_shipdate + (l_suppkey % 2 * 10) * INTERVAL 1 HOUR + (l_partkey % 60) * INTERVAL 1 MINUTE AS updated,
    l_linestatus = 'F' AS processable, l_returnflag, l_suppkey, l_tax,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'SUBMITTED_SUCCESS'
      WHEN o_orderstatus = 'O' THEN 'SUBMITTED_ERROR' ELSE 'RETRY' END AS sent_status,
    CASE l_linenumber WHEN 1 THEN 'SENT_FOR_VALIDATION' WHEN 2 THEN 'NOT_SENT_FOR_VALIDATION'
      WHEN 3 THEN 'APPROVED' WHEN 4 THEN 'SUBMITTED_SUCCESS' WHEN 5 THEN 'EXPIRED'
      WHEN 6 THEN 'DENIED' ELSE CASE WHEN l_suppkey % 4 <> 0 THEN 'EXCLUDED' END END AS status,
    CASE l_returnflag WHEN 'R' THEN 'SHARED_ID_FATURA' WHEN 'N' THEN 'OTHER' END AS reason
  FROM lineitem
  JOIN part ON p_partkey = l_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""

SUBMITTED = """submitted AS (
  SELECT item_id, partner, saving_value, ingested,
    CAST(year(ts) * 10 + quarter(ts) AS VARCHAR) AS submission_run_id, sent_status AS status
  FROM claims WHERE l_tax >= 0.04
)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([CLAIMS, *ctes]) + "\n" + select


# ---- shares ----------------------------------------------------------------------

def _share(value: str, part: str, rest: str, relative: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    sums = f"""sums AS (
      SELECT {by + ',' if by else ''}
        CAST(COALESCE(SUM(CASE WHEN {part} THEN {value} END), 0) AS DOUBLE) AS p,
        CAST(COALESCE(SUM(CASE WHEN {rest} THEN {value} END), 0) AS DOUBLE) AS r
      FROM claims {group})"""
    return _with(sums, select=f"""SELECT {by + ',' if by else ''}
      p AS total, CAST({relative} AS DOUBLE) AS relative FROM sums""")


_OF_SUM = "CASE WHEN p + r > 0 THEN p / (p + r) ELSE 0 END"
_IF_POSITIVE = "CASE WHEN p + r > 0 THEN p / (p + r) END"
_OF_REST = "CASE WHEN r > 0 THEN p / r ELSE 0 END"


def _agents(columns: str, where: str = "", by: str = "") -> str:
    by = by + ", " if by else ""
    return _with(select=f"""SELECT {by}agent_id,
      CAST(COALESCE(SUM(saving_value), 0) AS DOUBLE) AS total_saving{columns}
      FROM claims {where} GROUP BY {by}agent_id""")


# ---- entities --------------------------------------------------------------------

_SINGLE = f"runs AS (SELECT 1 AS run, {_T} AS as_of)"
_SINGLE_BATCH = f"""batch AS (SELECT 1 AS run, c.* FROM claims c
  WHERE ts > {_T} - INTERVAL {BATCH_DAYS} DAY AND ts <= {_T})"""
_SINGLE_HISTORY = "history AS (SELECT 1 AS hist, c.* FROM claims c)"
_PARTNER = f"runs AS (SELECT r_name AS partner, {_T} AS as_of FROM region)"
_PARTNER_BATCH = f"""batch AS (SELECT * FROM claims
  WHERE ts > {_T} - INTERVAL {BATCH_DAYS} DAY AND ts <= {_T})"""
_MONTHLY = """runs AS (
  SELECT DISTINCT r_name AS partner, strftime(o_orderdate, '%Y-%m') AS run_id,
    CAST(strftime(o_orderdate, '%Y-%m') || '-15 10:30:00' AS TIMESTAMP) AS as_of
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""
_MONTHLY_BATCH = """batch AS (SELECT *, strftime(ts, '%Y-%m') AS run_id FROM claims
  WHERE day(ts) BETWEEN 9 AND 15)"""
_HISTORY = "history AS (SELECT * FROM claims)"

# name -> (runs, batch, history, run keys, history key)
_FORMS = {
    "": (_SINGLE, _SINGLE_BATCH, _SINGLE_HISTORY, ["run"], ("run", "hist")),
    "_by_partner": (_PARTNER, _PARTNER_BATCH, _HISTORY, ["partner"], ("partner", "partner")),
    "_by_run": (_MONTHLY, _MONTHLY_BATCH, _HISTORY, ["partner", "run_id"],
                ("partner", "partner")),
}


def _same(keys: list[str], left: str, right: str) -> str:
    return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys)


def _new_pct(entity: str, form: str) -> str:
    runs, batch, history, keys, (run_h, hist_h) = _FORMS[form]
    listed = ", ".join(keys)
    on_b = _same(keys, "b", "r")
    shown = "" if form == "" else ", ".join(f"r.{k}" for k in keys) + ","
    group = ", ".join(f"r.{k}" for k in keys)
    return _with(runs, batch, history, f"""ids AS (SELECT DISTINCT {listed}, item_id FROM batch)""",
                 f"""ents AS (SELECT DISTINCT {listed}, {entity} AS entity FROM batch)""",
                 f"""known AS (SELECT DISTINCT {group}, h.{entity} AS entity
  FROM runs r JOIN history h ON r.{run_h} = h.{hist_h}
    AND h.ts >= CAST(r.as_of AS DATE) - INTERVAL 90 DAY
  WHERE NOT EXISTS (SELECT 1 FROM ids b WHERE {on_b} AND b.item_id = h.item_id))""",
                 select=f"""SELECT {shown}
  COUNT(DISTINCT e.entity) AS total_entities,
  COUNT(DISTINCT CASE WHEN k.entity IS NULL THEN e.entity END) AS new_entities,
  CASE WHEN COUNT(DISTINCT e.entity) > 0 THEN
    CAST(COUNT(DISTINCT CASE WHEN k.entity IS NULL THEN e.entity END) AS DOUBLE)
      / COUNT(DISTINCT e.entity) ELSE 0.0 END AS new_pct
FROM runs r LEFT JOIN ents e ON {_same(keys, 'r', 'e')}
LEFT JOIN known k ON {_same(keys, 'r', 'k')} AND k.entity = e.entity
GROUP BY {group}""")


def _volume(entity: str, form: str) -> str:
    runs, batch, history, keys, (run_h, hist_h) = _FORMS[form]
    listed = ", ".join(keys)
    on_run = _same(keys, "r", "l"), _same(keys, "r", "v")
    group = ", ".join(f"r.{k}" for k in keys)
    shown = "" if form == "" else group + ","
    joined = f"FROM runs r JOIN history h ON r.{run_h} = h.{hist_h} AND h.ts >="
    day = "CAST(r.as_of AS DATE)"
    return _with(runs, batch, history, f"""latest AS (
  SELECT {listed}, {entity} AS entity FROM batch
  UNION SELECT {group}, h.{entity} {joined} {day} - INTERVAL 30 DAY)""",
                 f"""previous AS (
  SELECT DISTINCT {group}, h.{entity} AS entity {joined} {day} - INTERVAL 60 DAY
    AND h.ts < {day} - INTERVAL 30 DAY)""",
                 f"""l AS (SELECT {listed}, COUNT(DISTINCT entity) AS n FROM latest
  GROUP BY {listed})""",
                 f"""v AS (SELECT {listed}, COUNT(DISTINCT entity) AS n FROM previous
  GROUP BY {listed})""",
                 select=f"""SELECT {shown} COALESCE(l.n, 0) AS latest_count,
  COALESCE(v.n, 0) AS previous_count,
  CASE WHEN COALESCE(v.n, 0) = 0 THEN 1.0
    ELSE CAST(COALESCE(l.n, 0) AS DOUBLE) / v.n END AS ratio
FROM runs r LEFT JOIN l ON {on_run[0]} LEFT JOIN v ON {on_run[1]}""")


# ---- submissions -----------------------------------------------------------------

_SUB_SINGLE = f"""runs AS (SELECT 1 AS one, '{RUN_ID}' AS submission_run_id, {_T} AS as_of)"""
_SUB_NONE = f"""runs AS (SELECT 1 AS one, 'none' AS submission_run_id, {_T} AS as_of)"""
_SUB_ALL = f"""runs AS (
  SELECT DISTINCT partner, submission_run_id, {_T} AS as_of FROM submitted
  UNION ALL SELECT r_name, 'none', {_T} FROM region)"""


class _Submission:
    """SQL pieces of the submission metrics for one run or for all."""

    def __init__(self, by_run: bool, runs: str | None = None):
        self.runs = runs or (_SUB_ALL if by_run else _SUB_SINGLE)
        self.keys = ["partner", "submission_run_id"] if by_run else ["one"]
        partner = "AND r.partner = {0}.partner" if by_run else ""
        self.same_table = lambda alias: partner.format(alias)
        self.listed = ", ".join(self.keys)
        self.shown = self.listed + "," if by_run else ""

    def w(self) -> list[str]:
        group = ", ".join(f"r.{k}" for k in self.keys)
        return [SUBMITTED, self.runs, f"""w AS (
  SELECT {group}, COALESCE(MAX(s.ingested), MAX(r.as_of) - INTERVAL 20 MINUTE) AS hi,
    COALESCE(MAX(s.ingested), MAX(r.as_of) - INTERVAL 20 MINUTE) - {_DAYS} AS lo
  FROM runs r LEFT JOIN submitted s ON s.submission_run_id = r.submission_run_id
    {self.same_table('s')} GROUP BY {group})"""]

    def rows(self, columns: str, where: str = "TRUE") -> str:
        keys = ", ".join(f"r.{k}" for k in self.keys)
        return f"""SELECT {keys}, {columns} FROM w r JOIN claims c
  ON c.ingested BETWEEN r.lo AND r.hi {self.same_table('c')} WHERE {where}"""

    def on(self, left: str, right: str) -> str:
        return _same(self.keys, left, right)

    def pending(self) -> str:
        rows = self.rows("c.invoice_id", "c.status = 'SENT_FOR_VALIDATION' AND c.invoice_id IS NOT NULL")
        return f"pending AS (SELECT DISTINCT * FROM ({rows}))"

    def held(self) -> str:
        return f"""held AS (SELECT DISTINCT {', '.join('v.' + k for k in self.keys)}, v.item_id
  FROM ({self.rows('c.item_id, c.invoice_id')}) v
  JOIN pending p ON {self.on('p', 'v')} AND p.invoice_id = v.invoice_id)"""

    def sendable(self) -> str:
        return f"""sendable AS (SELECT i.* FROM
  (SELECT DISTINCT * FROM ({self.rows('c.item_id, c.paid_value, c.reported_value')})) i
  WHERE NOT EXISTS (SELECT 1 FROM held x WHERE {self.on('x', 'i')} AND x.item_id = i.item_id))"""

    def statuses(self) -> str:
        return f"""statuses AS (SELECT {self.listed}, status FROM sent
  UNION SELECT {self.listed}, 'SUBMITTED_SUCCESS' FROM w)"""

    def window_only(self) -> str:
        return _with(*self.w(), select=f"SELECT {self.shown} lo, hi FROM w")

    def received(self) -> str:
        keys = ", ".join(f"r.{k}" for k in self.keys)
        return _with(
            *self.w(), self.pending(), self.held(), self.sendable(),
            f"""totals AS (SELECT {self.listed}, SUM(paid_value) AS paid,
  SUM(reported_value) AS reported FROM sendable GROUP BY {self.listed})""",
            f"""sent AS (SELECT {keys}, s.status, SUM(r.paid_value) AS paid,
  SUM(r.reported_value) AS reported
  FROM sendable r JOIN submitted s ON s.item_id = r.item_id {self.same_table('s')}
  GROUP BY {keys}, s.status)""", self.statuses(),
            select=f"""SELECT {', '.join('a.' + k for k in self.keys) + ',' if self.shown else ''}
  a.status,
  CASE WHEN COALESCE(t.paid, 0) = 0 THEN 1.0
    ELSE COALESCE(CAST(s.paid AS DOUBLE) / CAST(t.paid AS DOUBLE), 0) END AS paid_share,
  CASE WHEN COALESCE(t.reported, 0) = 0 THEN 1.0
    ELSE COALESCE(CAST(s.reported AS DOUBLE) / CAST(t.reported AS DOUBLE), 0)
    END AS reported_share
FROM statuses a LEFT JOIN sent s ON {self.on('s', 'a')} AND s.status = a.status
LEFT JOIN totals t ON {self.on('t', 'a')}""")

    def accepted(self) -> list[str]:
        chosen = self.rows("c.item_id, c.saving_value", "c.l_suppkey % 3 = 0")
        settled = self.rows("c.item_id, c.saving_value, c.invoice_id",
                            "c.status IN ('SUBMITTED_SUCCESS', 'APPROVED')")
        return [self.pending(), f"""kept AS ({chosen}
  UNION ALL SELECT {self.listed}, item_id, saving_value FROM ({settled}) v
  WHERE NOT EXISTS (SELECT 1 FROM pending p WHERE {self.on('p', 'v')}
    AND p.invoice_id = v.invoice_id))"""]

    def analysed(self) -> list[str]:
        rows = self.rows("c.item_id, c.saving_value", """c.status NOT IN
    ('SENT_FOR_VALIDATION', 'NOT_SENT_FOR_VALIDATION')
    AND (c.reason IS NULL OR c.reason <> 'SHARED_ID_FATURA')""")
        return [f"kept AS ({rows})"]

    def shared(self) -> list[str]:
        rows = self.rows("c.item_id, c.saving_value", """c.reason = 'SHARED_ID_FATURA'
    AND c.status <> 'SENT_FOR_VALIDATION'""")
        return [f"kept AS ({rows})"]

    def over(self, kept: list[str]) -> str:
        keys = ", ".join(f"r.{k}" for k in self.keys)
        shown = ", ".join("a." + k for k in self.keys) + "," if self.shown else ""
        return _with(
            *self.w(), *kept,
            f"""totals AS (SELECT {self.listed}, SUM(saving_value) AS total FROM kept
  GROUP BY {self.listed})""",
            f"""sent AS (SELECT {keys}, s.status, SUM(s.saving_value) AS sent
  FROM (SELECT DISTINCT {self.listed}, item_id FROM kept) r
  JOIN submitted s ON s.item_id = r.item_id {self.same_table('s')} GROUP BY {keys}, s.status)""",
            self.statuses(),
            f"""shares AS (SELECT {shown} a.status,
  CAST(COALESCE(t.total, 0) AS DOUBLE) AS total, CAST(COALESCE(s.sent, 0) AS DOUBLE) AS sent,
  MAX(COALESCE(s.sent, 0)) OVER (PARTITION BY {', '.join('a.' + k for k in self.keys)}) AS peak
FROM statuses a LEFT JOIN sent s ON {self.on('s', 'a')} AND s.status = a.status
LEFT JOIN totals t ON {self.on('t', 'a')})""",
            select=f"""SELECT {self.shown} status,
  CASE WHEN total = 0 AND peak <= 0 THEN 1.0 WHEN total > 0 THEN sent / total ELSE 0.0 END AS share
FROM shares WHERE NOT (total = 0 AND peak <= 0) OR status = 'SUBMITTED_SUCCESS'""")

    def completeness(self) -> str:
        keys = ", ".join(f"r.{k}" for k in self.keys)
        shown = ", ".join("a." + k for k in self.keys) + "," if self.shown else ""
        return _with(
            *self.w(), *self.shared(),
            f"""totals AS (SELECT {self.listed}, SUM(saving_value) AS total FROM kept
  GROUP BY {self.listed})""",
            f"""sent AS (SELECT {keys}, SUM(s.saving_value) AS sent
  FROM (SELECT DISTINCT {self.listed}, item_id FROM kept) r
  JOIN submitted s ON s.item_id = r.item_id {self.same_table('s')} GROUP BY {keys})""",
            select=f"""SELECT {shown} CASE WHEN COALESCE(t.total, 0) > 0 THEN
  CAST(COALESCE(s.sent, 0) AS DOUBLE) / CAST(t.total AS DOUBLE) ELSE 1.0 END AS share
FROM w a LEFT JOIN totals t ON {self.on('t', 'a')} LEFT JOIN sent s ON {self.on('s', 'a')}""")


_ONE, _ALL = _Submission(False), _Submission(True)


def _expired(runs: str, keys: list[str]) -> str:
    on = "AND r.partner = c.partner" if "partner" in keys else ""
    group = ", ".join(f"r.{k}" for k in keys)
    shown = group + "," if keys != ["run"] else ""
    return _with(runs, select=f"""SELECT {shown}
  CAST(COALESCE(SUM(c.saving_value), 0) AS DOUBLE) AS expired_saving
FROM runs r LEFT JOIN claims c ON c.status = 'EXPIRED' {on}
  AND c.ingested BETWEEN r.as_of - {_DAYS} AND r.as_of
  AND c.updated BETWEEN r.as_of - INTERVAL 30 MINUTE AND r.as_of
GROUP BY {group}""")


ORACLES = {
    "prefiltered_share": _share("paid_value", "NOT processable", "processable", _OF_SUM),
    "prefiltered_share_by_partner": _share(
        "paid_value", "NOT processable", "processable", _OF_SUM, "partner"),
    "processable_share": _share("paid_value", "processable", "NOT processable", _IF_POSITIVE),
    "processable_share_by_partner": _share(
        "paid_value", "processable", "NOT processable", _IF_POSITIVE, "partner"),
    "postfiltered_share": _share("saving_value", "l_returnflag = 'R'", "TRUE", _OF_REST),
    "postfiltered_share_by_partner": _share(
        "saving_value", "l_returnflag = 'R'", "TRUE", _OF_REST, "partner"),
    "share_missing_rest": _share("paid_value", "NOT processable", "FALSE", "NULL"),
    "share_missing_part": _share("paid_value", "FALSE", "processable", _OF_SUM),
    "savings_by_agent": _agents(", COUNT(*) AS row_count"),
    "savings_by_agent_by_partner": _agents(", COUNT(*) AS row_count", by="partner"),
    "selected_savings_by_agent": _agents("", "WHERE l_suppkey % 3 = 0"),
    "selected_savings_by_agent_by_partner": _agents("", "WHERE l_suppkey % 3 = 0", "partner"),
    "submission_window": _ONE.window_only(),
    "submission_window_fallback": _Submission(False, _SUB_NONE).window_only(),
    "submission_windows_by_run": _ALL.window_only(),
    "pending_invoices": _with(*_ONE.w(), _ONE.pending(), select="SELECT invoice_id FROM pending"),
    "non_sendable_items": _with(*_ONE.w(), _ONE.pending(), _ONE.held(),
                                select="SELECT item_id FROM held"),
    "sendable_items": _with(*_ONE.w(), _ONE.pending(), _ONE.held(), _ONE.sendable(), select="""
SELECT item_id, CAST(SUM(paid_value) AS DOUBLE) AS paid_value,
  CAST(SUM(reported_value) AS DOUBLE) AS reported_value FROM sendable GROUP BY item_id"""),
    "sent_over_received": _ONE.received(),
    "sent_over_received_by_run": _ALL.received(),
    "sent_over_accepted": _ONE.over(_ONE.accepted()),
    "sent_over_accepted_by_run": _ALL.over(_ALL.accepted()),
    "sent_over_validation": _ONE.over(_ONE.analysed()),
    "sent_over_validation_by_run": _ALL.over(_ALL.analysed()),
    "shared_invoice_completeness": _ONE.completeness(),
    "shared_invoice_completeness_by_run": _ALL.completeness(),
    "expired_validation_total": _expired(_SINGLE, ["run"]),
    "expired_validation_total_by_partner": _expired(_PARTNER, ["partner"]),
    "expired_validation_total_by_run": _expired(_MONTHLY, ["partner", "run_id"]),
}
for _form in _FORMS:
    for _name, _column in (("provider", "provider_id"), ("member", "member_id")):
        ORACLES[f"new_{_name}_pct{_form}"] = _new_pct(_column, _form)
        ORACLES[f"{_name}_volume_ratio{_form}"] = _volume(_column, _form)
