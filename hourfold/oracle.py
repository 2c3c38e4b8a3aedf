"""The same results as plain DuckDB SQL, written from the definitions and not from the operators."""

from __future__ import annotations

import re

from .testbed import from_events as ev, from_orders as od


def _values(rows, columns: str) -> str:
    def one(v):
        if v is None:
            return "NULL"
        return str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"'{v}'"

    body = ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


_place = {p[0]: p for p in ev.PLACES}
_TYPE = "CASE event_type WHEN 'click' THEN 22 WHEN 'view' THEN 23 WHEN 'purchase' THEN 97 WHEN 'signup' THEN 98 ELSE 39 END"
_MONEY = "DECIMAL(28,2)"
_SOURCE = "LinkServerName, DBName, MonthDB, TableName, Type"
_HOURS = "bit_or(CAST(1 AS BIGINT) << hour(DatePlayed)) AS hours"

CTES: dict[str, str] = {
    # Fixed rows.
    "places": _values(ev.PLACES, "Type, event_type, LinkServerName, DBName, monthly, TableName"),
    "listed_games": _values(
        [(_place[t][2], g, _place[t][3], _place[t][4], _place[t][5], t) for t, games in ev.LISTED for g in games],
        "LinkServerName, GameTypeSourceId, DBName, monthly, TableName, Type",
    ),
    "event_months": """
        SELECT date_trunc('month', min(ts)) - INTERVAL 1 MONTH AS before,
               unnest(generate_series(date_trunc('month', min(ts)), max(ts), INTERVAL 1 MONTH)) AS month FROM events""",
    "lookup": f"""
        SELECT LinkServerName, GameTypeSourceId, DBName, strftime(m.month, '%y%m') AS MonthDB, TableName, Type
        FROM listed_games g CROSS JOIN event_months m WHERE g.monthly
        UNION ALL
        SELECT LinkServerName, GameTypeSourceId, DBName, NULL, TableName, Type FROM listed_games WHERE NOT monthly
        UNION ALL
        SELECT DISTINCT LinkServerName, GameTypeSourceId, DBName, strftime(m.before, '%y%m'), TableName, Type
        FROM listed_games g CROSS JOIN event_months m WHERE g.Type = {ev.BEFORE[0]} AND g.GameTypeSourceId = {ev.BEFORE[1]}""",
    "tz": _values(ev.ZONES, "Type, Timezone"),
    "declared_rows": _values(ev.DECLARED, "Type, Timezone"),
    "games_lookup": _values(ev.CATEGORIES, "RawDataType, GameHallName, Category"),
    "servers": _values(ev.SERVERS, "Server, LinkServerName, GroupRouted"),
    "sites": _values([(s, {6: "Noah1", 7: "Noah2"}.get(s)) for s in range(8)], "Siteid, SiteType"),
    "targets": _values([(t,) for t in ev.TARGETS], "Type"),
    "dests": _values([("DS_Server", False), ("Noah1_Server", True), ("Noah2_Server", True)],
                     "Destination, narrow"),
    # Events as wagers.
    "typed": f"SELECT *, {_TYPE} AS Type, date_trunc('hour', ts) AS h FROM events",
    "wagers": """
        SELECT p.LinkServerName, p.DBName, CASE WHEN p.monthly THEN strftime(t.ts, '%y%m') END AS MonthDB,
               p.TableName, t.Type, t.ts AS wagerstime,
               concat(CASE WHEN event_id % 2 = 0 THEN 'User' ELSE 'USER' END, CAST(user_id AS VARCHAR)) AS GameAccount,
               CAST(user_id % 8 AS INT) AS SiteId,
               CAST(t.Type * 10 + event_id % 4 AS INT) AS GameTypeSourceId,
               CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(value AS DECIMAL(18,2)) END AS betamount,
               CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(18,2))
                    ELSE CAST(-value AS DECIMAL(18,2)) END AS PayOff
        FROM typed t JOIN places p ON p.Type = t.Type""",
    "hours": """
        SELECT unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM typed""",
    # Batches in which any timezone's events are read: events of hour h belong to batch h + 1 - Timezone.
    "batches": """
        SELECT unnest(generate_series(
                 min(h) + to_hours(CAST((SELECT 1 - max(Timezone) FROM tz) AS INT)),
                 max(h) + to_hours(CAST((SELECT 1 - min(Timezone) FROM tz) AS INT)), INTERVAL 1 HOUR)) AS h
        FROM typed""",
}


def _manifest(lookup: str, batches: str, zones: str) -> str:
    return f"""
        SELECT h AS batch_utc, s.*, z.Timezone, h + to_hours(CAST(z.Timezone - 1 AS INT)) AS start_t,
               h + to_hours(CAST(z.Timezone AS INT)) AS end_t, h + INTERVAL 8 HOUR AS DatePlayed
        FROM (SELECT DISTINCT {_SOURCE} FROM {lookup}) s CROSS JOIN {batches} LEFT JOIN {zones} z ON z.Type = s.Type
        WHERE MonthDB IS NULL
           OR MonthDB = strftime(h + to_hours(CAST(coalesce(z.Timezone, 8) - 1 AS INT)), '%y%m')"""


CTES["manifest"] = _manifest("lookup", "batches", "tz")


def _rollup(manifest: str, wagers: str = "wagers") -> str:
    return f"""
        SELECT m.DatePlayed, m.LinkServerName, m.DBName, m.Type, lower(w.GameAccount) AS GameAccount, w.SiteId,
               w.GameTypeSourceId, CAST(sum(w.betamount) AS {_MONEY}) AS Commissionable,
               count(*) AS WagersCount, CAST(coalesce(sum(w.PayOff), 0) AS {_MONEY}) AS PayOff,
               CAST(sum(CASE WHEN coalesce(w.PayOff, 0) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS WinsCount
        FROM {wagers} w JOIN {manifest} m
          ON m.LinkServerName = w.LinkServerName AND m.DBName = w.DBName AND m.TableName = w.TableName
         AND m.Type = w.Type AND m.MonthDB IS NOT DISTINCT FROM w.MonthDB
         AND w.wagerstime >= m.start_t AND w.wagerstime < m.end_t
        WHERE w.DBName <> '_DbShared' OR EXISTS (
              SELECT 1 FROM lookup l WHERE l.LinkServerName = w.LinkServerName AND l.Type = w.Type
                 AND l.GameTypeSourceId = w.GameTypeSourceId)
        GROUP BY m.DatePlayed, m.LinkServerName, m.DBName, m.TableName, m.Type, lower(w.GameAccount),
                 w.SiteId, w.GameTypeSourceId
        HAVING sum(w.betamount) > 0"""


def _route(rollup: str) -> str:
    narrow = " UNION ALL ".join(
        f"""SELECT r.*, v.Server, '{dest}' FROM {rollup} r JOIN servers v
              ON v.LinkServerName = r.LinkServerName
            WHERE v.GroupRouted AND r.SiteId IN (SELECT Siteid FROM sites WHERE SiteType = '{group}')"""
        for group, dest in (("Noah1", "Noah1_Server"), ("Noah2", "Noah2_Server"))
    )
    return f"""SELECT r.*, v.Server, 'DS_Server' AS Destination FROM {rollup} r JOIN servers v
                 ON v.LinkServerName = r.LinkServerName UNION ALL {narrow}"""


def _infer(obs: str) -> str:
    return f"""
        SELECT Type, avg(d) AS diff_min, CASE WHEN bool_or(moved) THEN count(d) END AS n,
               var_samp(d) AS variance, avg(d) - 60 * floor(avg(d) / 60) AS sth_left,
               CAST(-floor(avg(d) / 60) AS INT) AS timezone
        FROM (SELECT Type, moved, CASE WHEN moved THEN diff_min END AS d FROM (
                SELECT *, rn > 1 AND (table_max IS NULL OR before IS NULL OR table_max <> before) AS moved
                FROM (SELECT *, row_number() OVER o AS rn, lag(table_max) OVER o AS before FROM {obs}
                      WINDOW o AS (PARTITION BY Type ORDER BY Batch_time, Server, table_max))))
        GROUP BY Type"""


def _choose(inferred: str) -> str:
    return f"""
        SELECT i.Type, CAST(CASE WHEN c.Category IS DISTINCT FROM '機率' OR i.timezone IS NULL
                                 THEN d.Timezone ELSE i.timezone END AS INT) AS Timezone
        FROM {inferred} i
        LEFT JOIN (SELECT DISTINCT Type, Timezone FROM declared_rows
                   WHERE Type IN (SELECT Type FROM lookup)) d ON d.Type = i.Type
        LEFT JOIN (SELECT DISTINCT RawDataType, Category FROM games_lookup) c ON c.RawDataType = i.Type"""


_first = ", ".join(f"'{s}'" for s in ev.FIRST_PATH)
_second = ", ".join(f"'{s}'" for s in ev.SECOND_PATH)

CTES |= {
    "rollup": _rollup("manifest"),
    "routed": _route("rollup"),
    # Observations and lag.
    "obs": """
        SELECT g.h + INTERVAL 1 HOUR AS Batch_time, g.Server, g.Type, g.reading AS table_max,
               g.h + INTERVAL 1 HOUR AS utc0,
               CAST(date_diff('minute', g.reading, g.h + INTERVAL 1 HOUR) AS BIGINT) AS diff_min
        FROM (SELECT hours.h, v.Server, p.Type,
                     max(n.newest) OVER (PARTITION BY p.Type ORDER BY hours.h)
                       + to_hours(CAST(coalesce(z.Timezone, 0) AS INT)) AS reading
              FROM hours CROSS JOIN places p JOIN servers v ON v.LinkServerName = p.LinkServerName
              LEFT JOIN tz z ON z.Type = p.Type
              LEFT JOIN (SELECT Type, h, max(ts) AS newest FROM typed GROUP BY Type, h) n
                ON n.Type = p.Type AND n.h = hours.h) g""",
    "obs_both": """
        SELECT * FROM obs UNION ALL
        SELECT Batch_time, '20' AS Server, Type, table_max, utc0, diff_min FROM obs WHERE Type = 22""",
    "lag_rows": """
        SELECT t.utc + INTERVAL 8 HOUR AS DatePlayed, s.LinkServerName, s.Type, s.Category,
               CASE WHEN g.Type IS NULL THEN 'Success' WHEN o.table_max >= o.due THEN 'Success'
                    WHEN o.table_max < o.due THEN 'Wait' ELSE 'TBD' END AS Status,
               CASE WHEN g.Type IS NOT NULL THEN o.table_max END AS Table_max,
               CASE WHEN g.Type IS NOT NULL THEN o.due END AS Run_threshold
        FROM (SELECT DISTINCT l.Type, l.LinkServerName, c.Category FROM lookup l
              LEFT JOIN games_lookup c ON c.RawDataType = l.Type) s
        CROSS JOIN (SELECT h + INTERVAL 1 HOUR AS utc FROM hours) t
        LEFT JOIN targets g ON g.Type = s.Type
        LEFT JOIN (SELECT b.Type, b.Batch_time, b.table_max,
                          b.Batch_time + to_minutes(CAST(z.Timezone * 60 - 10 AS INT)) AS due
                   FROM obs b LEFT JOIN tz z ON z.Type = b.Type) o
          ON o.Type = s.Type AND o.Batch_time = t.utc""",
    "rechecked": """
        SELECT l.DatePlayed, l.LinkServerName, l.Type, l.Category,
               CASE WHEN l.Status = 'Wait' AND o.reading >= l.Run_threshold THEN 'ReRun' ELSE l.Status END AS Status,
               CASE WHEN l.Status = 'Wait' THEN o.reading ELSE l.Table_max END AS Table_max, l.Run_threshold
        FROM lag_rows l
        LEFT JOIN (SELECT Type, date_trunc('millisecond', table_max) AS reading
                   FROM (SELECT *, row_number() OVER (PARTITION BY Type ORDER BY Batch_time DESC) AS rn FROM obs)
                   WHERE rn = 1) o ON o.Type = l.Type""",
    "ledger": """
        SELECT v.Server, l.Type, d.Destination,
               CASE WHEN l.Status = 'Wait' THEN 'Fail' ELSE 'Success' END AS Status,
               CASE WHEN l.Status = 'Wait' THEN NULL ELSE CAST(1.5 AS DOUBLE) END AS Exe_Time_sec,
               l.DatePlayed AS UpDateTime
        FROM lag_rows l JOIN servers v ON v.LinkServerName = l.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow""",
    "candidates": """
        SELECT s.* FROM ledger s WHERE s.Status = 'Fail' AND EXISTS (
          SELECT 1 FROM servers v JOIN rechecked l ON l.LinkServerName = v.LinkServerName
          WHERE v.Server = s.Server AND l.Type = s.Type AND l.DatePlayed = s.UpDateTime
            AND l.Status IN ('Success', 'ReRun'))""",
    "redo_manifest": """
        SELECT DISTINCT m.* FROM manifest m JOIN servers v ON v.LinkServerName = m.LinkServerName
        JOIN candidates c ON c.Server = v.Server AND c.Type = m.Type AND c.UpDateTime = m.DatePlayed""",
    "redo_late": """
        SELECT p.LinkServerName, p.DBName, CASE WHEN p.monthly THEN strftime(b.u + to_hours(CAST(z.Timezone - 1 AS INT)), '%y%m') END AS MonthDB,
               p.TableName, p.Type, b.u + to_hours(CAST(z.Timezone - 1 AS INT)) AS start_t,
               b.u + to_hours(CAST(z.Timezone AS INT)) AS end_t, b.u + INTERVAL 8 HOUR AS DatePlayed
        FROM (SELECT DISTINCT Type, UpDateTime - INTERVAL 8 HOUR AS u FROM candidates) b
        JOIN places p ON p.Type = b.Type JOIN tz z ON z.Type = b.Type""",
    "redo_work": """
        SELECT r.* FROM redo_late r WHERE EXISTS (
          SELECT 1 FROM lookup l WHERE l.Type = r.Type AND l.MonthDB IS NOT DISTINCT FROM r.MonthDB)""",
    "redo_rows": _rollup("redo_work"),
    "redo_routed": _route("redo_rows"),
    # Timezones.
    "inferred": _infer("obs"),
    "first_obs": f"SELECT * FROM obs_both WHERE Server IN ({_first})",
    "second_obs": f"""
        SELECT * FROM obs_both WHERE Server IN ({_second})
          AND Type NOT IN (SELECT Type FROM obs_both WHERE Server IN ({_first}))""",
    "inferred_first": _infer("first_obs"),
    "inferred_second": _infer("second_obs"),
    "chosen": f"SELECT * FROM ({_choose('inferred_first')}) UNION ALL SELECT * FROM ({_choose('inferred_second')})",
    "changes": """
        SELECT c.Type, c.Timezone, CASE WHEN o.Type = 97 THEN 5 ELSE o.Timezone END AS Timezone_old
        FROM chosen c JOIN tz o ON o.Type = c.Type
        WHERE c.Timezone IS DISTINCT FROM CASE WHEN o.Type = 97 THEN 5 ELSE o.Timezone END""",
    "observed": f"""
        SELECT l.LinkServerName, l.Type, max(w.wagerstime) AS table_max, TIMESTAMP '{ev.AFTER_UTC}' AS utc0,
               CAST(date_diff('minute', max(w.wagerstime), TIMESTAMP '{ev.AFTER_UTC}') AS BIGINT) AS diff_min
        FROM (SELECT DISTINCT {_SOURCE} FROM lookup) l
        LEFT JOIN wagers w ON w.Type = l.Type AND w.TableName = l.TableName
          AND w.MonthDB IS NOT DISTINCT FROM l.MonthDB
          AND (w.DBName <> '_DbShared' OR w.GameTypeSourceId IN (SELECT GameTypeSourceId FROM lookup k WHERE k.Type = w.Type))
        GROUP BY l.LinkServerName, l.Type""",
    # Gates.
    "busy_hours": "SELECT DISTINCT h + INTERVAL 8 HOUR AS current FROM typed",
    "lag_runs": """
        SELECT current AS DatePlayed, CASE WHEN EXISTS (
                 SELECT 1 FROM typed t WHERE t.event_type = 'purchase' AND t.h + INTERVAL 8 HOUR = b.current)
               THEN 'Success' ELSE 'Updating' END AS Status FROM busy_hours b""",
    "lag_gate": "SELECT DatePlayed AS current, Status = 'Success' AS ready FROM lag_runs",
    # Lookup derived from order lines.
    "big_lookup": """
        SELECT DISTINCT 'S' || CAST(s_nationkey % 5 AS VARCHAR) AS LinkServerName,
               CAST(l_partkey AS INT) AS GameTypeSourceId,
               CASE WHEN s_nationkey < 5 THEN '_DbShared' WHEN s_nationkey < 10 THEN '_DbLegacy' ELSE '_DbMonth' END AS DBName,
               CASE WHEN s_nationkey >= 10 THEN strftime(l_shipdate, '%y%m') END AS MonthDB,
               'Tbl' || CAST(s_nationkey AS VARCHAR) AS TableName, CAST(l_suppkey AS INT) AS Type
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "big_games": """
        SELECT CAST(s_suppkey AS INT) AS RawDataType,
               CASE n_nationkey WHEN 1 THEN 'SE' WHEN 2 THEN '3Sing' WHEN 3 THEN 'TGP2' WHEN 4 THEN 'PS2' ELSE n_name END AS GameHallName,
               CASE WHEN s_acctbal < 0 THEN NULL WHEN n_regionkey < 2 THEN '機率' ELSE '真人' END AS Category
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "big_tz": """
        SELECT CAST(s_suppkey AS INT) AS Type, CAST(s_nationkey - 12 AS INT) AS Timezone
        FROM supplier WHERE s_acctbal >= 0""",
    "big_info": """
        SELECT CAST(s_suppkey AS INT) AS Type, CAST(s_nationkey - 12 AS INT) AS Timezone FROM supplier
        UNION ALL
        SELECT CAST(s_suppkey AS INT), CAST(s_nationkey - 11 AS INT) FROM supplier
        JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 0""",
    "big_servers": _values(od.SERVERS, "Server, LinkServerName, GroupRouted"),
    # Every hour of all order dates, and the month database that a window read in it belongs to.
    "big_batches": """
        SELECT unnest(generate_series(min(date_trunc('day', l_shipdate)), max(date_trunc('day', l_shipdate)) + INTERVAL 23 HOUR,
                                      INTERVAL 1 HOUR)) AS h FROM lineitem""",
    "big_zone_hours": """
        SELECT z.Timezone, h, strftime(h + to_hours(CAST(coalesce(z.Timezone, 8) - 1 AS INT)), '%y%m') AS month,
               strftime(h + to_hours(CAST(coalesce(z.Timezone, 8) AS INT)), '%y%m') AS end_month
        FROM (SELECT DISTINCT Timezone FROM big_tz UNION ALL SELECT NULL) z CROSS JOIN big_batches""",
    "big_sources": f"""
        SELECT s.*, z.Timezone FROM (SELECT DISTINCT {_SOURCE} FROM big_lookup) s LEFT JOIN big_tz z ON z.Type = s.Type""",
    "big_spans": """
        SELECT s.*, c.low, c.high, c.n FROM big_sources s JOIN (
          SELECT Timezone, month, min(h) AS low, max(h) AS high, count(*) AS n FROM big_zone_hours GROUP BY Timezone, month
          UNION ALL SELECT Timezone, NULL, min(h), max(h), count(*) FROM big_zone_hours GROUP BY Timezone) c
          ON c.Timezone IS NOT DISTINCT FROM s.Timezone AND c.month IS NOT DISTINCT FROM s.MonthDB""",
    "big_manifest": """
        SELECT *, h + to_hours(CAST(Timezone - 1 AS INT)) AS start_t, h + to_hours(CAST(Timezone AS INT)) AS end_t,
               h + INTERVAL 8 HOUR AS DatePlayed
        FROM (SELECT *, unnest(generate_series(low, high, INTERVAL 1 HOUR)) AS h
              FROM (SELECT DISTINCT * FROM big_spans))""",
    "big_named": """
        SELECT s.*, c.end_month, c.low, c.high, c.n FROM big_sources s JOIN (
          SELECT Timezone, month, end_month, min(h) AS low, max(h) AS high, count(*) AS n
          FROM big_zone_hours GROUP BY Timezone, month, end_month
          UNION ALL SELECT Timezone, NULL, NULL, min(h), max(h), count(*) FROM big_zone_hours GROUP BY Timezone) c
          ON c.Timezone IS NOT DISTINCT FROM s.Timezone AND c.month IS NOT DISTINCT FROM s.MonthDB""",
    # One batch hour; the source of Type 39 declares a timezone.
    "one_batch": f"SELECT TIMESTAMP '{ev.BATCH}' AS h",
    "healed_tz": """
        SELECT Type, Timezone FROM tz UNION ALL
        SELECT Type, Timezone FROM declared_rows WHERE Type NOT IN (SELECT Type FROM tz)""",
    "one_manifest": _manifest("lookup", "one_batch", "healed_tz"),
    "one_rollup": _rollup("one_manifest"),
    "one_routed": _route("one_rollup"),
    "one_late": """
        SELECT l.LinkServerName, l.Type FROM lag_rows l JOIN one_batch b ON l.DatePlayed = b.h + INTERVAL 8 HOUR
        WHERE l.Status = 'Wait'""",
    # Hours that are observed and checked one after the other.
    "checked": _values([(str(u),) for u in ev.CHECKED], "utc_hour"),
    "check_obs": f"""
        SELECT CAST(c.utc_hour AS TIMESTAMP) AS utc, l.LinkServerName, l.Type, max(w.wagerstime) AS reading
        FROM checked c CROSS JOIN (SELECT DISTINCT {_SOURCE} FROM lookup) l
        LEFT JOIN wagers w ON w.Type = l.Type AND w.TableName = l.TableName AND w.MonthDB IS NOT DISTINCT FROM l.MonthDB
          AND w.wagerstime < CAST(c.utc_hour AS TIMESTAMP)
          AND (w.DBName <> '_DbShared' OR w.GameTypeSourceId IN (SELECT GameTypeSourceId FROM lookup k WHERE k.Type = w.Type))
        GROUP BY c.utc_hour, l.LinkServerName, l.Type""",
    "check_lag": """
        SELECT o.utc + INTERVAL 8 HOUR AS DatePlayed, o.LinkServerName, o.Type,
               CASE WHEN g.Type IS NULL OR o.reading >= o.due THEN 'Success' WHEN o.reading < o.due THEN 'Wait' ELSE 'TBD' END AS Status,
               CASE WHEN g.Type IS NOT NULL THEN o.reading END AS Table_max,
               CASE WHEN g.Type IS NOT NULL THEN o.due END AS Run_threshold
        FROM (SELECT b.*, b.utc + to_minutes(CAST(z.Timezone * 60 - 10 AS INT)) AS due
              FROM check_obs b LEFT JOIN tz z ON z.Type = b.Type) o
        LEFT JOIN targets g ON g.Type = o.Type""",
    "moved_tz": "SELECT Type, CASE WHEN Type = 97 THEN 5 ELSE Timezone END AS Timezone FROM tz",
    "ambiguous": """
        SELECT DISTINCT LinkServerName, DBName, MonthDB, TableName, Type FROM big_lookup
        WHERE GameTypeSourceId IN (
          SELECT GameTypeSourceId FROM big_lookup WHERE MonthDB = '9806' OR MonthDB IS NULL
          GROUP BY GameTypeSourceId HAVING count(*) >= 2)""",
    "people": """
        SELECT lower(c_name) || '@example.com' AS Email,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'DS' ELSE 'DBA' END AS Department, c_name AS name,
               c_acctbal >= 0 AS hourly, c_nationkey < 12 AS lookup_mail FROM customer""",
    "picked": """
        SELECT 'hourly_all' AS mode, Email FROM people WHERE hourly
        UNION ALL SELECT 'hourly_department', Email FROM people WHERE hourly AND Department = 'DS'
        UNION ALL SELECT 'lookup', Email FROM people WHERE lookup_mail
        UNION ALL SELECT 'owner', Email FROM people WHERE Department = 'DS' AND name = 'Customer#000000007'""",
}

_DOUBLE = "CAST({0} AS DOUBLE) AS {0}"
_REPORT = (
    "DatePlayed, GameAccount, SiteId, GameTypeSourceId, WagersCount, WinsCount, "
    + _DOUBLE.format("Commissionable") + ", " + _DOUBLE.format("PayOff")
)
_AT = f"TIMESTAMP '{ev.AFTER}'"
_BIG_AT = f"TIMESTAMP '{od.CURRENT}'"



def _one_hour(fails: str, kept: str) -> str:
    """Ledger and stored rows of the hour: ``fails`` is true of failed Types, ``kept`` of stored ones."""
    return f"""
        SELECT v.Server, m.Type, d.Destination, m.DatePlayed AS UpDateTime,
               CASE WHEN {fails} THEN 'Fail' WHEN r.n > 0 THEN 'Success' ELSE 'Empty' END AS Status,
               CASE WHEN {kept} THEN r.n END AS n, CASE WHEN {kept} THEN r.Commissionable END AS Commissionable
        FROM (SELECT DISTINCT LinkServerName, Type, DatePlayed FROM one_manifest) m
        JOIN servers v ON v.LinkServerName = m.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow
        LEFT JOIN (SELECT LinkServerName, Type, Destination, count(*) AS n,
                          CAST(sum(Commissionable) AS DOUBLE) AS Commissionable
                   FROM one_routed GROUP BY LinkServerName, Type, Destination) r
          ON r.LinkServerName = m.LinkServerName AND r.Type = m.Type AND r.Destination = d.Destination"""


_LATE = "EXISTS (SELECT 1 FROM one_late l WHERE l.Type = m.Type AND l.LinkServerName = m.LinkServerName)"



def _analysis(name: str, zones: str) -> str:
    """Stored timezones after the analysis: merged if no chosen one differs from a stored one."""
    changed = f"SELECT c.Type FROM chosen c JOIN {zones} o ON o.Type = c.Type WHERE c.Timezone IS DISTINCT FROM o.Timezone"
    return f"""
        SELECT '{name}' AS stored, x.*, x.Type IN ({changed}) AS changed FROM (
          SELECT coalesce(c.Type, z.Type) AS Type, CASE WHEN c.Type IS NULL THEN z.Timezone ELSE c.Timezone END AS Timezone,
                 CASE WHEN c.Type IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE {_AT} END AS UpdateTime,
                 CASE WHEN c.Type IS NULL THEN 'Updating' ELSE 'Success' END AS Status, TRUE AS merged
          FROM {zones} z FULL JOIN (SELECT Type, max(Timezone) AS Timezone FROM chosen GROUP BY Type) c ON c.Type = z.Type
          WHERE NOT EXISTS ({changed})
          UNION ALL
          SELECT Type, Timezone, TIMESTAMP '2024-01-01 00:00:00', 'Success', FALSE FROM {zones} WHERE EXISTS ({changed})) x"""


FINAL: dict[str, str] = {
    "q_run_hour_partial_failure": f"""
        SELECT *, 'broken' AS run, Type = 98 AS alone FROM ({_one_hour(f"({_LATE} OR m.Type = 98)", f"NOT {_LATE} AND m.Type <> 98")})
        UNION ALL
        SELECT *, 'mended', FALSE FROM ({_one_hour(_LATE, f"NOT {_LATE}")})""",
    "q_two_writers": f"""
        SELECT *, CASE WHEN Type IN (22, 97) THEN CAST(2000 AS DOUBLE) END AS added, CASE WHEN Type IN (22, 97) THEN 2 END AS attempts
        FROM ({_one_hour(_LATE, f"NOT {_LATE}")})""",
    "q_run_redo": """
        SELECT s.Server, s.Type, s.Destination, s.UpDateTime,
               CASE WHEN c.Server IS NULL THEN s.Status WHEN w.Type IS NULL THEN 'Fail'
                    WHEN r.n > 0 THEN 'Success' ELSE 'Empty' END AS Status,
               CASE WHEN c.Server IS NOT NULL THEN r.n END AS n,
               CASE WHEN c.Server IS NOT NULL THEN r.Commissionable END AS Commissionable
        FROM ledger s
        LEFT JOIN candidates c ON c.Server = s.Server AND c.Type = s.Type AND c.Destination = s.Destination
          AND c.UpDateTime = s.UpDateTime
        LEFT JOIN (SELECT DISTINCT v.Server, m.Type, m.DatePlayed FROM redo_work m
                   JOIN servers v ON v.LinkServerName = m.LinkServerName) w
          ON w.Server = s.Server AND w.Type = s.Type AND w.DatePlayed = s.UpDateTime
        LEFT JOIN (SELECT Server, Type, Destination, DatePlayed, count(*) AS n,
                          CAST(sum(Commissionable) AS DOUBLE) AS Commissionable
                   FROM redo_routed GROUP BY Server, Type, Destination, DatePlayed) r
          ON r.Server = s.Server AND r.Type = s.Type AND r.Destination = s.Destination AND r.DatePlayed = s.UpDateTime""",
    "q_observe_then_lag": """
        SELECT l.*, a.n_wait, a.since FROM check_lag l
        LEFT JOIN (SELECT Type, count(*) AS n_wait, min(DatePlayed) AS since FROM check_lag
                   WHERE Status = 'Wait' GROUP BY Type HAVING count(*) >= 3) a ON a.Type = l.Type""",
    "q_zone_readings": """
        SELECT Type, table_max, utc0, diff_min,
               (SELECT count(DISTINCT date_trunc('day', ts)) FROM events)
               + (SELECT count(DISTINCT date_trunc('day', ts)) FROM events WHERE day(ts) % 3 = 1) AS days_indexed
        FROM observed""",
    "q_zone_windows": f"""
        SELECT h.LinkServerName, h.Type, h.n_wagers, o.n_windows
        FROM (SELECT LinkServerName, Type, count(*) AS n_wagers FROM wagers GROUP BY LinkServerName, Type) h
        LEFT JOIN (
          SELECT m.LinkServerName, m.Type, count(*) AS n_windows FROM manifest m
          JOIN (SELECT {_SOURCE}, min(wagerstime) AS first_t, max(wagerstime) AS last_t FROM wagers
                GROUP BY {_SOURCE}, date_trunc('day', wagerstime)) z
            ON z.LinkServerName = m.LinkServerName AND z.DBName = m.DBName AND z.TableName = m.TableName
           AND z.Type = m.Type AND z.MonthDB IS NOT DISTINCT FROM m.MonthDB
           AND z.first_t < m.end_t AND z.last_t >= m.start_t AND date_trunc('day', z.first_t) = date_trunc('day', m.start_t)
          GROUP BY m.LinkServerName, m.Type) o ON o.LinkServerName = h.LinkServerName AND o.Type = h.Type""",
    "q_run_timezone_analysis": f"{_analysis('same', 'tz')} UNION ALL {_analysis('moved', 'moved_tz')}",
    "q_compacted_rollup": f"""
        SELECT Destination, count(*) AS n, CAST(sum(Commissionable) AS DOUBLE) AS Commissionable, TRUE AS few
        FROM routed GROUP BY Destination""",
    "q_run_hour": _one_hour(_LATE, f"NOT {_LATE}"),
    "q_run_hour_twice": _one_hour("m.Type IN (22, 97)", "true"),
    "q_manifest": f"""
        SELECT {_SOURCE}, CAST(DatePlayed AS DATE) AS day, count(*) AS n_hours, {_HOURS},
               min(h) AS first_batch, max(h) AS last_batch, min(start_t) AS first_start, max(end_t) AS last_end
        FROM big_manifest GROUP BY {_SOURCE}, CAST(DatePlayed AS DATE)""",
    "q_manifest_as_is": """
        SELECT Type, LinkServerName || '.' || DBName || coalesce(end_month, '') || '.VW_' || TableName AS source,
               low AS first_batch, high AS last_batch, n AS n_hours FROM big_named""",
    "q_read_inputs": """
        SELECT l.LinkServerName, l.Type, l.n_rows, z.Timezone,
               l.Type IN (SELECT RawDataType FROM big_games WHERE GameHallName IN ('SE', '3Sing', 'TGP2', 'PS2')) AS excluded,
               'source_lookup,type_timezone' AS copies
        FROM (SELECT LinkServerName, Type, count(*) AS n_rows FROM big_lookup GROUP BY LinkServerName, Type) l
        LEFT JOIN big_tz z ON z.Type = l.Type""",
    "q_site_members": """
        SELECT s.SiteType, w.SiteId, count(*) AS n FROM wagers w JOIN sites s ON s.Siteid = w.SiteId
        WHERE s.SiteType IN ('Noah1', 'Noah2') GROUP BY s.SiteType, w.SiteId""",
    "q_game_list": "SELECT DISTINCT LinkServerName, Type, GameTypeSourceId FROM big_lookup",
    "q_game_counts": """
        SELECT LinkServerName, Type, count(DISTINCT GameTypeSourceId) AS n_games FROM big_lookup
        GROUP BY LinkServerName, Type""",
    "q_excluded_games": """
        SELECT * FROM big_lookup WHERE GameTypeSourceId NOT IN (
          SELECT RawDataType FROM big_games WHERE GameHallName IN ('SE', '3Sing', 'TGP2', 'PS2'))""",
    "q_excluded_types": """
        SELECT * FROM big_lookup WHERE Type NOT IN (
          SELECT RawDataType FROM big_games WHERE GameHallName IN ('SE', '3Sing', 'TGP2', 'PS2'))""",
    "q_ambiguous_mappings": "SELECT * FROM ambiguous",
    "q_mapping_alerts": """
        SELECT LinkServerName, count(*) AS n_sources,
               'Lookup of ' || LinkServerName || ' is ambiguous at 1998-06-15 08:00:00.000' AS body
        FROM ambiguous GROUP BY LinkServerName""",
    "q_resolve_duplicate_mappings": """
        SELECT LinkServerName, GameTypeSourceId, DBName, MonthDB, TableName, Type
        FROM (SELECT *, count(*) OVER (PARTITION BY GameTypeSourceId) AS n FROM big_lookup)
        WHERE n = 1 OR DBName <> '_DbLegacy'""",
    "q_exclude_unreadable_sources": f"""
        SELECT DISTINCT {_SOURCE} FROM big_lookup
        WHERE Type NOT IN (SELECT CAST(s_suppkey AS INT) FROM supplier WHERE s_acctbal < 0)""",
    "q_hourly_rollup": f"SELECT {_REPORT} FROM rollup",
    "q_hourly_rollup_spread": f"SELECT {_REPORT} FROM rollup",
    "q_hourly_rollup_game_filter": f"SELECT {_REPORT} FROM rollup WHERE DBName = '_DbShared'",
    "q_rollup_lineitem": f"""
        SELECT strftime(l_shipdate, '%y%m') AS m, lower(c_name) AS GameAccount, c_nationkey AS SiteId,
               p_size AS GameTypeSourceId,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS Commissionable,
               count(*) AS WagersCount,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS PayOff,
               CAST(sum(CASE WHEN l_returnflag = 'R' AND CAST(l_extendedprice AS DECIMAL(18,2)) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS WinsCount
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        GROUP BY strftime(l_shipdate, '%y%m'), lower(c_name), c_nationkey, p_size
        HAVING sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 0""",
    "q_route_sites": f"""
        SELECT Destination, DatePlayed, Type, count(*) AS n,
               CAST(sum(Commissionable) AS DOUBLE) AS Commissionable
        FROM routed GROUP BY Destination, DatePlayed, Type""",
    "q_site_filter": f"""
        SELECT {_REPORT} FROM rollup
        WHERE SiteId NOT IN (SELECT Siteid FROM sites WHERE SiteType IN ('Noah1', 'Noah2'))""",
    "q_write_readback": f"""
        SELECT Destination, count(*) AS n, CAST(sum(Commissionable) AS DOUBLE) AS Commissionable
        FROM routed GROUP BY Destination""",
    "q_start_status": f"""
        SELECT v.Server, m.Type, d.Destination, 'Running' AS Status, CAST(m.DatePlayed AS DATE) AS day,
               count(*) AS n_rows, {_HOURS}
        FROM big_manifest m JOIN big_servers v ON v.LinkServerName = m.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow
        GROUP BY v.Server, m.Type, d.Destination, CAST(m.DatePlayed AS DATE)""",
    "q_batch_outcome": """
        SELECT DISTINCT v.Server, m.Type, d.Destination, m.DatePlayed AS UpDateTime,
               CASE WHEN m.start_t IS NULL OR EXISTS (
                      SELECT 1 FROM lag_rows l WHERE l.Status = 'Wait' AND l.Type = m.Type
                        AND l.LinkServerName = m.LinkServerName AND l.DatePlayed = m.DatePlayed) THEN 'Fail'
                    WHEN EXISTS (
                      SELECT 1 FROM routed r WHERE r.Type = m.Type AND r.LinkServerName = m.LinkServerName
                        AND r.DatePlayed = m.DatePlayed AND r.Destination = d.Destination) THEN 'Success'
                    ELSE 'Empty' END AS Status
        FROM manifest m JOIN servers v ON v.LinkServerName = m.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow""",
    "q_apply_status": """
        SELECT v.Server, m.Type, d.Destination, coalesce(u.Status, 'Running') AS Status,
               u.Exe_Time_sec, m.DatePlayed AS UpDateTime
        FROM manifest m JOIN servers v ON v.LinkServerName = m.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow
        LEFT JOIN ledger u ON u.Server = v.Server AND u.Type = m.Type AND u.Destination = d.Destination
          AND u.UpDateTime = m.DatePlayed""",
    "q_apply_status_all": """
        SELECT v.Server, m.Type, d.Destination, coalesce(u.Status, 'Running') AS Status,
               u.Exe_Time_sec, m.DatePlayed AS UpDateTime
        FROM manifest m JOIN servers v ON v.LinkServerName = m.LinkServerName
        JOIN dests d ON v.GroupRouted OR NOT d.narrow
        LEFT JOIN (SELECT DISTINCT Server, Type, UpDateTime, Status, Exe_Time_sec FROM ledger) u
          ON u.Server = v.Server AND u.Type = m.Type AND u.UpDateTime = m.DatePlayed""",
    "q_clone_last_as_fail": f"""
        SELECT Server, Type, Destination, 'Fail' AS Status, Exe_Time_sec, {_AT} AS UpDateTime
        FROM ledger s WHERE UpDateTime = (
          SELECT max(UpDateTime) FROM ledger k WHERE k.Server = s.Server AND k.Status IN ('Success', 'Empty'))""",
    "q_fail_all_types": f"""
        SELECT DISTINCT '30' AS Server, Type, 'Fail' AS Status, {_BIG_AT} AS UpDateTime
        FROM big_lookup WHERE LinkServerName = 'S3'""",
    "q_mark_running": """
        SELECT s.Server, s.Type, s.Destination, CASE WHEN c.Server IS NULL THEN s.Status ELSE 'Running' END AS Status,
               CASE WHEN c.Server IS NULL THEN s.Exe_Time_sec END AS Exe_Time_sec, s.UpDateTime
        FROM ledger s LEFT JOIN candidates c ON c.Server = s.Server AND c.Type = s.Type
          AND c.Destination = s.Destination AND c.UpDateTime = s.UpDateTime""",
    "q_gate_lookup_fresh": """
        SELECT current, EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'signup' AND e.event_id % 3 <> 0
                                  AND e.ts >= b.current) AS ready FROM busy_hours b""",
    "q_mark_lag_run": "SELECT * FROM lag_runs",
    "q_gate_lag_done": "SELECT * FROM lag_gate",
    "q_gate_alerts": """
        SELECT current, 'Lag check not ready at ' || strftime(current, '%Y-%m-%d %H:00:00.000') AS body
        FROM lag_gate WHERE NOT ready""",
    "q_missing_timezones": """
        SELECT DISTINCT Type FROM big_lookup
        WHERE LinkServerName = 'S3' AND Type NOT IN (SELECT Type FROM big_tz)""",
    "q_heal_timezones": f"""
        SELECT DISTINCT Type, Timezone, {_BIG_AT} AS UpdateTime, 'Success' AS Status FROM big_info
        WHERE Type IN (SELECT Type FROM big_lookup WHERE MonthDB IS NULL OR MonthDB = '9806')
          AND Type NOT IN (SELECT Type FROM big_tz)""",
    "q_conflicting_timezones": """
        SELECT Type, min(Timezone) AS lowest, max(Timezone) AS highest FROM big_info
        GROUP BY Type HAVING count(DISTINCT Timezone) > 1""",
    "q_latest_observation": """
        SELECT Type, Batch_time, table_max FROM (
          SELECT *, row_number() OVER (PARTITION BY Type ORDER BY Batch_time DESC, table_max DESC NULLS LAST) AS rn
          FROM obs) WHERE rn = 1""",
    "q_lag_status_for_hour": "SELECT * FROM lag_rows",
    "q_recheck_lag": "SELECT * FROM rechecked",
    "q_lag_alerts": """
        SELECT Type, count(*) AS n_wait, min(DatePlayed) AS since,
               'Type ' || CAST(Type AS VARCHAR) || ' has not been updated since '
                 || strftime(min(DatePlayed), '%Y-%m-%d %H:00:00.000') AS body
        FROM lag_rows WHERE lower(Status) = 'wait' GROUP BY Type HAVING count(*) >= 3""",
    "q_undecided_hours": "SELECT Type, count(*) AS n_undecided FROM lag_rows WHERE Status = 'TBD' GROUP BY Type",
    "q_redo_candidates": "SELECT * FROM candidates",
    "q_redo_rollup": f"""
        SELECT {_REPORT}, Destination FROM redo_routed r WHERE EXISTS (
          SELECT 1 FROM candidates c WHERE c.Server = r.Server AND c.Type = r.Type
            AND c.Destination = r.Destination AND c.UpDateTime = r.DatePlayed)""",
    "q_close_redo": """
        SELECT l.DatePlayed, l.LinkServerName, l.Type, l.Category,
               CASE WHEN c.Type IS NOT NULL THEN 'Success' ELSE l.Status END AS Status,
               l.Table_max, l.Run_threshold
        FROM rechecked l LEFT JOIN (
          SELECT DISTINCT m.LinkServerName, m.Type, m.DatePlayed FROM redo_work m) c
          ON c.LinkServerName = l.LinkServerName AND c.Type = l.Type AND c.DatePlayed = l.DatePlayed""",
    "q_observe_source_max": "SELECT Type, table_max, utc0, diff_min FROM observed",
    "q_append_observations": f"""
        SELECT * FROM obs UNION ALL
        SELECT TIMESTAMP '{ev.AFTER_UTC}' AS Batch_time, v.Server, o.Type, o.table_max, o.utc0, o.diff_min
        FROM observed o JOIN servers v ON v.LinkServerName = o.LinkServerName""",
    "q_tz_updates_only": """
        SELECT Type, Batch_time, table_max, table_max_lag, diff_min FROM (
          SELECT *, lag(table_max) OVER o AS table_max_lag, row_number() OVER o AS rn FROM obs
          WINDOW o AS (PARTITION BY Type ORDER BY Batch_time, Server, table_max))
        WHERE rn > 1 AND (table_max IS NULL OR table_max_lag IS NULL OR table_max <> table_max_lag)""",
    "q_infer_timezone": """
        SELECT Type, round(diff_min, 6) AS diff_min, n, round(variance, 6) AS variance,
               round(sth_left, 6) AS sth_left, timezone FROM inferred""",
    "q_declared_timezones": """
        SELECT DISTINCT Type, Timezone AS Timezone_DBA FROM big_info
        WHERE Type IN (SELECT Type FROM big_lookup)""",
    "q_type_category": "SELECT DISTINCT RawDataType AS Type, Category FROM big_games",
    "q_choose_timezone": _choose("inferred"),
    "q_second_path_types": "SELECT Type, Batch_time, table_max FROM second_obs",
    "q_timezone_changes": "SELECT * FROM changes",
    "q_timezone_alerts": """
        SELECT Type, 'Timezone of Type ' || CAST(Type AS VARCHAR) || ' changed from '
               || CAST(Timezone_old AS VARCHAR) || ' to ' || coalesce(CAST(Timezone AS VARCHAR), 'null')
               || '; not merged' AS body FROM changes""",
    "q_merge_timezones": f"""
        SELECT coalesce(c.Type, z.Type) AS Type,
               CASE WHEN c.Type IS NULL THEN z.Timezone ELSE c.Timezone END AS Timezone,
               CASE WHEN c.Type IS NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE {_AT} END AS UpdateTime,
               CASE WHEN c.Type IS NULL THEN 'Updating' ELSE 'Success' END AS Status
        FROM tz z FULL JOIN (SELECT Type, max(Timezone) AS Timezone FROM chosen GROUP BY Type) c ON c.Type = z.Type""",
    "q_select_recipients": """
        SELECT mode, string_agg(Email, ', ' ORDER BY Email) AS recipients FROM (
          SELECT mode, Email, (row_number() OVER (PARTITION BY mode ORDER BY md5(Email), Email) - 1) // 50 AS line
          FROM (SELECT DISTINCT mode, Email FROM picked))
        GROUP BY mode, line""",
}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in CTES if name in words]


def statement(sql: str) -> str:
    """A query with the derived tables it needs, in definition order."""
    wanted, queue = set(), _needs(sql)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += [n for n in _needs(CTES[name]) if n != name]
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in wanted]
    return f"WITH {', '.join(parts)} {sql.strip()}" if parts else sql.strip()


FINAL["q_observe_stored_then_lag"] = FINAL["q_observe_then_lag"]
ORACLE = {name: statement(sql) for name, sql in FINAL.items()}
