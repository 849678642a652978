"""Pattern and state jobs over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.patterns import (
    any_sequence_counts, any_sequences_within, match_map, next_then_followed_by, protocol_alerts,
)
from tidepool.operators.scan import MINUTE_US, time_chunk
from tidepool.plans.registry import REGISTRY, query
from tidepool.tables import load

LETTERS = {"signup": "a", "view": "b", "click": "c", "error": "e", "purchase": "g"}


def lettered(events):
    mapping = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])
    return events.withColumn("letter", mapping[F.col("event_type")])


@query("state_machine_alerts", """
    WITH RECURSIVE e AS (
        SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
               CASE event_type WHEN 'signup' THEN 'a' WHEN 'view' THEN 'b' WHEN 'click' THEN 'c'
                    WHEN 'error' THEN 'e' ELSE 'g' END AS letter FROM events),
    t(s, l, d) AS (VALUES ('Initial','a','W'), ('Initial','c','X'), ('W','b','Y'), ('X','b','Y'), ('X','d','Z'),
                          ('Y','e','Z'), ('Z','g','Initial')),
    r AS (
        SELECT DISTINCT user_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::VARCHAR AS letter, 'Initial' AS before,
               'Initial' AS state, true AS ok FROM e
        UNION ALL
        SELECT e.user_id, e.rn, e.event_id, e.letter, r.state, coalesce(t.d, r.state), t.d IS NOT NULL
        FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1
        LEFT JOIN t ON t.s = r.state AND t.l = e.letter)
    SELECT user_id, event_id, letter, before AS state FROM r WHERE NOT ok
""")
def state_machine_alerts(spark, folder):
    """Events that break the protocol, with the state they met; an invalid event changes nothing."""
    events = lettered(load(spark, folder, "events")).select("user_id", "ts", "event_id", "letter")
    alerts = protocol_alerts(events, ["user_id"], ["ts", "event_id"], time_chunk("ts", MINUTE_US), "letter")
    return alerts.select("user_id", "event_id", "letter", "state")


def _kinds():
    return [F.col("event_type") == k for k in ("signup", "view", "purchase")]


@query("cep_followed_by_any", """
    WITH s AS (SELECT *, count(CASE WHEN event_type = 'signup' THEN 1 END) OVER w AS starts FROM events
               WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m AS (SELECT *, sum(CASE WHEN event_type = 'view' THEN starts ELSE 0 END) OVER w AS matches FROM s
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT user_id, event_id AS end_id, CAST(matches AS BIGINT) AS matches FROM m WHERE event_type = 'purchase' AND matches > 0
""")
def cep_followed_by_any(spark, folder):
    """All signup .. view .. purchase sequences, counted at the purchase that completes them."""
    found = any_sequence_counts(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"],
                                time_chunk("ts", MINUTE_US), *_kinds())
    return found.select("user_id", F.col("event_id").alias("end_id"), "matches")


@query("cep_next_followed_by", """
    WITH n AS (SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT * FROM n WHERE event_type = 'signup' AND next_type = 'view')
    SELECT s.user_id, s.event_id AS start_id, s.next_id, p.event_id AS end_id
    FROM s ASOF JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON s.user_id = p.user_id AND s.next_ts < p.ts
""")
def cep_next_followed_by(spark, folder):
    """signup directly followed by view, then the next purchase."""
    return next_then_followed_by(load(spark, folder, "events"), ["user_id"], ["ts", "event_id"],
                                 time_chunk("ts", MINUTE_US), "event_id", *_kinds())


@query("cep_match_map", REGISTRY["cep_next_followed_by"].sql.replace(
    "SELECT s.user_id, s.event_id AS start_id, s.next_id, p.event_id AS end_id",
    "SELECT s.user_id, 3 AS stages, 'end,next,start' AS names, s.event_id AS start_id, p.event_id AS end_id"))
def cep_match_map(spark, folder):
    """The same matches processed as maps of stage to event: size, key set, members."""
    matched = match_map(cep_next_followed_by(spark, folder), {"start": "start_id", "next": "next_id", "end": "end_id"})
    return matched.select("user_id", "stages", F.array_join(F.sort_array("names"), ",").alias("names"),
                          F.col("match")["start"].alias("start_id"), F.col("match")["end"].alias("end_id"))


@query("cep_any_within", """
    SELECT a.user_id, a.event_id AS start_id, b.event_id AS middle_id, c.event_id AS end_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND (b.ts, b.event_id) > (a.ts, a.event_id) AND b.ts <= a.ts + INTERVAL 12 HOUR
    JOIN events c ON a.user_id = c.user_id AND (c.ts, c.event_id) > (b.ts, b.event_id) AND c.ts <= a.ts + INTERVAL 12 HOUR
    WHERE a.event_type = 'signup' AND b.event_type = 'view' AND c.event_type = 'purchase'
""")
def cep_any_within(spark, folder):
    """Every signup .. view .. purchase sequence of at most twelve hours, listed."""
    found = any_sequences_within(load(spark, folder, "events"), ["user_id"], "ts", "event_id", *_kinds(), 12 * 60 * MINUTE_US)
    return found.select("user_id", "start_id", "middle_id", "end_id")
