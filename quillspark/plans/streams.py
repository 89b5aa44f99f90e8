"""Streaming queries, run over all events that are there, and their batch equals in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import discovery
from ..sources.store import shared_folder
from ..streaming import events, in_order, leases, quota, shared_quota
from .registry import Registry
from .standins import table

REGISTRY = Registry()
query = REGISTRY.query


def _stored(spark, df, name: str, run):
    """The rows that a stream leaves in a Parquet table."""
    path = shared_folder(spark, name)
    run(df, path, shared_folder(spark, f"{name}-offsets"))
    return spark.read.schema(df.schema).parquet(path)


def _events(spark, sf_dir):
    return events.read_events(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events"))


@query("SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) window_start_us, event_type, count(*) n, round(sum(value), 2) total FROM events GROUP BY 1, 2")
def events_tumbling(spark, sf_dir):
    got = _stored(spark, events.tumbling(_events(spark, sf_dir)), "tumbling", events.run_whole)
    return got.select(F.unix_micros("window_start").alias("window_start_us"), "event_type", "n", F.round("total", 2).alias("total"))


@query("""WITH w AS (SELECT event_type, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) s FROM events)
SELECT epoch_us(s) window_start_us, event_type, count(*) n FROM w GROUP BY 1, 2""")
def events_sliding(spark, sf_dir):
    got = _stored(spark, events.tumbling(_events(spark, sf_dir), slide="12 hours"), "sliding", events.run_whole)
    return got.select(F.unix_micros("window_start").alias("window_start_us"), "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) k FROM g)
SELECT user_id, epoch_us(min(ts)) start_us, epoch_us(max(ts) + INTERVAL 2 HOUR) end_us, count(*) n FROM s GROUP BY user_id, k""")
def events_session(spark, sf_dir):
    got = _stored(spark, events.sessions(_events(spark, sf_dir), gap="2 hours"), "session", events.run_whole)
    return got.select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n")


@query("""WITH RECURSIVE q AS (SELECT 'd' || CAST(user_id % 10 AS VARCHAR) deployment, epoch_us(ts) / 1e6 ts, value tokens, event_type = 'error' refused FROM events),
d AS (SELECT deployment, list({'ts': ts, 'tokens': tokens, 'refused': refused} ORDER BY ts, tokens, refused) r FROM q GROUP BY 1),
s AS (SELECT deployment, CAST(0 AS BIGINT) i, CAST(1 AS DOUBLE) req, CAST(10 AS DOUBLE) tok, CAST(0 AS DOUBLE) last, CAST(0 AS DOUBLE) cool, CAST(1 AS DOUBLE) mul, FALSE granted, CAST(0 AS DOUBLE) wait FROM d
  UNION ALL SELECT deployment, i + 1, CASE WHEN ok THEN r2 - 1 ELSE req END, CASE WHEN ok THEN t2 - x.tokens ELSE tok END, CASE WHEN ok THEN x.ts ELSE last END,
    CASE WHEN x.refused THEN greatest(cool, x.ts + 2) ELSE cool END, CASE WHEN x.refused THEN greatest(0.2, mul * 0.8) WHEN ok THEN least(1, mul + 0.002) ELSE mul END, ok, CASE WHEN x.refused THEN 0 ELSE w END
  FROM (SELECT *, NOT x.refused AND w <= 0 ok FROM (SELECT *, greatest(0, cool - x.ts, CASE WHEN r2 < 1 THEN (1 - r2) * 60 / (0.02 * mul) ELSE 0 END, CASE WHEN t2 < x.tokens THEN (x.tokens - t2) * 60 / (1.0 * mul) ELSE 0 END) w
    FROM (SELECT *, least(1, req + greatest(0, x.ts - last) * 0.02 * mul / 60) r2, least(10, tok + greatest(0, x.ts - last) * 1.0 * mul / 60) t2 FROM (SELECT s.*, d.r[i + 1] x FROM s JOIN d USING (deployment) WHERE i < len(d.r)) a) b) c) e)
SELECT deployment, round(r[i].ts, 6) ts, r[i].tokens tokens, CASE WHEN r[i].refused THEN 429 ELSE 200 END status, granted, round(wait, 4) wait, round(mul, 6) multiplier FROM s JOIN d USING (deployment) WHERE i > 0""")
def quota_bucket(spark, sf_dir):
    rows = _events(spark, sf_dir).select(F.concat(F.lit("d"), F.pmod("user_id", F.lit(10)).cast("string")).alias("deployment"), (F.unix_micros("ts") / 1e6).alias("ts"), F.col("value").alias("tokens"), F.when(F.col("event_type") == "error", 429).otherwise(200).alias("status"))
    got = _stored(spark, quota.throttle(rows, 0.02, 1.0, 10.0), "quota", events.run_to_parquet)
    return got.select("deployment", F.round("ts", 6).alias("ts"), "tokens", "status", "granted", F.round("wait", 4).alias("wait"), F.round("multiplier", 6).alias("multiplier"))


#: Limits of the shared quota in six hours, the pause after a refused call, and how late requests may come.
PERIOD_MS, PER_PERIOD, PERIOD_TOKENS, DELAY_MS, LATE_MS = 6 * 3_600_000, 6, 400.0, 3_600_000, 2 * 3_600_000


@query(f"""WITH RECURSIVE e AS (SELECT 'd' || CAST(user_id % 10 AS VARCHAR) k, epoch_us(ts) // 1000 ts, event_id r, value n, event_type = 'error' bad FROM events),
done AS (SELECT max(ts) - {LATE_MS} until FROM e),
d AS (SELECT k, list({{'ts': ts, 'r': r, 'n': n, 'bad': bad}} ORDER BY ts, r, n) ev, list({{'ts': ts, 'r': r, 'n': n}} ORDER BY ts, r, n) FILTER (NOT bad AND n <= {PERIOD_TOKENS}) asks FROM e, done WHERE ts <= until GROUP BY 1),
s AS (SELECT k, CAST(1 AS BIGINT) i, CAST(1 AS BIGINT) a, CAST(0 AS BIGINT) seen, CAST([] AS STRUCT(g BIGINT, n DOUBLE)[]) log, CAST(0 AS BIGINT) last, CAST(0 AS BIGINT) cool, CAST(1 AS DOUBLE) mul, CAST(NULL AS BIGINT) granted FROM d
  UNION ALL SELECT k, i + CAST(ev_next AS BIGINT), a + CAST(NOT ev_next AS BIGINT), seen + CASE WHEN ev_next AND NOT x.bad AND x.n <= {PERIOD_TOKENS} THEN 1 ELSE 0 END,
    CASE WHEN ev_next THEN log ELSE list_append(list_filter(log, lambda l: l.g > g - {PERIOD_MS}), {{'g': g, 'n': ask.n}}) END, CASE WHEN ev_next THEN last ELSE g END, CASE WHEN ev_next AND x.bad THEN greatest(cool, x.ts + {DELAY_MS}) ELSE cool END,
    CASE WHEN ev_next AND x.bad THEN greatest(0.2, mul * 0.8) WHEN ev_next THEN mul ELSE least(1, mul + 0.002) END, CASE WHEN ev_next THEN NULL ELSE g END
  FROM (SELECT *, x IS NOT NULL AND (g IS NULL OR x.ts <= g) ev_next FROM (SELECT *, CASE WHEN a <= seen THEN list_filter(list_sort(list_concat([t0], list_filter(list_transform(log, lambda l: l.g + {PERIOD_MS}), lambda t: t > t0))),
      lambda t: len(list_filter(log, lambda l: l.g > t - {PERIOD_MS})) = 0 OR (len(list_filter(log, lambda l: l.g > t - {PERIOD_MS})) < greatest(1, CAST(floor({PER_PERIOD} * mul) AS BIGINT)) AND list_sum(list_transform(list_filter(log, lambda l: l.g > t - {PERIOD_MS}), lambda l: l.n)) + ask.n <= {PERIOD_TOKENS} * mul))[1] END g
    FROM (SELECT s.*, d.ev[i] x, d.asks[a] ask, greatest(d.asks[a].ts, last, cool) t0 FROM s JOIN d USING (k)) q) q) q WHERE x IS NOT NULL OR g <= (SELECT until FROM done))
SELECT k deployment, asks[a - 1].r request, asks[a - 1].ts asked_ms, granted granted_ms, asks[a - 1].n tokens FROM s JOIN d USING (k), done WHERE granted IS NOT NULL AND granted <= until
UNION ALL SELECT k, r, ts, NULL, n FROM e, done WHERE NOT bad AND n > {PERIOD_TOKENS} AND ts <= until""")
def shared_quota_grants(spark, sf_dir):
    in_order.use_store(spark)
    rows = _events(spark, sf_dir).select(F.concat(F.lit("d"), F.pmod("user_id", F.lit(10)).cast("string")).alias("deployment"), F.col("event_id").alias("request"), "ts", F.col("value").alias("tokens"), F.when(F.col("event_type") == "error", 429).otherwise(200).alias("status"))
    return _stored(spark, shared_quota.grants(rows, PER_PERIOD, PERIOD_TOKENS, PERIOD_MS, DELAY_MS, f"{LATE_MS // 1000} seconds"), "grants", events.run_to_parquet)


@query("SELECT event_id FROM events WHERE event_type = 'error'")
def discovered_ids(spark, sf_dir):
    """Three runs of a discovery, with new rows in between: every id without a value comes once."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    source, out, offsets = (shared_folder(spark, n) for n in ("source", "discovered", "cursor"))
    last = rows.agg(F.max("event_id")).first()[0] or 0
    for part in range(3):
        rows.where((F.col("event_id") > last * part // 3 - (part == 0)) & (F.col("event_id") <= last * (part + 1) // 3)).write.mode("append").parquet(source)
        events.run_to_parquet(discovery.new_ids(spark, source, "event_id", "v"), out, offsets)
    return spark.read.schema("event_id long").parquet(out)


#: How long a lease is, and which event does what to its user's task.
LEASE_MS = 12 * 3_600_000


@query(f"""WITH RECURSIVE e AS (SELECT 't' || user_id k, epoch_us(ts) // 1000 ts, event_id r, CASE event_type WHEN 'click' THEN 'renew' WHEN 'purchase' THEN 'finish' ELSE 'claim' END kind, 'w' || (event_id % 3) o FROM events WHERE event_type <> 'error' AND (event_type <> 'purchase' OR event_id % 10 = 0)),
done AS (SELECT max(ts) - {LATE_MS} until FROM e), d AS (SELECT k, list({{'ts': ts, 'r': r, 'kind': kind, 'o': o}} ORDER BY ts, r) ev FROM e, done WHERE ts <= until GROUP BY 1),
s AS (SELECT k, CAST(1 AS BIGINT) i, CAST(NULL AS VARCHAR) o, CAST(NULL AS BIGINT) u, FALSE fin, CAST(NULL AS BIGINT) at_ms, CAST(NULL AS VARCHAR) what, CAST(NULL AS VARCHAR) owner, CAST(NULL AS BIGINT) until_ms FROM d
  UNION ALL SELECT k, i + CAST(ev_next AS BIGINT), CASE WHEN NOT ev_next OR (ok AND x.kind = 'finish') THEN NULL WHEN ok THEN x.o ELSE o END, CASE WHEN NOT ev_next OR (ok AND x.kind = 'finish') THEN NULL WHEN ok THEN x.ts + {LEASE_MS} ELSE u END, fin OR (ev_next AND ok AND x.kind = 'finish'),
    CASE WHEN ev_next THEN x.ts ELSE u END, CASE WHEN NOT ev_next THEN 'expired' WHEN ok THEN x.kind ELSE x.kind || ' refused' END, CASE WHEN ev_next THEN x.o ELSE o END, CASE WHEN NOT ev_next OR (ok AND x.kind = 'finish') THEN NULL WHEN ok THEN x.ts + {LEASE_MS} ELSE u END
  FROM (SELECT *, x IS NOT NULL AND (u IS NULL OR x.ts <= u) ev_next, CASE WHEN x.kind = 'claim' THEN o IS NULL AND NOT fin ELSE coalesce(o = x.o, FALSE) END ok FROM (SELECT s.*, d.ev[i] x FROM s JOIN d USING (k)) q) q WHERE x IS NOT NULL OR u <= (SELECT until FROM done))
SELECT k task, at_ms, what, owner, until_ms FROM s WHERE what IS NOT NULL""")
def lease_events(spark, sf_dir):
    """Claims, renewals and results of tasks, with the leases that end by themselves."""
    in_order.use_store(spark)
    kind = F.when(F.col("event_type") == "click", "renew").when(F.col("event_type") == "purchase", "finish").otherwise("claim")
    wanted = (F.col("event_type") != "error") & ((F.col("event_type") != "purchase") | (F.pmod("event_id", F.lit(10)) == 0))
    rows = _events(spark, sf_dir).where(wanted).select(F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("task"), F.col("event_id").alias("event"), "ts", kind.alias("kind"), F.concat(F.lit("w"), F.pmod("event_id", F.lit(3)).cast("string")).alias("owner"))
    return _stored(spark, leases.leases(rows, LEASE_MS, f"{LATE_MS // 1000} seconds"), "leases", events.run_to_parquet)


#: Events by the file that they arrive with: every twentieth of the first half comes with the last one, too late for most windows.
ARRIVAL = "CASE WHEN event_id * 2 < n THEN CASE WHEN event_id % 20 = 0 THEN 3 ELSE 1 END WHEN event_id * 4 < 3 * n THEN 2 ELSE 3 END"


def _arriving(spark, sf_dir):
    """The stream of three files, one a micro-batch."""
    source = shared_folder(spark, "arriving")
    rows = table(spark, sf_dir, "events")
    n = rows.agg(F.max("event_id")).first()[0] or 0
    dealt = rows.withColumn("_file", F.expr(ARRIVAL.replace(" n ", f" {n} ")))
    for part in (1, 2, 3):
        dealt.where(F.col("_file") == part).drop("_file").coalesce(1).write.mode("append").parquet(source)
    return events.read_events(spark, source, rows, files=1)


@query(f"""WITH b AS (SELECT *, {ARRIVAL} f FROM events, (SELECT max(event_id) n FROM events)), w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) s FROM b),
passed AS (SELECT max(ts) FILTER (f = 1) - INTERVAL 1 HOUR early, max(ts) - INTERVAL 1 HOUR last FROM b)
SELECT epoch_us(s) window_start_us, event_type, count(*) n FROM w, passed WHERE NOT (f = 3 AND s + INTERVAL 6 HOUR <= early) AND s + INTERVAL 6 HOUR <= last GROUP BY 1, 2""")
def events_late(spark, sf_dir):
    """Windows in append mode: each comes once, when the watermark has passed it, without what came later."""
    got = _stored(spark, events.tumbling(_arriving(spark, sf_dir), width="6 hours"), "late", events.run_to_parquet)
    return got.select(F.unix_micros("window_start").alias("window_start_us"), "event_type", "n")


@query("SELECT t.user_id, t.event_id task_id, f.event_id failure_id FROM events t JOIN events f ON t.user_id = f.user_id AND f.ts >= t.ts AND f.ts <= t.ts + INTERVAL 6 HOUR WHERE t.event_type = 'click' AND f.event_type = 'error'")
def failures_of_tasks(spark, sf_dir):
    """A join of two streams by user and time."""
    rows = lambda kind: _events(spark, sf_dir).where(F.col("event_type") == kind)
    return _stored(spark, events.failures_of(rows("click"), rows("error"), "6 HOURS"), "failures", events.run_to_parquet)


@query("SELECT event_id, user_id, event_type FROM events")
def events_once(spark, sf_dir):
    """A stream in which a third of the events is sent again."""
    source, rows = shared_folder(spark, "sent-again"), table(spark, sf_dir, "events")
    for part in (rows, rows.where(F.pmod("event_id", F.lit(3)) == 0)):
        part.write.mode("append").parquet(source)
    got = events.once(events.read_events(spark, source, rows), late="60 days")
    return _stored(spark, got.select("event_id", "user_id", "event_type"), "once", events.run_to_parquet)
