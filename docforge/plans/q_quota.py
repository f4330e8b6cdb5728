"""Queries over the request log: trailing-window rates and exact counters."""

from __future__ import annotations

from ..fixtures import Fixtures
from ..operators import quota as Q
from .registry import query


@query("request_rate", f"""
SELECT event_id, api_key, ts_us, tokens,
       CAST(count(*) OVER w60 AS BIGINT) AS req_60s,
       CAST(coalesce(sum(tokens) OVER w60, 0) AS BIGINT) AS tokens_60s,
       CAST(count(*) OVER wd AS BIGINT) AS req_day,
       count(*) OVER w60 >= {Q.RPM_LIMIT} AS rpm_hit,
       coalesce(sum(tokens) OVER w60, 0) >= {Q.TPM_LIMIT} AS tpm_hit,
       count(*) OVER wd >= {Q.RPD_LIMIT} AS rpd_hit
FROM requests
WINDOW w60 AS (PARTITION BY api_key ORDER BY ts_us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW),
       wd AS (PARTITION BY api_key ORDER BY ts_us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)""",
       ("requests",))
def q_request_rate(spark, sf):
    return Q.request_rate(Fixtures(spark, sf)["requests"])


@query("quota_fold", """
WITH RECURSIVE r0 AS (
  SELECT event_id, api_key, ts_us, tokens,
         row_number() OVER (PARTITION BY api_key ORDER BY ts_us, event_id) AS k,
         min(ts_us) OVER (PARTITION BY api_key) AS anchor,
         coalesce(count(*) OVER (PARTITION BY api_key ORDER BY ts_us
                  RANGE BETWEEN UNBOUNDED PRECEDING AND 60000000 PRECEDING), 0) AS older
  FROM requests),
f AS (
  SELECT api_key, k, event_id, ts_us, CAST(tokens AS BIGINT) AS tok,
         CASE WHEN ts_us > anchor + 60000000 THEN ts_us + 60000000 ELSE anchor + 60000000 END AS mreset,
         ts_us > anchor + 60000000 AS mflag,
         CAST(1 AS BIGINT) AS day,
         CASE WHEN ts_us > anchor + 86400000000 THEN ts_us + 86400000000 ELSE anchor + 86400000000 END AS dreset,
         ts_us > anchor + 86400000000 AS dflag
  FROM r0 WHERE k = 1
  UNION ALL
  SELECT r.api_key, r.k, r.event_id, r.ts_us,
         CASE WHEN r.ts_us > f.mreset THEN r.tokens ELSE f.tok + r.tokens END,
         CASE WHEN r.ts_us > f.mreset THEN r.ts_us + 60000000 ELSE f.mreset END,
         r.ts_us > f.mreset,
         CASE WHEN r.ts_us > f.dreset THEN 1 ELSE f.day + 1 END,
         CASE WHEN r.ts_us > f.dreset THEN r.ts_us + 86400000000 ELSE f.dreset END,
         r.ts_us > f.dreset
  FROM f JOIN r0 r ON r.api_key = f.api_key AND r.k = f.k + 1)
SELECT f.event_id, f.api_key, f.ts_us, f.tok AS tokens_minute, f.day AS day_requests,
       CAST(r0.k - r0.older AS BIGINT) AS rpm_after, f.mflag AS minute_reset, f.dflag AS day_reset
FROM f JOIN r0 ON f.event_id = r0.event_id""", ("requests",))
def q_quota_fold(spark, sf):
    return Q.quota_fold(Fixtures(spark, sf)["requests"])

