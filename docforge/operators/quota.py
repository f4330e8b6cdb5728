"""Request accounting per API key.

``request_rate`` counts, for every request, the key's requests and tokens in
the trailing 60 seconds (strictly after now - 60 s) and requests in the
trailing day, and flags them against the limits.  It is exact and skew-safe:
requests are pre-aggregated per (key, timestamp) and sorted, together with a
probe at ``t - window`` for each window, into ranges of bounded rows; running
sums over the ranges give the counts at every timestamp and every probe, and
their differences are the windows.  Requests without a key are a key of
their own; requests without a timestamp are in no other request's window and
see each other, the requests of their key without one (as SQL's range windows).

``quota_fold`` follows the tracker's own counters exactly: a token counter
that resets at the first request more than 60 s after the previous reset
(anchored at the tracker's start) and a daily request counter with the same
rule over 86,400 s.  Resets depend on all earlier resets of the key, so this is
a fold; what a range of requests does to the pending resets and counters is a
step function of the pending reset time it starts with, and a chain over these
functions lets all ranges fold at the same time.  ``quota_fold_after`` does the
same from the counters that earlier requests left behind.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import fold_in_ranges, in_ranges, running_sums

MINUTE_US = 60_000_000
DAY_US = 86_400_000_000
# fixed values: the service limits the tracker checks against
RPM_LIMIT, TPM_LIMIT, RPD_LIMIT = 15, 1_000_000, 1_500


def request_rate(requests: DataFrame, rpm: int = RPM_LIMIT, tpm: int = TPM_LIMIT, rpd: int = RPD_LIMIT,
                 key: str = "api_key", ts: str = "ts_us", tokens: str = "tokens") -> DataFrame:
    """The requests with ``req_60s, tokens_60s, req_day, rpm_hit, tpm_hit, rpd_hit``."""
    # a struct is never null and equals one with a null inside, so the join keeps null keys and times
    place = F.struct(F.col(key).alias("key"), F.col(ts).alias("ts"))
    per_ts = requests.groupBy(place.alias("_place")).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(tokens), F.lit(0)).alias("_tok"))
    # every timestamp and its two probes; a probe comes after the requests of its time
    entry = F.explode(F.array(*[F.struct(F.lit(w).alias("kind"), (F.col("_place.ts") - back).alias("at"))
                                for w, back in ((0, 0), (1, MINUTE_US), (2, DAY_US))]))
    seq = per_ts.where("_place.ts is not null").select(F.col("_place.key").alias("_key"), F.col("_place.ts").alias("_ts"),
                                                       "_n", "_tok", entry.alias("_e"))
    seq = seq.select("_key", "_ts", F.col("_e.at").alias("_at"), F.col("_e.kind").alias("_kind"),
                     *[F.when(F.col("_e.kind") == 0, F.col(c)).otherwise(0).alias(c) for c in ("_n", "_tok")])
    summed = running_sums(in_ranges(seq, ["_key"], ["_at", "_kind", "_ts"]), ["_key"], ["_at", "_kind", "_ts"],
                          {"_cn": "_n", "_ct": "_tok"})

    def since(column, kind):
        return (F.max(F.when(F.col("_kind") == 0, F.col(column)))
                - F.max(F.when(F.col("_kind") == kind, F.col(column)))).cast("bigint")

    stats = summed.groupBy(F.struct(F.col("_key").alias("key"), F.col("_ts").alias("ts")).alias("_place")).agg(
        since("_cn", 1).alias("req_60s"), since("_ct", 1).alias("tokens_60s"), since("_cn", 2).alias("req_day"))
    undated = per_ts.where("_place.ts is null").select(
        "_place", F.col("_n").alias("req_60s"), F.col("_tok").cast("bigint").alias("tokens_60s"),
        F.col("_n").alias("req_day"))
    out = requests.withColumn("_place", place).join(stats.unionByName(undated), "_place").drop("_place")
    return out.withColumns({
        "rpm_hit": F.col("req_60s") >= rpm,
        "tpm_hit": F.col("tokens_60s") >= tpm,
        "rpd_hit": F.col("req_day") >= rpd,
    })


# ---------------------------------------------------------------------------
# exact counters (a fold per key)
# ---------------------------------------------------------------------------
def _reset_marks(ts: np.ndarray, first_reset: int, width: int) -> np.ndarray:
    """Boolean marks of the requests that reset a counter: the first request
    strictly after the pending reset time, which then moves to its time +
    width.  One binary search per reset."""
    marks = np.zeros(len(ts), dtype=bool)
    r = first_reset
    i = int(np.searchsorted(ts, r, side="right"))
    while i < len(ts):
        marks[i] = True
        r = int(ts[i]) + width
        i = int(np.searchsorted(ts, r, side="right"))
    return marks


def fresh_carry(anchor_us: int) -> tuple:
    """Counters before a key's first request: next minute reset, tokens, next
    day reset, requests of the day, timestamps of the trailing minute and the
    number of requests at each."""
    return anchor_us + MINUTE_US, 0, anchor_us + DAY_US, 0, [], []


def _since_reset(marks: np.ndarray, amounts: np.ndarray, carried: int) -> np.ndarray:
    """Running sum that restarts at each mark; ``carried`` counts before the
    first one."""
    total = np.cumsum(amounts)
    base = np.maximum.accumulate(np.where(marks, np.arange(len(marks)), -1))
    return np.where(base < 0, total + carried, total - total[base] + amounts[base])


def fold_batch(pdf: pd.DataFrame, carry: tuple) -> tuple[pd.DataFrame, tuple]:
    """The counters after each request of one key, from the carried ones, and
    the carry for its next requests."""
    next_minute, tokens, next_day, requests, recent, recent_n = carry
    pdf = pdf.sort_values(["ts_us", "event_id"], kind="stable")
    ts = pdf["ts_us"].to_numpy(dtype=np.int64)
    m, d = _reset_marks(ts, next_minute, MINUTE_US), _reset_marks(ts, next_day, DAY_US)
    out = pd.DataFrame({
        "event_id": pdf["event_id"].to_numpy(dtype=np.int64),
        "api_key": pdf["api_key"].to_numpy(dtype=np.int64),
        "ts_us": ts,
        "tokens_minute": _since_reset(m, pdf["tokens"].fillna(0).to_numpy(dtype=np.int64), tokens),
        "day_requests": _since_reset(d, np.ones(len(ts), dtype=np.int64), requests),
        "minute_reset": m,
        "day_reset": d,
    })
    # requests inside the trailing minute: of this batch, and carried ones
    start = ts - MINUTE_US
    counts = np.concatenate([[0], np.cumsum(np.asarray(recent_n, dtype=np.int64))]).astype(np.int64)
    carried = counts[-1] - counts[np.searchsorted(np.asarray(recent, dtype=np.int64), start, side="right")]
    out.insert(5, "rpm_after", np.arange(1, len(ts) + 1) - np.searchsorted(ts, start, side="right") + carried)
    return out, (int(ts[m][-1]) + MINUTE_US if m.any() else next_minute, int(out["tokens_minute"].iloc[-1]),
                 int(ts[d][-1]) + DAY_US if d.any() else next_day, int(out["day_requests"].iloc[-1]),
                 *_trailing(recent, recent_n, ts))


def _trailing(recent, recent_n, ts: np.ndarray) -> tuple[list, list]:
    """The distinct timestamps of the minute before the last of ``ts``, and how
    many requests fell on each: carried ones and those of ``ts`` (sorted)."""
    since = ts[-1] - MINUTE_US
    stamps, n = np.unique(ts[np.searchsorted(ts, since, side="right"):], return_counts=True)
    recent = np.asarray(recent, dtype=np.int64)
    kept = recent > since
    return ([*recent[kept].tolist(), *stamps.tolist()],
            [*np.asarray(recent_n, dtype=np.int64)[kept].tolist(), *n.tolist()])


def fold_key(pdf: pd.DataFrame, anchor_us: int | None) -> pd.DataFrame:
    anchor = int(pdf["ts_us"].min()) if anchor_us is None else int(anchor_us)
    return fold_batch(pdf, fresh_carry(anchor))[0]


FOLD_SCHEMA = ("event_id bigint, api_key bigint, ts_us bigint, tokens_minute bigint, day_requests bigint, "
               "rpm_after bigint, minute_reset boolean, day_reset boolean")
FOLD_COLUMNS = [c.split()[0] for c in FOLD_SCHEMA.split(", ")]


NO_KEY = -(1 << 63)  # stands for a null key inside the fold


def _reset_steps(ts: np.ndarray, amounts: np.ndarray, latest: int, width: int) -> tuple:
    """What sorted requests do to a counter of period ``width``, as a step
    function of the reset time ``r <= latest`` that is pending before them: with
    ``i`` the first entry of ``above`` larger than ``r``, the pending time and
    the counter behind them are ``reset[i]`` and ``count[i]``; without one
    nothing is reset and ``total`` is added."""
    at, first = np.unique(ts, return_index=True)
    n = len(at)
    before = np.concatenate([[0], np.cumsum(amounts)])
    following = np.searchsorted(at, at + width, side="right")      # the reset after one at each time
    last = np.where(following < n, following, np.arange(n))
    while not np.array_equal(jump := last[last], last):            # the last reset, were each time one
        last = jump
    last = last[:int(np.searchsorted(at, latest, side="right")) + 1]
    steps = np.flatnonzero(np.append(last[1:] != last[:-1], True))
    last = last[steps]
    return at[steps], at[last] + width, before[-1] - before[first[last]], int(before[-1])


def _after_steps(steps: tuple, pending: int, counter: int) -> tuple[int, int]:
    above, reset, count, total = steps
    i = int(np.searchsorted(above, pending, side="right"))
    return (int(reset[i]), int(count[i])) if i < len(above) else (pending, counter + total)


def quota_fold(requests: DataFrame, anchor_us: int | None = None) -> DataFrame:
    """Counters after every request, per key, exactly as the tracker keeps
    them.  ``anchor_us``: tracker start (default: the key's first request).

    One plan for every key size: requests in ranges of bounded rows, see
    ``fold_in_ranges``.  What a range hands on is its step functions (at most
    one step per distinct timestamp within one period of its first request) and
    the timestamps of its last minute.  Null tokens count 0; requests without a
    key are a key of their own; requests need a timestamp."""
    cols = requests.select(F.col("event_id").cast("bigint"),
                           F.coalesce(F.col("api_key").cast("bigint"), F.lit(NO_KEY)).alias("api_key"),
                           F.col("ts_us").cast("bigint"),
                           F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)).alias("tokens"))

    def summarize(rows):
        ts, tokens = rows["ts_us"].to_numpy(np.int64), rows["tokens"].to_numpy(np.int64)
        start = int(ts[0]) if anchor_us is None else max(int(ts[0]), int(anchor_us))
        return (int(ts[0]), _reset_steps(ts, tokens, start + MINUTE_US, MINUTE_US),
                _reset_steps(ts, np.ones(len(ts), np.int64), start + DAY_US, DAY_US),
                ts[np.searchsorted(ts, ts[-1] - MINUTE_US, side="right"):])

    def advance(carry, summary):
        first, minute, day, tail = summary
        carry = carry or fresh_carry(first if anchor_us is None else int(anchor_us))
        return (*_after_steps(minute, *carry[:2]), *_after_steps(day, *carry[2:4]), *_trailing(*carry[4:], tail))

    def fold(rows, carry):
        out = []
        for _, own in rows.groupby("api_key", sort=False):
            first = int(own["ts_us"].iloc[0]) if anchor_us is None else int(anchor_us)
            out.append(fold_batch(own, carry if carry is not None and not out else fresh_carry(first))[0])
        return pd.concat(out, ignore_index=True)

    order = ["ts_us", "event_id"]
    out = fold_in_ranges(in_ranges(cols, ["api_key"], order), "api_key", order, summarize, advance, fold, FOLD_SCHEMA)
    return out.withColumn("api_key", F.nullif(F.col("api_key"), F.lit(NO_KEY)))


# ---------------------------------------------------------------------------
# exact counters from carried ones (micro-batches)
# ---------------------------------------------------------------------------
CARRY_SCHEMA = "api_key bigint, carry string"    # the counters of ``fold_batch`` as JSON, by key (null: ``NO_KEY``)
FIRST, LAST = -(1 << 63), (1 << 63) - 1          # times before and behind those of all requests
RANGE_ROWS = 250_000


def _parts(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, pd.DataFrame]:
    """Of a key's rows in order: what it starts with, its dated and its undated requests."""
    ts = rows["ts_us"].to_numpy(np.int64)
    a, b = np.searchsorted(ts, FIRST, side="right"), np.searchsorted(ts, LAST)
    return rows.iloc[:a], rows.iloc[a:b], rows.iloc[b:]


def _started(state: tuple | None, start: tuple | None, anchor_us: int | None) -> tuple:
    """The counters a key goes on with, and how many undated requests it has
    ahead.  Without an anchor the first dated request sets the reset times."""
    if start is None and state is not None:
        return state
    carry, undated = start or (None, 0)
    if carry is not None:
        return (*json.loads(carry), undated)
    return (*((None, 0, None, 0, [], []) if anchor_us is None else fresh_carry(anchor_us)), undated)


def _anchored(state: tuple, first: int) -> tuple:
    minute, tokens, day, *rest = state
    return (first + MINUTE_US if minute is None else minute, tokens, first + DAY_US if day is None else day, *rest)


def _in_time(recent: list, recent_n: list) -> tuple[list, list]:
    order = np.argsort(recent, kind="stable")
    return np.asarray(recent, np.int64)[order].tolist(), np.asarray(recent_n, np.int64)[order].tolist()


def _fold_undated(rows: pd.DataFrame, state: tuple) -> tuple[pd.DataFrame, tuple]:
    """Requests without a time come after all others of their key in the batch
    and reset nothing; as a range window has it, none is in the trailing minute
    of another (``rpm_after`` is 0 less the ones behind), and their time is
    ``FIRST``."""
    minute, tokens, day, requests, recent, recent_n, ahead = state
    n = np.arange(1, len(rows) + 1)
    total = tokens + np.cumsum(rows["tokens"].to_numpy(np.int64))
    out = pd.DataFrame({"event_id": rows["event_id"].to_numpy(np.int64), "api_key": rows["api_key"].to_numpy(np.int64),
                        "ts_us": FIRST, "tokens_minute": total, "day_requests": requests + n, "rpm_after": n - ahead,
                        "minute_reset": False, "day_reset": False})
    return out, (minute, int(total[-1]), day, requests + len(rows), recent, recent_n, ahead - len(rows))


def quota_fold_after(requests: DataFrame, state: DataFrame | None, anchor_us: int | None = None) -> DataFrame:
    """``quota_fold`` from the counters in ``state`` (``CARRY_SCHEMA``; None: there
    are none yet), with the columns ``_range`` and ``carry``: of a key, the
    last ``carry`` that is not null in the order of ``_range`` is its new state.

    The same plan: requests in ranges of bounded rows.  A key's range begins
    with a row of what the key starts with.  A key's requests are expected behind
    its carried ones; when some are not, step functions reach over whole ranges
    to stay exact.  Requests without a timestamp come last (``_fold_undated``)."""
    cols = requests.select(F.coalesce(F.col("event_id").cast("bigint"), F.lit(LAST)).alias("event_id"),
                           F.coalesce(F.col("api_key").cast("bigint"), F.lit(NO_KEY)).alias("api_key"),
                           F.coalesce(F.col("ts_us").cast("bigint"), F.lit(LAST)).alias("ts_us"),
                           F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)).alias("tokens"))
    keys = cols.groupBy("api_key").agg(F.min("ts_us").alias("first"), F.count_if(F.col("ts_us") == LAST).alias("undated"))
    late = False
    if state is None:
        keys = keys.withColumn("carry", F.lit(None).cast("string"))
    else:
        keys = keys.join(state, "api_key", "left")
        pending = F.from_json("carry", "array<string>")      # next minute reset, tokens, next day reset, ...
        begin = F.col("first") if anchor_us is None else F.greatest("first", F.lit(int(anchor_us)))
        late = not keys.where((F.col("first") < LAST - DAY_US) & (
            (F.get(pending, F.lit(0)).cast("bigint") > begin + MINUTE_US)
            | (F.get(pending, F.lit(2)).cast("bigint") > begin + DAY_US))).isEmpty()
    starts = keys.where("carry is not null or undated > 0").select(
        F.lit(FIRST).alias("event_id"), "api_key", F.lit(FIRST).alias("ts_us"), F.lit(0).cast("bigint").alias("tokens"),
        "carry", "undated")
    rows = cols.select("*", F.lit(None).cast("string").alias("carry"), F.lit(0).cast("bigint").alias("undated"))

    def start_of(part):
        return (part["carry"].iloc[0], int(part["undated"].iloc[0])) if len(part) else None

    def summarize(rows):
        start, dated, undated = _parts(rows)
        steps = None
        if len(dated):
            ts, tokens = dated["ts_us"].to_numpy(np.int64), dated["tokens"].to_numpy(np.int64)
            begin = int(ts[0]) if anchor_us is None else max(int(ts[0]), int(anchor_us))
            steps = (int(ts[0]), _reset_steps(ts, tokens, int(ts[-1]) if late else begin + MINUTE_US, MINUTE_US),
                     _reset_steps(ts, np.ones(len(ts), np.int64), int(ts[-1]) if late else begin + DAY_US, DAY_US),
                     ts[np.searchsorted(ts, ts[-1] - MINUTE_US, side="right"):])
        return start_of(start), steps, len(undated), int(undated["tokens"].sum())

    def advance(state, summary):
        start, steps, undated, tokens = summary
        state = _started(state, start, anchor_us)
        if steps is not None:
            first, minute, day, tail = steps
            state = _anchored(state, first)
            state = (*_after_steps(minute, *state[:2]), *_after_steps(day, *state[2:4]),
                     *_in_time(*_trailing(*state[4:6], tail)), state[6])
        return state[0], state[1] + tokens, state[2], state[3] + undated, *state[4:6], state[6] - undated

    def fold(rows, state):
        out = []
        for _, own in rows.groupby("api_key", sort=False):
            start, dated, undated = _parts(own)
            state, done = _started(state, start_of(start), anchor_us), []
            if len(dated):
                state = _anchored(state, int(dated["ts_us"].iloc[0]))
                folded, carry = fold_batch(dated, state[:6])
                done, state = [folded], (*carry[:4], *_in_time(*carry[4:]), state[6])
            if len(undated):
                folded, state = _fold_undated(undated, state)
                done.append(folded)
            for folded in done:
                folded["carry"] = None
            if done:
                done[-1].loc[done[-1].index[-1], "carry"] = json.dumps(state[:6])
            out, state = out + done, None
        if not out:
            return pd.DataFrame(columns=[*FOLD_COLUMNS, "_range", "carry"])
        return pd.concat(out, ignore_index=True).assign(_range=int(rows["_range"].iloc[0]))

    order = ["ts_us", "event_id"]
    ranged = in_ranges(rows.unionByName(starts), ["api_key"], order, RANGE_ROWS)
    out = fold_in_ranges(ranged, "api_key", order, summarize, advance, fold, f"{FOLD_SCHEMA}, _range int, carry string")
    return out.withColumns({"event_id": F.when(F.col("event_id") == LAST, FIRST).otherwise(F.col("event_id")),
                            "api_key": F.nullif(F.col("api_key"), F.lit(NO_KEY))})


def carried(folded: DataFrame, state: DataFrame | None) -> DataFrame:
    """The state after ``folded`` (rows of ``quota_fold_after``), keys without new requests included."""
    new = folded.where("carry is not null").groupBy(F.coalesce("api_key", F.lit(NO_KEY)).alias("api_key")).agg(
        F.max_by("carry", "_range").alias("carry"))
    return new if state is None else new.unionByName(state.join(new, "api_key", "left_anti"))
