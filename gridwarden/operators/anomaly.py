"""Readings beyond sigma of the gateway's own trailing baseline, and the weekly score.

Raw rows are never expanded per week. They are first reduced to moments per gateway and bucket
(map-side combined), the few buckets of each window are merged, and only then are the rows of the
recent days compared with their thresholds.

Inside this module the key is ``k``, the time ``ts`` and the metrics ``x0, x1, ...``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import cut_lineage, require_utc
from .dedup import keep_by_key
from .weeks import NO_WEEK, WeekGrid, require_whole_buckets, week_grid

# The scored metrics in the order in which a row's reason is picked, and the defaults.
METRICS = ("offline_duration_sec", "disconnection_cnt", "reboot_cnt")
BASELINE_DAYS = 28
RECENT_DAYS = 7
SIGMA = 3.0
# Length of the buckets of stored moments.
STORED_DAYS = 7

REASON_MODES = ("first_reading", "first_breach")

# Measured thresholds are broadcast only up to this size.
BROADCAST_BYTES = 64 << 20
# Recent rows of one key and week that one join task should get at most.
SPLIT_ROWS = 200_000
# So many of the busiest keys and weeks are split. Any other has at most one in so many of all rows.
SPLIT_KEYS = 10_000


def scoring_rows(
    telemetry: DataFrame,
    grid: WeekGrid,
    metrics: Sequence[str] = METRICS,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
) -> DataFrame:
    """``k, ts, x0..`` within the grid's range, NaN as null; one row per (k, ts) if ``order`` is
    given. Leave ``order`` out for telemetry that cleaning has already made unique."""
    in_range = grid.in_range(f"`{ts}`", telemetry.schema[ts].dataType.simpleString())
    return prepared_rows(telemetry.where(in_range), metrics, key, ts, order)


def prepared_rows(
    telemetry: DataFrame, metrics: Sequence[str], key: str, ts: str, order: Sequence[str] = ()
) -> DataFrame:
    """``k, ts, x0..`` of the rows that have a key; see ``scoring_rows``."""
    schema = telemetry.schema
    if not isinstance(schema[ts].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{ts} must be a timestamp, not {schema[ts].dataType.simpleString()}")
    if isinstance(schema[ts].dataType, T.TimestampType):
        require_utc(telemetry)
    values = []
    for i, m in enumerate(metrics):
        floating = isinstance(schema[m].dataType, (T.DoubleType, T.FloatType))
        number = f"cast(`{m}` as double)"
        values.append(f"nanvl({number}, null) as x{i}" if floating else f"{number} as x{i}")
    rows = telemetry.where(f"`{key}` is not null").selectExpr(
        f"`{key}` as k", f"`{ts}` as ts", *values, *[f"`{c}`" for c in order]
    )
    if order:
        rows = keep_by_key(rows, ["k", "ts"], order)
        return rows.select("k", "ts", *[f"x{i}" for i in range(len(metrics))])
    return rows


def moment_columns(width: int) -> str:
    """Count, mean, centred sum of squares, minimum and maximum of each metric, beside the first time
    and the number of rows."""
    return "min(ts) AS first_ts, count(*) AS n_rows, " + ", ".join(
        f"count(x{i}) AS n{i}, try_divide(sum(x{i}), count(x{i})) AS mean{i}, var_pop(x{i}) * count(x{i}) AS m2_{i}, "
        f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}"
        for i in range(width)
    )


def _moments_sql(grid: WeekGrid, width: int, from_store: bool = False) -> str:
    """``moments`` per key and bucket, from ``{rows}`` or from ``{stored}`` moments."""
    if from_store:
        return f"""moments AS (
  SELECT *, cast(floor(date_diff(stored_bucket, DATE'{grid.origin.isoformat()}') / {grid.bucket_days}) AS int) AS bucket
  FROM {{stored}} WHERE stored_bucket >= DATE'{grid.origin.isoformat()}' AND stored_bucket < DATE'{grid.end.isoformat()}'
)"""
    return f"""moments AS (
  SELECT k, bucket, {moment_columns(width)}
  FROM (SELECT *, {grid.bucket("ts")} AS bucket FROM {{rows}})
  GROUP BY k, bucket
)"""


def _stats_sql(grid: WeekGrid, width: int, from_store: bool = False) -> str:
    """Common table expressions to ``stats(week_start, k, first_ts, mean0, std0, ..)``.

    Buckets merge by the parallel-variance rule around the merged mean. A series whose minimum
    equals its maximum has deviation exactly 0, whatever order the partial sums arrived in.
    ``first_ts`` is the first recent time, null without recent rows.
    """
    centred, merged, stats = [], [], []
    for i in range(width):
        centred.append(f"try_divide(sum(n{i} * mean{i}) OVER w, sum(n{i}) OVER w) AS all{i}")
        merged.append(
            f"sum(n{i}) AS n{i}, max(all{i}) AS mean{i}, "
            f"sum(m2_{i} + n{i} * (mean{i} - all{i}) * (mean{i} - all{i})) AS m2_{i}, "
            f"min(lo{i}) AS lo{i}, max(hi{i}) AS hi{i}"
        )
        stats.append(
            f"if(lo{i} = hi{i}, lo{i}, mean{i}) AS mean{i}, CASE WHEN n{i} <= 1 THEN null "
            f"WHEN lo{i} = hi{i} THEN 0d ELSE sqrt(m2_{i} / (n{i} - 1)) END AS std{i}"
        )
    if grid.as_table:
        gaps, spread = "", "SELECT /*+ BROADCAST(h) */ moments.*, h.week_start, h.is_recent FROM moments JOIN {holders} h USING (bucket)"
    else:
        gaps = "" if all(grid.baseline) else f"WHERE week_start <> DATE'{NO_WEEK.isoformat()}'"
        spread = f"""SELECT *, array_contains({grid.recent_weeks("bucket")}, week_start) AS is_recent
  FROM (SELECT *, explode_outer({grid.baseline_weeks("bucket")}) AS week_start FROM moments)"""
    return f"""{_moments_sql(grid, width, from_store)}, spread AS (
  {spread}
), centred AS (
  SELECT *, {", ".join(centred)} FROM spread {gaps} WINDOW w AS (PARTITION BY k, week_start)
), merged AS (
  SELECT k, week_start, min(if(is_recent, first_ts, null)) AS first_ts, sum(if(is_recent, n_rows, 0)) AS n_rows,
         {", ".join(merged)}
  FROM centred GROUP BY k, week_start
), stats AS (
  SELECT week_start, k, first_ts, n_rows, {", ".join(stats)} FROM merged
)"""


def baseline_stats(
    telemetry: DataFrame,
    weeks: Sequence[date],
    metrics: Sequence[str] = METRICS,
    baseline_days: int = BASELINE_DAYS,
    recent_days: int = RECENT_DAYS,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
) -> DataFrame:
    """``week_start, key, mean_*, std_*`` over ``[week - baseline_days, week)``."""
    grid = week_grid(weeks, baseline_days, recent_days)
    rows = scoring_rows(telemetry, grid, metrics, key, ts, order)
    named = ", ".join(f"{p}{i} AS `{p}_{m}`" for i, m in enumerate(metrics) for p in ("mean", "std"))
    return _run(f"WITH {_stats_sql(grid, len(metrics))} SELECT week_start, k AS `{key}`, {named} FROM stats", rows, grid)


def _run(sql: str, rows: DataFrame, grid: WeekGrid | None = None, **tables: DataFrame) -> DataFrame:
    if grid and grid.as_table:
        tables["holders"] = grid.holders(rows.sparkSession)
    return rows.sparkSession.sql(sql, rows=rows, **tables)


def _thresholds_sql(
    grid: WeekGrid, width: int, sigma: float, floor: float | None = None, from_store: bool = False
) -> str:
    """... to ``thresholds``: mean plus sigma deviations, null where the deviation is 0 or undefined."""
    limits = []
    for i in range(width):
        limit = f"mean{i} + {sigma!r}d * nullif(std{i}, 0d)"
        if floor is not None:
            complaint = f"metric {i} has readings below the declared floor {floor}"
            limit = f"if({limit} < {floor!r}d, cast(raise_error('{complaint}') AS double), {limit})"
        limits.append(f"{limit} AS limit{i}")
    return f"""{_stats_sql(grid, width, from_store)}, thresholds AS (
  SELECT k, week_start, first_ts, n_rows, {", ".join(limits)} FROM stats WHERE first_ts IS NOT NULL
)"""


def _hot_sql(width: int) -> str:
    """``hot``: the keys and weeks with more recent rows than one join task should get, and over how
    many tasks to spread them. The counts come with the moments, so nothing is read again. The list
    is short by its limit, whatever the data, and so may be broadcast; what falls off it is no
    smaller a result, only a less even one. It is ordered by every column of the thresholds, so that
    this use of them is the same as the join's, and the rows are shuffled for both at once."""
    limits = ", ".join(f"limit{i}" for i in range(width))
    return f"""hot AS (
  SELECT k, week_start, 1 + n_rows div {SPLIT_ROWS} AS salts FROM thresholds
  WHERE n_rows > {SPLIT_ROWS} ORDER BY n_rows DESC, k, week_start, first_ts, {limits} LIMIT {SPLIT_KEYS}
), salted AS (
  SELECT /*+ BROADCAST(hot) */ thresholds.*, explode(sequence(0L, coalesce(hot.salts, 1L) - 1L)) AS salt
  FROM thresholds LEFT JOIN hot USING (k, week_start)
)"""


def _flagged_sql(
    grid: WeekGrid,
    width: int,
    where: str = "true",
    keep_silent: bool = False,
    small: bool = False,
) -> str:
    """From ``{rows}`` and ``thresholds`` to ``flagged``: the recent rows with ``flag0..``, their sum
    ``flags`` and the first flagged position ``hit``.

    ``small`` thresholds are broadcast and the raw rows stay where they are. Otherwise both sides
    are shuffled, and only keys and weeks counted to be hot are spread by a salt, so the threshold
    side has one row for each key and week besides. It is far smaller than the raw rows, so it is
    the hash-build side and the raw rows need no sort. ``keep_silent`` also keeps the gateways that
    have none of the rows, as rows without flags.

    Rows of no scored week match no threshold and are dropped after the deduplication's shuffle. A
    plain filter would move below it and make this use of the rows differ from the statistics' use,
    at the cost of a second such shuffle; rand() (never above 1) keeps the filter where it is.
    """
    flags = ", ".join(f"coalesce(cast(x{i} > limit{i} AS int), 0) AS flag{i}" for i in range(width))
    cases = " ".join(f"WHEN flag{i} = 1 THEN {i}" for i in range(width))
    total = " + ".join(f"flag{i}" for i in range(width))
    scored = f"(week_start <> DATE'{NO_WEEK.isoformat()}' OR rand(0) > 2)"
    bucketed = f"SELECT *, {grid.bucket('ts')} AS bucket FROM {{rows}} WHERE {where}"
    if grid.as_table:
        recent = f"""recent AS (
  SELECT /*+ BROADCAST(h) */ b.*, h.week_start FROM ({bucketed}) b JOIN {{holders}} h ON b.bucket = h.bucket AND h.is_recent
)"""
    else:
        recent = f"""recent AS (
  SELECT * FROM (SELECT *, {grid.recent_week("bucket")} AS week_start FROM ({bucketed})) WHERE {scored}
)"""
    if small:
        joined = "SELECT /*+ BROADCAST(thresholds) */ * FROM recent JOIN thresholds USING (k, week_start)"
    else:
        side = "RIGHT" if keep_silent else "INNER"
        recent += f""", {_hot_sql(width)}, dealt AS (
  SELECT /*+ BROADCAST(hot) */ recent.*, pmod(xxhash64(ts), coalesce(hot.salts, 1L)) AS salt
  FROM recent LEFT JOIN hot USING (k, week_start)
)"""
        joined = f"SELECT /*+ SHUFFLE_HASH(salted) */ * FROM dealt {side} JOIN salted USING (k, week_start, salt)"
    return f"""{recent}, joined AS (
  {joined}
), flagged AS (
  SELECT *, {flags}, {total} AS flags, CASE {cases} END AS hit FROM joined
)"""


def _metric_name(metrics: Sequence[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(metrics))
    return f"CASE hit {cases} ELSE '' END AS metric"


def flag_rows(
    telemetry: DataFrame,
    weeks: Sequence[date],
    metrics: Sequence[str] = METRICS,
    baseline_days: int = BASELINE_DAYS,
    recent_days: int = RECENT_DAYS,
    sigma: float = SIGMA,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
) -> DataFrame:
    """Every recent row with one 0/1 flag per metric, their sum and the first flagged metric."""
    grid = week_grid(weeks, baseline_days, recent_days)
    width = len(metrics)
    rows = scoring_rows(telemetry, grid, metrics, key, ts, order)
    named = ", ".join(f"flag{i} AS `flag_{m}`" for i, m in enumerate(metrics))
    return _run(
        f"WITH {_thresholds_sql(grid, width, sigma)}, {_flagged_sql(grid, width)} "
        f"SELECT week_start, k AS `{key}`, ts, {named}, flags, {_metric_name(metrics)} FROM flagged",
        rows,
        grid,
    )


def _bytes(thresholds: DataFrame, width: int) -> int:
    """Size of the thresholds: fixed columns and the ids' own bytes."""
    n, ids = thresholds.selectExpr("count(*)", "coalesce(sum(octet_length(cast(k AS string))), 0)").first()
    return ids + n * (40 + 8 * width)


def score_weeks(
    telemetry: DataFrame,
    weeks: Sequence[date],
    metrics: Sequence[str] = METRICS,
    baseline_days: int = BASELINE_DAYS,
    recent_days: int = RECENT_DAYS,
    sigma: float = SIGMA,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
    reason_mode: str = "first_reading",
    floor: float | None = None,
    measure: bool = False,
    derived: bool = False,
    moments: DataFrame | None = None,
) -> DataFrame:
    """``week_start, key, score, metric`` for every key with at least one recent row.

    The score counts flagged (row, metric) pairs. ``metric`` is that of the earliest recent row
    (empty when that row is not flagged) or, with ``reason_mode='first_breach'``, of the earliest
    flagged row. ``floor`` declares a lower bound of all readings: rows that sit on it in every
    metric cannot be flagged and skip the join. A threshold below the floor disproves the claim
    and raises.

    ``measure`` runs the thresholds as a job of their own (before any action on the result; it
    needs spark.checkpoint.dir), checkpoints and measures them, and broadcasts them if they are small. Then no raw row is shuffled, provided ``order`` is not needed;
    with it, one job that shares the deduplication is the better plan. ``derived`` says that the
    telemetry is not a stored table but comes out of a shuffle (cleaning, say): both uses of it are
    then kept identical, so that they share that shuffle, instead of cutting one to the recent days.

    ``moments`` are stored ones (``stored.read_moments``) that cover the baselines: then only the
    recent days of ``telemetry`` are read.
    """
    if reason_mode not in REASON_MODES:
        raise ValueError(f"unknown reason_mode {reason_mode!r}")
    grid = week_grid(weeks, baseline_days, recent_days)
    width = len(metrics)
    tables, small = {}, False
    if moments is not None:
        telemetry = telemetry.where(grid.recent_range(f"`{ts}`", telemetry.schema[ts].dataType.simpleString()))
        require_whole_buckets(grid, STORED_DAYS)
        tables = {"stored": moments}
    rows = scoring_rows(telemetry, grid, metrics, key, ts, order)
    steps = [_thresholds_sql(grid, width, sigma, floor, moments is not None)]
    if measure:
        thresholds = cut_lineage(_run(f"WITH {steps[0]} SELECT * FROM thresholds", rows, grid, **tables))
        small = _bytes(thresholds, width) <= BROADCAST_BYTES
        tables = {"measured": thresholds}
        steps = ["thresholds AS (SELECT * FROM {measured})"]
    filters = ["true"]
    if not order and not derived:
        filters.append(grid.recent_range("ts", rows.schema["ts"].dataType.simpleString()))
    skip_floor = floor is not None and not small
    if skip_floor:
        filters.append("(" + " or ".join(f"x{i} > {floor!r}d" for i in range(width)) + ")")
    steps.append(_flagged_sql(grid, width, " and ".join(filters), skip_floor, small))
    if reason_mode == "first_breach":
        hit = "min(if(hit IS NULL, null, struct(ts, hit))).hit"
    else:
        hit = "min(if(ts = first_ts, hit, null))"
    steps.append(
        f"scores AS (SELECT k, week_start, sum(flags) AS score, {hit} AS hit FROM flagged GROUP BY k, week_start)"
    )
    return _run(
        f"WITH {', '.join(steps)} SELECT week_start, k AS `{key}`, score, {_metric_name(metrics)} FROM scores",
        rows,
        grid,
        **tables,
    )
