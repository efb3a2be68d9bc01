"""The grid of scored weeks: trailing windows cut into buckets that never straddle a window edge."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# No scored week. A non-null date, so that a join on the week infers no filter of its own.
NO_WEEK = date(1970, 1, 1)

# Stored buckets begin whole numbers of their length from this Monday.
ANCHOR = date(1970, 1, 5)

# Longer lists of (week, bucket) are a table that is joined, not literals in the plan.
MOST_LITERALS = 512

Holders = tuple[tuple[date, ...], ...]


@dataclass(frozen=True)
class WeekGrid:
    """``baseline[b]`` and ``recent[b]`` list the weeks whose window holds bucket ``b``.

    The methods return SQL expressions over a time column or over a bucket number.
    """

    origin: date
    end: date
    bucket_days: int
    baseline: Holders
    recent: Holders
    weeks: tuple[date, ...] = ()
    baseline_days: int = 0
    recent_days: int = 0

    @property
    def as_table(self) -> bool:
        return len(self.weeks) * (self.baseline_days // self.bucket_days) > MOST_LITERALS

    def holders(self, spark: SparkSession) -> DataFrame:
        """``bucket, week_start, is_recent``: which weeks' windows hold which buckets, worked out from
        the list of weeks by Spark. As long as the list times the buckets of a window."""
        weeks = spark.createDataFrame([(w,) for w in self.weeks], "week_start date")
        stop = (F.date_diff("week_start", F.lit(self.origin)) / self.bucket_days).cast("int")
        first, recent = stop - self.baseline_days // self.bucket_days, stop - self.recent_days // self.bucket_days
        held = weeks.select("week_start", recent.alias("recent"), F.explode(F.sequence(first, stop - 1)).alias("bucket"))
        return held.select("bucket", "week_start", (F.col("bucket") >= F.col("recent")).alias("is_recent"))

    def in_range(self, ts: str, sql_type: str) -> str:
        """Half-open and in the column's own type, so that the filter reaches the scan."""
        low, high = (f"cast('{d.isoformat()} 00:00:00' as {sql_type})" for d in (self.origin, self.end))
        return f"{ts} >= {low} and {ts} < {high}"

    def recent_range(self, ts: str, sql_type: str) -> str:
        first = next(b for b, weeks in enumerate(self.recent) if weeks)
        start = self.origin + timedelta(days=first * self.bucket_days)
        return WeekGrid(start, self.end, self.bucket_days, (), ()).in_range(ts, sql_type)

    def bucket(self, ts: str) -> str:
        days = f"date_diff(to_date({ts}), DATE'{self.origin.isoformat()}')"
        return f"coalesce(cast(floor({days} / {self.bucket_days}) as int), -1)"

    def baseline_weeks(self, bucket: str) -> str:
        return _week_array(self.baseline, bucket)

    def recent_weeks(self, bucket: str) -> str:
        return _week_array(self.recent, bucket)

    def recent_week(self, bucket: str) -> str:
        """The one week whose recent days hold the bucket, or several exploded."""
        if all(len(weeks) <= 1 for weeks in self.recent):
            flat = _dates([weeks[0] if weeks else NO_WEEK for weeks in self.recent])
            return f"coalesce(element_at({flat}, {bucket} + 1), DATE'{NO_WEEK.isoformat()}')"
        return f"explode_outer({self.recent_weeks(bucket)})"


def week_grid(weeks: Sequence[date], baseline_days: int = 28, recent_days: int = 7) -> WeekGrid:
    """Buckets are as long as the edges of all the windows allow: 7 days for Mondays and 28/7."""
    if not weeks:
        raise ValueError("at least one week is needed")
    if not 0 < recent_days <= baseline_days:
        raise ValueError("recent_days must be positive and within baseline_days")
    weeks = sorted(set(weeks))
    origin = weeks[0] - timedelta(days=baseline_days)
    step = gcd(baseline_days, recent_days, *[(w - weeks[0]).days for w in weeks])
    size = (weeks[-1] - origin).days // step

    def holders(days: int) -> Holders:
        held: list[list[date]] = [[] for _ in range(size)]
        for week in weeks:
            stop = (week - origin).days // step
            for b in range(stop - days // step, stop):
                held[b].append(week)
        return tuple(tuple(h) for h in held)

    return WeekGrid(
        origin, weeks[-1], step, holders(baseline_days), holders(recent_days), tuple(weeks), baseline_days, recent_days
    )


def require_whole_buckets(grid: WeekGrid, days: int) -> None:
    """Refuse windows that would cut stored buckets of ``days`` days."""
    if grid.bucket_days % days or (grid.origin - ANCHOR).days % days:
        raise ValueError(f"windows must begin and end with stored buckets of {days} days from {ANCHOR}")


def grid_months(weeks: Sequence[date], baseline_days: int = 28) -> list[str]:
    """The months (``yyyy-MM``) that the windows touch and one more on either side, for data whose
    folders follow another clock than the readings."""
    low = min(weeks) - timedelta(days=baseline_days)
    first, last = low.year * 12 + low.month - 2, max(weeks).year * 12 + max(weeks).month
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def mondays(first: date, count: int) -> list[date]:
    return [first + timedelta(days=7 * i) for i in range(count)]


def _dates(days: Sequence[date]) -> str:
    return "array(" + ", ".join(f"DATE'{d.isoformat()}'" for d in days) + ")"


def _week_array(holders: Holders, bucket: str) -> str:
    table = "array(" + ", ".join(_dates(weeks or (NO_WEEK,)) for weeks in holders) + ")"
    return f"element_at({table}, {bucket} + 1)"
