"""Registration of queries and oracles, and SQL fragments the oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Fixtures, with_views
from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    """Registers a function of ``Fixtures`` under ``name``, with its oracle."""

    def register(build: Callable[[Fixtures], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return Fixtures.out(build(Fixtures(tune(spark), sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        ORACLES[name] = with_views(oracle)
        return build

    return register


def iso(ts: str, name: str | None = None) -> str:
    """A timestamp as ISO-8601 text with an offset, microseconds only where there are some."""
    text = (
        f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || case when epoch_us({ts}) % 1000000 <> 0 "
        f"then '.' || lpad(cast(epoch_us({ts}) % 1000000 as varchar), 6, '0') else '' end || '+00:00')"
    )
    return f"{text} as {name or ts.split('.')[-1]}"


def compact(json: str) -> str:
    """JSON text without the blanks outside its strings."""
    return rf"""regexp_replace({json}, '("(?:[^"\\]|\\.)*")|\s+', '\1', 'g')"""


def size_of(text: str) -> str:
    """Bytes that a size text spells."""
    t = f"upper(trim({text}))"
    number = f"cast(regexp_extract({t}, '^([0-9.]+)', 1) as double)"
    unit = f"regexp_extract({t}, '([TGMK]?B)$', 1)"
    factor = (
        f"case {unit} when 'TB' then 1099511627776 when 'GB' then 1073741824 when 'MB' then 1048576 "
        "when 'KB' then 1024 else 1 end"
    )
    return (
        f"case when regexp_full_match({t}, '[0-9]+') then cast({t} as bigint) "
        f"when regexp_full_match({t}, '[0-9]+([.][0-9]*)?([TGMK]?B)') then cast(floor({number} * {factor}) as bigint) end"
    )


def time_of(text: str, as_of: str) -> str:
    """The time that a bound text spells."""
    t = f"lower(trim({text}))"
    unit = f"regexp_extract({t}, '(minute|hour|day|week)', 1)"
    seconds = f"case {unit} when 'minute' then 60 when 'hour' then 3600 when 'day' then 86400 else 604800 end"
    amount = f"cast(regexp_extract({t}, '^([0-9]+)', 1) as bigint)"
    return (
        f"case when regexp_full_match({t}, '[0-9]+ (minute|hour|day|week)s? ago') "
        f"then timestamp '{as_of}' - to_seconds({amount} * {seconds}) else try_cast(upper({text}) as timestamp) end"
    )


# The last run of each job, as a subquery.
LATEST = """(select job_name, status as last_run_status, started_on as last_run_time, execution_time as last_run_duration
  from (select *, row_number() over (partition by job_name order by started_on desc nulls last, id desc) as rn
        from job_runs) ranked where rn = 1)"""
