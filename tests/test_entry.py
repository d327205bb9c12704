import importlib
import re
from pathlib import Path

import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from metascope.fixtures import Fixtures
from metascope.operators import filters, lookups
from metascope.plans import actions
from metascope.sources import exports, listings

# The operator identifiers of the inventory; each has at least one query.
INVENTORY = {
    "src": 17,
    "snk": 6,
    "prj": 5,
    "flt": 15,
    "jn": 8,
    "agg": 10,
    "win": 1,
    "srt": 2,
    "lim": 3,
    "set": 3,
    "sc": 13,
    "act": 7,
    "gen": 1,
    "str": 2,
}


def test_flagship_runs(spark):
    result = entry.entry(spark)
    assert result.columns == ["key", "size"]
    sizes = [r["size"] for r in result.collect()]
    assert len(sizes) == 100 and sizes == sorted(sizes, reverse=True)


def test_inventory_is_covered():
    have = {m[0] for name in entry.QUERIES if (m := re.match(r"[a-z]+\d+", name))}
    want = {f"{kind}{i}" for kind, n in INVENTORY.items() for i in range(1, n + 1)} | {"src0"}
    assert want - have == set()
    assert set(entry.ORACLES) == set(entry.QUERIES) <= set(entry.queries())


def test_operator_list_names_what_exists():
    text = (Path(entry.__file__).parent / "OPERATORS.md").read_text()
    rows = [line.split("|")[1:4] for line in text.splitlines() if re.match(r"\| [A-Z]+\d+ ", line)]
    assert len(rows) == sum(INVENTORY.values()) + 1
    listed = {q for row in rows for q in re.findall(r"`(\w+)`", row[2])}
    assert listed == set(entry.QUERIES)
    for row in rows:
        for path in re.findall(r"`((?:sources|sinks|operators|functions|plans|streaming)\.[\w.]+)`", row[1]):
            module, name = path.rsplit(".", 1)
            assert hasattr(importlib.import_module(f"metascope.{module}"), name), path


# Counts that both engines agreed on when the views were designed (sf0.01).
@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, f"{TESTDATA}/sf0.01")


def test_large_objects(fx):
    assert listings.objects(fx.raw_objects, bucket="A", prefix="F/1", min_size=50_000).count() == 2073


def test_last_runs(fx):
    jobs, runs = listings.jobs(fx.raw_jobs), listings.all_job_runs(fx.raw_job_runs)
    joined = lookups.jobs_with_last_run(jobs, runs)
    counts = {r["last_run_status"]: r["count"] for r in joined.groupBy("last_run_status").count().collect()}
    assert counts == {"FAILED": 440, "RUNNING": 440, "SUCCEEDED": 417, None: 203}


def test_lookbacks(fx):
    runs = listings.all_job_runs(fx.raw_job_runs)
    assert filters.since_or_missing(runs, "started_on", 30, "2001-08-01").count() == 79
    ids, details = fx.raw_queries
    assert exports.query_errors(ids, details, "wg0", as_of="2024-01-31").count() == 162
    assert exports.pipeline_executions(fx.raw_pipeline_executions, "pipe-3", as_of="2024-01-31").count() == 233
    failed = listings.recent_failures(fx.raw_executions, as_of="2024-01-31")
    assert (failed.count(), failed.select("machine_arn").distinct().count()) == (464, 141)
    machines = listings.state_machines(fx.raw_state_machines)
    assert actions.retry_plan(machines, fx.raw_executions, fx.execution_inputs, "wf-0", as_of="2024-01-31").count() == 307
