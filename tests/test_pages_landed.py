"""Pages that a query lands and reads back."""

from pathlib import Path

from conftest import TESTDATA
from metascope.suite import QUERIES


def test_landed_pages_are_compressed(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("pages-*"))
    assert QUERIES["src0_page_envelopes"](spark, f"{TESTDATA}/sf0.001").count()
    (landed,) = set(shared.glob("pages-*")) - before
    files = list(landed.rglob("part-*"))
    assert files and all(f.name.endswith(".gz") for f in files)
