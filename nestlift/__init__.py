"""nestlift: paged, nested JSON records -> typed, upserted tables, on Spark.

Public entry points (all lazy unless stated):

* ``JobSpec.from_dict`` / ``validate``           job spec (``nestlift.spec``)
* ``bronze_from_text`` / ``append_bronze``        landing text -> bronze (``nestlift.sources``)
* ``silver_tables``                               bronze -> main + child tables (``nestlift.plans``)
* ``ingest`` / ``ingest_pages`` / ``backfill``    whole runs (``nestlift.plans.run``)
* ``enforce`` / ``unnest`` / ``merge_frames``     single operators (``nestlift.operators``)
* ``window_coverage`` / ``page_report`` / ...     landing audits (``nestlift.sources.landing``)
* ``stream_landing``                              Structured Streaming front end
"""

from .operators.enforce import drift, enforce, enforce_strings
from .operators.unnest import unnest
from .operators.upsert import (MergeConflict, merge_frames, upsert_partitioned, upsert_path,
                               upsert_table)
from .plans.run import IncompleteLanding, backfill, ingest, ingest_pages, upsert_all, upsert_all_tables
from .plans.silver import silver_tables
from .sources.bronze import append_bronze, bronze_from_text, read_bronze, write_landing
from .sources.landing import (date_windows, expected_pages, page_report, records,
                              window_coverage)
from .spec import ChildSpec, JobSpec, SpecError, select_tables, validate
from .streaming.landing_stream import stream_landing

__all__ = [
    "ChildSpec", "IncompleteLanding", "JobSpec", "MergeConflict", "SpecError", "append_bronze",
    "backfill", "bronze_from_text", "date_windows", "drift", "enforce", "enforce_strings",
    "expected_pages", "ingest", "ingest_pages", "merge_frames", "page_report", "read_bronze",
    "records", "select_tables", "silver_tables", "stream_landing", "unnest", "upsert_all",
    "upsert_all_tables", "upsert_partitioned", "upsert_path", "upsert_table", "validate",
    "window_coverage", "write_landing",
]
