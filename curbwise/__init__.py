"""curbwise — right-of-way permit analytics as Spark DataFrame jobs.

Layout
------
sources/    loading the permit model (parquet, CSV, JDBC), the test-fixture
            mapping from the driver tables, and the publish sinks.
functions/  Column-expression helpers (date rounding, Oracle-style text, casts).
operators/  Reusable DataFrame operators: EAV lookups, first-of-group,
            cycle numbering, counted-bound semi-join reduction, week spine,
            grid spatial join.
plans/      The report queries, weekly roll-ups, inspector scoring and
            segment tagging, each a function from tables to a DataFrame.
streaming/  Incremental segment tagging as a Structured Streaming job.

``python -m curbwise run|tag`` runs the plans over a parquet permit model
and publishes the results (``__main__.py``).
"""

from curbwise.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
