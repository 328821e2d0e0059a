"""carelake: payer/provider analytics written as Spark DataFrame, SQL and
Structured Streaming operators.

Layout
------
sources/    readers, writers and the driver-table role bindings
functions/  column-expression helpers (cleaning, dates, ratios, hashing)
operators/  DataFrame -> DataFrame operators (keys, SCD2, facts, scoring, graph)
plans/      star-schema assembly, metrics, questions, report datasets
streaming/  Structured Streaming jobs over event files
"""

from carelake.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
