"""lakestrata: layered-lakehouse load operators written as Spark DataFrame transformations.

Layers: landing (delimited files) -> bronze (file stream, by-name) -> silver (contract cleansing and
casting) -> gold (dimensions with SCD1 / SCD2 state algebra, facts with surrogate-key lookups) -> views.
Every operator takes DataFrames and returns a DataFrame; clocks (``as_of``) are parameters.
"""

from lakestrata.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
