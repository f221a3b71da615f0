"""Named queries over the driver tables, each with a DuckDB oracle where
the result is expressible in SQL. Importing this package registers them."""

from . import q_consolidate, q_io, q_ml, q_models, q_prep, q_profile, q_text  # noqa: F401
