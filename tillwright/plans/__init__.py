"""Reports. Each is `f(tables, as_of, **thresholds) -> DataFrame`, lazy, ordered, never printed."""
