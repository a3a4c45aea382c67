"""Operators: each takes and returns DataFrames, keyed by a ``site`` column
where sites matter, so one job serves every site."""
