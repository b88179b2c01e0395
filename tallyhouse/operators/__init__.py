"""Operators: keys, normalisation, exploration, quality, star schema, cumulative tables, SCD2."""
