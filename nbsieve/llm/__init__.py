"""Operators of a training-data pipeline (de-duplication, filtering, scoring,
packing, sharding). Nothing else in the library imports this subpackage."""
