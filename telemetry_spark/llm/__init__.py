"""Operators of a training-data pipeline: tokenising, language, personal data, duplicates,
URL filters, sharding and packing.  Nothing else in the library imports this subpackage."""
