"""Operators for preparing language-model training data: scoring, deduplication, decontamination,
mixing, sharding and output formats. Nothing else in the library imports this subpackage."""
