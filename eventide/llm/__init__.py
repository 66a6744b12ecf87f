"""Operators for preparing training text: language, toxicity and quality scores, exact and near
duplicates, benchmark passages, licenses, chat rendering, source mixing and shard placement.

Nothing else in the package imports this subpackage."""
