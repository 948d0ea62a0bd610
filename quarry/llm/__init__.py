"""Operators of a training-data pipeline (chat formatting, deduplication,
tokenizing, search, quality, sharding, language-model scoring, id files and
decontamination). Nothing outside this package imports it."""
