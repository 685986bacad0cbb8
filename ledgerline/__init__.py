"""Versioned history of keyed snapshot tables, as Spark DataFrame plans."""

from ledgerline.spec import Column, DatasetSpec, SpecError

__all__ = ["Column", "DatasetSpec", "SpecError"]
