"""Operators of a training-data pipeline. Nothing else in seqloom imports this subpackage."""

from importlib import import_module

MODULES = ("exact_dedup", "sentencepiece_codec", "token_counts", "mixing", "quality_rules", "pii", "near_dedup", "line_dedup", "quality_classifier", "licenses")


def _all(name: str) -> dict:
    out: dict = {}
    for module in MODULES:
        out |= getattr(import_module(f"{__name__}.{module}"), name)
    return out


def queries() -> dict:
    """name -> function (spark, sf_dir) -> DataFrame."""
    return _all("QUERIES")


def oracles() -> dict:
    """name -> DuckDB SQL with the same rows."""
    return _all("ORACLES")
