"""Query bindings on the standard tables, each with its oracle SQL where SQL can say it."""

from importlib import import_module

MODULES = ["metric_queries", "table_queries", "feature_queries", "text_queries", "model_queries", "stream_queries"]


def load_all():
    """Import every binding module; returns (queries, oracles)."""
    for name in MODULES:
        import_module(f"lumenfold.plans.{name}")
    from lumenfold.plans import catalog
    return catalog.QUERIES, catalog.ORACLES
