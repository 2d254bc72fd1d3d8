"""All registered queries (importing the modules fills the registry)."""
from panelforge.plans import (q_clean, q_insights, q_macro, q_model, q_panel, q_scalar, q_select,  # noqa: F401
                              q_sources, q_windows)
from panelforge.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
