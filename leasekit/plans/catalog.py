"""Collects every registered query module."""

from __future__ import annotations

import importlib

MODULES = ["q_sources", "q_clean", "q_reports", "q_split", "q_encode", "q_models", "q_score", "q_closed"]


def _load():
    for m in MODULES:
        importlib.import_module(f"leasekit.plans.{m}")


#: Full fits of hundreds of trees, many at once: listed after all others, the longest last.
LONG = ["model_random_forest", "model_extra_trees", "model_xgboost", "importance", "builtin_importance", "model_voting",
        "feature_ablation", "model_stacking", "final_model", "finalists", "model_zoo", "hyper_search"]


def queries():
    _load()
    from leasekit.plans.registry import QUERIES

    return {k: v for k, v in QUERIES.items() if k not in LONG} | {k: QUERIES[k] for k in LONG}


def oracle_sql():
    _load()
    from leasekit.plans.registry import oracle_texts

    return oracle_texts()


def ops():
    _load()
    from leasekit.plans.registry import OPS

    return dict(OPS)
