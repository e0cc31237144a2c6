"""Imports every query module so that the registry is complete."""

from isotherm.plans import (q_audit, q_catalogue, q_clean, q_features, q_intake, q_io, q_model, q_publish, q_star,  # noqa: F401
                            q_stats)
from isotherm.plans.registry import REGISTRY, oracle, spark_query


def queries():
    return {name: spark_query(name) for name in REGISTRY}


def oracle_sql():
    return {name: sql for name in REGISTRY if (sql := oracle(name)) is not None}
