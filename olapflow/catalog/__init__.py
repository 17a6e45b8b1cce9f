"""All registered queries; importing this package fills the registry."""

from olapflow.catalog import cubes, flows, inputs, rows, snapshots, spatial, star  # noqa: F401
from olapflow.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
