"""Spark-native analytics for geo-located incident tables.

Every public function maps DataFrame(s) to a DataFrame (or a Column
expression) and builds its plan with the DataFrame / SQL API, so Catalyst
prunes columns, pushes filters into the scan and picks join strategies.
"""

from geoincident.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
