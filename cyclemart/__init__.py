"""Sales-performance warehouse and KPIs as PySpark DataFrame transformations."""

from cyclemart.config import SalesRules
from cyclemart.session import build_session, tune

__all__ = ["SalesRules", "build_session", "tune"]
