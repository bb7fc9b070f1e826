"""Utility (electric + gas) analytics as PySpark DataFrame jobs."""

from meterstone.settings import Settings
from meterstone.plans.warehouse import Warehouse
from meterstone.plans.reports import Reports

__all__ = ["Settings", "Warehouse", "Reports"]
