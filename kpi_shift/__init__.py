"""Before/after monitoring of entities whose KPIs move from one set of counters to another."""

from kpi_shift.spec import CARRIER, SECTOR, TOWER, Kpi, Level, Monitor

__all__ = ["CARRIER", "SECTOR", "TOWER", "Kpi", "Level", "Monitor"]
