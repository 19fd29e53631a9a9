"""tidemark: ERP-to-warehouse loads as PySpark jobs."""

from tidemark.warehouse import LoadFailed, LoadReport, Warehouse

__all__ = ["LoadFailed", "LoadReport", "Warehouse"]
