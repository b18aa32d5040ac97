from snapmetrics.sources.tables import TABLES, register_views, table

__all__ = ["TABLES", "register_views", "table"]
