"""Named queries over the given tables, each with the SQL that must give the same rows."""

from meanline.catalog import encoders, ranks, recodes, regressions, segments, studies, tables
from meanline.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "encoders", "ranks", "recodes", "regressions", "segments", "studies", "tables"]
