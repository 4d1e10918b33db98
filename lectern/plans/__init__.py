"""Plan-level helpers: lineage cuts, size-checked joins, table loading."""

from lectern.plans.lineage import checkpoint_dir, counted, cut_lineage
from lectern.plans.joins import join_checked, semi_checked
from lectern.plans.tables import table

__all__ = ["checkpoint_dir", "counted", "cut_lineage", "join_checked", "semi_checked", "table"]
