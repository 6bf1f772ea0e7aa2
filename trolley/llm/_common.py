"""Table loading and the cluster's shared folder, under the names that the operators use."""

from trolley.sources.catalogue import table
from trolley.sources.shared import shared_dir, written

__all__ = ["shared_dir", "table", "written"]
