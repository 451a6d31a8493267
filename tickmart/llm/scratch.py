"""Tables written to the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from ..sources.scratch import clear, written
from ..sources.scratch import scratch_path as folder

__all__ = ["clear", "folder", "written"]
