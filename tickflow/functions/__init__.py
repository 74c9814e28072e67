"""Column-level building blocks; everything here stays inside whole-stage codegen."""

from tickflow.functions.clock import ceil_us, floor_us, from_us, to_us
from tickflow.functions.depth import depth_imbalance, depth_wap
from tickflow.functions.guards import clip, finite, guarded_div, signed_log

__all__ = [
    "ceil_us", "clip", "depth_imbalance", "depth_wap", "finite", "floor_us", "from_us",
    "guarded_div", "signed_log", "to_us",
]
