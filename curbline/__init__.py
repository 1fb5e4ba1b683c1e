"""curbline: street-segment event analytics on Spark DataFrames.

Assigns address-based events (parking tickets) to street segments with an
equi join plus a side-aware house-number range join, counts them per segment
and year, keeps segments without events as zero rows, and adds a
least-squares trend slope. See ``curbline.policy`` for the matching policies.
"""

from curbline.plans.report import segment_counts, segment_report
from curbline.policy import PRESETS, MatchPolicy, preset

__all__ = ["MatchPolicy", "PRESETS", "preset", "segment_counts", "segment_report"]
