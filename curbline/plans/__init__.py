"""Plans: the segment report, registered queries and their SQL oracles."""

from curbline.plans.report import segment_counts, segment_report

__all__ = ["segment_counts", "segment_report"]
