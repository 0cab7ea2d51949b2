"""Gridded forecast feeds to regional hazard scores, as DataFrame jobs."""
