"""Indicator reports.  Each returns detail rows + "All" group rows per facility."""
