"""Compositions: the table graph, reports, publishing and the data dictionary."""
