"""Compositions: the modelled tables, dashboard datasets and the query catalog."""
