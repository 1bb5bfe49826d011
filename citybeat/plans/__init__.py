"""Bindings of the operators to the driver tables and the query catalog."""
