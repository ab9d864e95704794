"""Pipelines (orders, ticks, contacts, customer transactions), plan inspection
and the registered query catalog."""
