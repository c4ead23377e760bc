"""Inputs and sinks: page tables, driver fixtures, stored index, logs."""
