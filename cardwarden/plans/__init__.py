"""Compositions: the daily batch run, and the registered queries."""
