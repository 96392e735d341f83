"""Relational operators: functions from DataFrames to DataFrames, declared for Catalyst."""
