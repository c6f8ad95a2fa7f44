"""Operators: functions from DataFrame to DataFrame, columns as arguments."""
