"""Flagging, storing and analysing financial transactions on Spark."""
