"""Keyed, time-windowed trip features and fare scoring on Spark."""
