"""Keyed sensor-session analytics as DataFrame-to-DataFrame operators on Spark."""
