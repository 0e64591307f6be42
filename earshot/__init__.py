"""Listening analytics and recommendations, for all users at once, on Spark."""
