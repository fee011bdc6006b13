"""Retail demand analytics and forecasting as Spark DataFrame and Spark ML jobs."""
