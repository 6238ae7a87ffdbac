"""Medallion analytics and corpus preparation on Spark."""
