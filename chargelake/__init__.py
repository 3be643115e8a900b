"""Charging-demand and tariff analytics on Spark DataFrames."""
