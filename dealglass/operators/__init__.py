"""Analytic operators: plain functions from a Model and a date to a DataFrame."""
