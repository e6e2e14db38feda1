"""Fraud KPIs over card transactions as plain Spark DataFrame functions."""
