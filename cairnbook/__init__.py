"""Loan-book analytics and training-data operators on Spark."""
