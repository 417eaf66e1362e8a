"""Scalar expressions, Column in and Column out, all evaluated inside the JVM."""
