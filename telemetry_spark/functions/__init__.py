"""Scalar rules: plain functions from Column to Column, evaluated inside the JVM."""
