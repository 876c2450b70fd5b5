"""Tributary: raw -> staging -> mart data processing as Spark DataFrame plans."""
