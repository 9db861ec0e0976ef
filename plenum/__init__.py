"""Plenum: entity x event response matrices and corpus operators on Spark DataFrames."""
