"""Advertising feature counters, samples, feature analysis and calibration on Spark DataFrames."""
