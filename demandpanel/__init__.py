"""Prepare, classify, impute, decompose and forecast large panels of demand series."""
