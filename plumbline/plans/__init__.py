"""Whole plans made of the operators: radius statistics, listing features, search grids, price models."""
