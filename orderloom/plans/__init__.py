"""Whole jobs and views put together from the operators."""
