"""Shared plan pieces (time, joins) and the chart and batch jobs built from the operators."""
