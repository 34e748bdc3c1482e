"""Pipelines: event totals, histories, test rates, attributes, wide tables, publishing."""
