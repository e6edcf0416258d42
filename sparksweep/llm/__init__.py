"""Operators for training-data pipelines over document and page tables; one module per operator."""
