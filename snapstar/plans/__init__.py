"""Warehouse tables, checks and analyses as DataFrame plans."""
