"""Staging, silver and gold models, and the dashboard datasets on top."""
