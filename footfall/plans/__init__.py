"""The daily run: operators and tables put together."""
