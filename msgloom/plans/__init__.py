"""The jobs: operators put together."""
