from . import gold, silver, views  # noqa: F401
