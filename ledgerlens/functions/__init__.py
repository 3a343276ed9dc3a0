from . import dates, labels, status  # noqa: F401
