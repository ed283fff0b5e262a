from . import columns, special  # noqa: F401
