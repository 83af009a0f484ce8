"""Every registered query.  Importing this package fills the registry."""

from . import cleaning, demand, files, flows, network, series, shapes  # noqa: F401
