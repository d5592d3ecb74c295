"""Operators of a large-scale training-data pipeline (see the README section of this name)."""

import os
import site
import sys


def _workers_import() -> bool:
    """True if Python workers find this package by themselves (installed, on PYTHONPATH, or in the working folder)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd(), *site.getsitepackages()]
    return any(p and os.path.realpath(p) == os.path.realpath(root) for p in places)


if not _workers_import():  # then the functions travel with the job
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
