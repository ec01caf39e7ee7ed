"""Behaviour baselining of cloud roles over audit logs, as Spark jobs.

Every function takes and returns DataFrames, and every notion of "now" is an
argument.  See README.md for a tour.
"""

from rolehabit.settings import Settings

__all__ = ["Settings"]
