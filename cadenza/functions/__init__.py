"""Column-level helpers built only from JVM-side Spark functions."""

from cadenza.functions.scalars import *  # noqa: F401,F403
