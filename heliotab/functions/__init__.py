from . import scalars, timeparts, cyclic  # noqa: F401
