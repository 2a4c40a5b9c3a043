"""Named queries over the given tables, each with the plain SQL it must agree with."""
