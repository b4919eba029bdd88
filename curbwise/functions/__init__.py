"""Column-expression helpers; all evaluate inside the JVM (no Python UDFs)."""

from curbwise.functions import dates, text  # noqa: F401
