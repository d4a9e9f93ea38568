"""SQL for the same results, independent of the Spark code, for checking one against the other."""

from oracle.queries import ORACLE

__all__ = ["ORACLE"]
