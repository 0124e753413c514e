"""Point-in-time market-tick evidence as composable PySpark DataFrame operators.

Five rules hold everywhere: a missing value is UNKNOWN, never negative or zero;
a derived value is usable only from its own availability time; conditions use
data strictly before the start receipt; ambiguity is rejected, not resolved; and
accepted + quarantined + duplicates always equals the input.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
