"""ledgerloom: bond-market and pledged-repo reporting as Spark DataFrame plans."""
