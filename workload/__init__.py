"""The registered queries: the operators run on the driver's tables, with SQL to check them."""
