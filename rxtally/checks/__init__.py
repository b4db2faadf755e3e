"""Every operator as a query over the driver tables, and the SQL it must agree with."""
