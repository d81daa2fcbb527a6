"""Every operator as a named query over the driver's tables, with its SQL for the check."""
