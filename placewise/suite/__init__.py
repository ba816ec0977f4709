"""Every operator as a runnable query over the driver tables, with its SQL counterpart."""
