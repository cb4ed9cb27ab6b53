"""Job plans: the daily job and the registered query catalog."""
