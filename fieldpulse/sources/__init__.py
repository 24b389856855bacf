"""Where records come from and where tables and dead letters go."""
