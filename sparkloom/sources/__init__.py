"""Where targets and responses come from and where results go."""
