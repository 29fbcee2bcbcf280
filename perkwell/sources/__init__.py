"""Where loyalty tables come from and where results go."""
