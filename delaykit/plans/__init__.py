"""Jobs: operators put together end to end."""
