"""DataFrame -> DataFrame operators; none triggers an action."""
